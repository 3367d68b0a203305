"""What operators and the pipeline leave in the shared folder once their results are there."""

import random
from pathlib import Path

import pytest

import corpus_pipeline
from quern.llm import minhash
from quern.llm.store import Store


@pytest.fixture
def shared(monkeypatch, tmp_path):
    monkeypatch.setattr("quern.llm.store.shared_folder", lambda spark: f"{tmp_path}/shared")
    return tmp_path / "shared/quern"


def test_first_of_each_keeps_the_texts_once_and_no_step_of_the_search(spark, shared):
    rng = random.Random(3)
    docs = [(i, "x", " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=12)) for _ in range(200))) for i in range(400)]
    docs += [(1000 + i, "y", docs[i][2]) for i in range(40)]
    out = minhash.first_of_each(spark.createDataFrame(docs, "doc_id bigint, lang string, text string"))
    left = sum(p.stat().st_size for p in Path(shared).rglob("*.parquet"))
    assert left < sum(len(t) for _, _, t in docs)
    assert not [p for p in Path(shared).rglob("*.parquet") if "minhash" in str(p)]
    assert sorted(tuple(r) for r in out.collect()) == docs[:400]


def test_clear_leaves_the_tables_named(spark, shared):
    store = Store(spark, "some")
    one, two, three = (store.keep(spark.range(n)) for n in (1, 2, 3))
    store.clear(two)
    assert two.count() == 2 and [p.name for p in Path(store.path).iterdir()] == ["2"]
    store.drop(one, three, two)
    assert not list(Path(store.path).iterdir())


def test_pipeline_keeps_its_last_table(spark, shared, tmp_path):
    docs = [(i, f"some words of text number {i}", "en", "s", 0) for i in range(5)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in out.collect()) == [0, 1, 2, 3, 4]
    (folder,) = Path(shared).glob("pipeline-*")
    assert len(list(folder.iterdir())) == 1
