import random

import pytest

import corpus_pipeline
from quern.llm import decontaminate, minhash, suffix_dedup


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdefghi") for _ in range(rng.randint(2, 7))) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    at = str(tmp_path_factory.mktemp("tables"))
    items = [(i, text(20)) for i in range(5)]
    passage = text(60)
    docs = [(i, text(120), "en", f"s{i % 3}", 0) for i in range(160)]
    docs += [(200, docs[3][1] + " more", "en", "s", 0), (201, docs[4][1], "en", "s", 0), (202, text(30) + " " + items[2][1] + " " + text(30), "en", "s", 0)]
    docs += [(203, text(50) + " " + passage, "fr", "s", 0), (204, passage + " " + text(50), "fr", None, 0), (205, None, None, None, None), (206, "", "en", "s", 0)]
    docs += [(300 + i, text(40) + " scumbag vilest " + text(20) + " vilest", "en", "s", 0) for i in range(60)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k >= 300)) for k, *_ in docs if k < 150 or k >= 300], "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_each_stage_on_what_the_last_kept(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if i < 4:
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
    assert set(kept["toxicity"]) == {*range(160), *range(200, 207)}
    assert set(kept["near duplicates"]) == set(kept["toxicity"]) - {200, 201}
    assert set(kept["repeated passages"]) == set(kept["near duplicates"])
    assert len(kept["repeated passages"][204].text) < 400 < len(kept["near duplicates"][204].text) and kept["repeated passages"][203].text == kept["near duplicates"][203].text
    assert set(kept["benchmark leaks"]) == set(kept["repeated passages"]) - {202}
    assert set(kept["encoding"]) == set(kept["benchmark leaks"]) and all(r.round_trip and r.n_tokens == len(r.ids) for r in kept["encoding"].values())
    assert {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, folder).collect()} == {k: r.n_tokens for k, r in kept["encoding"].items()}


def test_modules_are_those_of_the_operators():
    assert {corpus_pipeline.minhash, corpus_pipeline.suffix_dedup, corpus_pipeline.decontaminate} == {minhash, suffix_dedup, decontaminate}


def test_near_duplicates_from_four_fifths(spark, folder):
    docs = []
    for i in range(20):  # an inner word changed: of 50 shingles 45 stay, 45 / 55 = 0.818; of 44 39, 39 / 49 = 0.796
        for k, n in ((0, 54), (100, 48)):
            words = [f"w{k}x{i}x{j}" for j in range(n)]
            docs += [(4 * i + k, " ".join(words)), (4 * i + k + 1, " ".join([*words[:20], "other", *words[21:]]))]
    left = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(docs, "doc_id bigint, text string"), folder)
    assert sorted(r.doc_id for r in left.collect()) == [4 * i for i in range(20)] + [100 + 4 * i + j for i in range(20) for j in (0, 1)]


ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, doc string, row int, whole string, node bigint, key string"


def odd(spark, rows):
    return spark.createDataFrame([(k, t, None, None, None, "d", 1, None, 2, "k") for k, t in rows], ODD)


def test_stages_on_odd_tables(spark, folder):
    """Nulls, repeated rows, shared ids, a very long text, and columns that clash with names of the plans."""
    words = " ".join(f"w{i}" for i in range(50))
    long = " ".join(f"l{i}" for i in range(60_000))
    rows = [(None, None), (None, words), (1, words), (1, words), (2, words + " end"), (2, "quite another text"), (3, ""), (4, None), (5, long), (6, " \n")]
    docs = odd(spark, rows)
    want = {"toxicity": 10, "near duplicates": 7, "repeated passages": 10, "benchmark leaks": 10, "encoding": 10}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "encoding":
            assert out.columns == docs.columns
        got = out.collect()
        assert len(got) == want[name], name
        if name == "near duplicates":
            assert sorted((r.doc_id or 0, r.text) for r in got if (r.text or "").strip()) == [(1, words), (2, "quite another text"), (5, long)]
        if name == "repeated passages":
            whole = sorted(r.text for r in got)
            # of the five texts that hold the words only the first, that without an id, keeps them
            assert sum(words in t for t in whole) == 1 and long in whole
        if name != "encoding":
            assert {(r.doc, r.row, r.whole, r.node, r.key) for r in got} == {("d", 1, None, 2, "k")}


def test_stages_on_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    some = odd(spark, [(1, "some text"), (2, None)])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, some, str(tmp_path)).count() == 2
