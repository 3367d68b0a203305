import gzip
import json
import os
import shutil

import pytest
import zstandard
from pyspark.sql import functions as F

from quern.functions import hashing as H
from quern.functions import text as T
from quern.functions.arrow import html_text, nfkc
from quern.operators import cleaning as C
from quern.plans import config
from quern.plans.preprocess import Run, preprocess
from quern.sources import readers, sinks
from quern.sources.readers import Source

LINE = lambda *rows: "\n".join(json.dumps(r) for r in rows).encode()


def ids(df):
    return sorted(r.id for r in df.collect())


def test_compression_by_first_bytes(spark, tmp_path):
    rows = LINE({"id": "a", "text": "x"}) + b"\n\n" + LINE({"id": "", "text": "y"}, {"id": "c", "text": None}, {"id": "0", "text": "z"})
    z = zstandard.ZstdCompressor()
    for name, data in {"p.jsonl": rows, "g.jsonl": gzip.compress(rows), "z.json.gz": z.compress(rows), "n.zst": z.compress(gzip.compress(rows))}.items():
        (tmp_path / name).write_bytes(data)
        assert ids(readers.read(spark, Source("s", "jsonl", [str(tmp_path / name)]))) == ["a", "s/1", "s/2"]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "b.jsonl").write_bytes(LINE({"id": "a", "text": "x"}) + b"\n{broken")
    with pytest.raises(Exception):
        readers.read(spark, Source("s", "jsonl", [str(tmp_path / "bad")])).collect()
    assert ids(readers.read(spark, Source("s", "jsonl", [str(tmp_path / "bad")], lenient=True))) == ["a"]
    assert ids(readers.read(spark, Source("s", "jsonl", [str(tmp_path / "p.jsonl")], skip=1, limit=2))) == ["s/1"]
    files = spark.read.format("binaryFile").load([str(tmp_path / "z.json.gz")])
    cut = files.select("path", F.substring("content", 1, 20).alias("content"))
    assert readers.verify(files).first().status == "ok" and readers.verify(cut).first().status == "corrupt"


def test_wiki_html_code_text_csv(spark, tmp_path):
    page = lambda i, ns, text: f"<page><title>T{i}</title><ns>{ns}</ns><id>{i}</id><revision><text>{text}</text></revision></page>"
    (tmp_path / "w.xml").write_text("<mediawiki>" + page(1, 0, "[[Beta|Beta page]] ''body'' {{x}}") + page(2, 1, "talk") + page(3, 0, " ") + "</mediawiki>")
    assert [(r.id, r.text.strip()) for r in readers.read(spark, Source("w", "wiki", [str(tmp_path / "w.xml")])).collect()] == [("w/1", "Beta page body")]
    tree = tmp_path / "repo"
    (tree / "node_modules").mkdir(parents=True)
    (tree / "a.py").write_text("print(1)")
    (tree / "b.bin").write_text("x")
    (tree / "c.py").write_bytes(b"a\0b")
    (tree / "node_modules" / "d.js").write_text("x")
    assert ids(readers.read(spark, Source("r", "code", [str(tree)]))) == ["r/a.py"]
    assert ids(readers.read(spark, Source("r", "code", [str(tree)], include_extensions=[".JS", ".bin"], exclude_dirs=[]))) == ["r/b.bin", "r/node_modules/d.js"]
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "p.html").write_text("<title>Hi</title><nav>menu</nav><article>Body <b>text</b></article><script>x()</script>")
    r = readers.read(spark, Source("h", "html", [str(tmp_path / "h")])).first()
    assert r.id == "h/p" and "Body text" in r.text and "menu" not in r.text and json.loads(r.metadata)["title"] == "Hi"
    (tmp_path / "c.csv").write_text('id,text\n1,"two\nlines"\n2,x\n')
    assert ids(readers.read(spark, Source("c", "csv", [str(tmp_path / "c.csv")]))) == ["1", "2"]
    assert len(readers.read(spark, Source("t", "text", [str(tree)])).collect()) == 3


@pytest.mark.parametrize("mode", ["serial", "partitioned"])
def test_run(spark, tmp_path, mode):
    base = " ".join(f"word{i} about things" for i in range(60)) + "."
    (tmp_path / "a.jsonl").write_bytes(LINE({"id": "a", "text": base}, {"id": "b", "text": base.upper()}, {"id": "s", "text": "short"}))
    (tmp_path / "b.jsonl").write_bytes(LINE({"id": "c", "text": base + " extra"}, {"id": "d", "text": "Entirely other text, written for this test alone. " * 3}))
    sources = [Source("x", "jsonl", [str(tmp_path / "a.jsonl")]), Source("y", "jsonl", [str(tmp_path / "b.jsonl")])]
    out = str(tmp_path / mode)
    run = Run(sources, out, C.Cleaning(min_quality=0.1), mode=mode, threshold=8, state=str(tmp_path / f"state-{mode}"))
    spark.createDataFrame([], "hash string, bits bigint").write.parquet(f"{run.state}/run=before")
    total = next(c for c in preprocess(spark, run) if c["source"] == "TOTAL")
    assert total == {"source": "TOTAL", "seen": 5, "written": 2, "rejected": 3, "rejected_exact_duplicate": 1, "rejected_near_duplicate": 1, "rejected_too_short": 1}
    # cut off before the rejected rows and the counters were written: what is there stays, the rest is done
    shards = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{out}/shards") for f in fs}
    shutil.rmtree(f"{out}/rejected")
    shutil.rmtree(f"{out}/stats")
    assert next(c for c in preprocess(spark, run, resume=True) if c["source"] == "TOTAL") == total
    assert spark.read.json(f"{out}/rejected").count() == 3 and shards == {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{out}/shards") for f in fs}
    with pytest.raises(ValueError, match="another configuration"):
        preprocess(spark, Run(sources[:1], out, run.rules, mode=mode), resume=True)
    simhash = [json.loads(r.metadata).get("simhash") for r in spark.read.parquet(f"{out}/shards").collect()]
    assert all(x and 0 <= int(x) < 1 << 64 for x in simhash)
    assert ids(spark.read.parquet(f"{out}/shards")) == ["a", "d"]
    schema = sinks.build_manifest(spark, f"{out}/shards", "all").schema
    meta = sinks.validate_manifest(spark, f"{out}/manifest", schema)
    assert meta["total_records"] == 2
    again = Run(sources, out + "-again", run.rules, mode=mode, threshold=8, state=run.state, name="1")
    assert next(c for c in preprocess(spark, again) if c["source"] == "TOTAL")["written"] == 0
    shard = next(os.path.join(d, f) for d, _, fs in os.walk(f"{out}/shards") for f in fs if f.endswith(".parquet"))
    os.remove(os.path.join(os.path.dirname(shard), "." + os.path.basename(shard) + ".crc"))
    with open(shard, "ab") as f:
        f.write(b"x")
    with pytest.raises(ValueError, match="shards differ"):
        sinks.validate_manifest(spark, f"{out}/manifest", schema)


def test_config(tmp_path, monkeypatch):
    (tmp_path / "base.json").write_text('{"a": {"x": 1, "y": [1, 2]}, "p": "${QUERN_T:-dflt}/d"}')
    (tmp_path / "top.json").write_text('{"extends": "base.json", "a": {"y": [3]}}')
    assert config.load(tmp_path / "top.json", ["a.x=5", "b.c=text"]) == {"a": {"x": 5, "y": [3]}, "p": "dflt/d", "b": {"c": "text"}}
    (tmp_path / "top.json").write_text('{"extends": "top.json"}')
    with pytest.raises(ValueError):
        config.load(tmp_path / "top.json")
    with pytest.raises(ValueError):
        config.built(C.Cleaning, {"unknown": 1})
    assert readers.resolve_urls(["b"], ["# no\na\n"], ["x.parquet", "y.csv"], ["*.parquet"]) == ["a", "b", "x.parquet"]


def test_text_functions(spark):
    row = spark.range(1).select(
        T.clean(F.lit("  a \x01 b\r\n\n 　c d \t e  ")).alias("clean"), nfkc(F.lit("ﬁ Ａ")).alias("nfkc"), H.slot(F.sha2(F.lit("x"), 256), 7).alias("slot"),
        T.join_paragraphs(F.lit('[{"内容":"a","是否重复":true},{"内容":" b "}]'), True).alias("p"), T.join_paragraphs(F.lit("plain"), True).alias("q"), T.human_bytes(F.lit(1536.0)).alias("h"), T.safe_name(F.lit("a/b é-1.x")).alias("s"),
        html_text(F.lit("<title>T</title><p>x<style>y</style></p>")).alias("html"),
    ).first()
    import hashlib

    assert row.clean == "a b\nc\nd e" and row.nfkc == "fi A" and row.slot == int(hashlib.sha256(b"x").hexdigest(), 16) % 7
    assert (row.p, row.q, row.h, row.s, row.html.title) == ("b", "plain", "1.5KiB", "a_b_é-1_x", "T")
