import datetime as dt

import public_tokenizers as P
from pyspark.sql import functions as F

from quern.operators import tokenizers as T
from quern.streaming import incremental as S


def test_dedup_goes_on_from_its_checkpoint(spark, tmp_path):
    schema = "doc_id bigint, text string"
    at = {k: str(tmp_path / k) for k in ("in", "state", "out")}

    def arrive(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(at["in"])
        S.run_to_end(S.new_documents(S.arriving(spark, at["in"], schema)), at["state"], at["out"])
        return spark.read.parquet(at["out"]).count()

    assert arrive([(1, "A  b"), (2, "a b"), (3, None)]) == 2
    assert arrive([(4, "a b"), (5, "c")]) == 3
    assert arrive([(6, "C"), (7, "")]) == 3


def test_late_rows_are_dropped(spark, tmp_path):
    t = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    schema = "ts timestamp, kind string"
    at = {k: str(tmp_path / k) for k in ("in", "state", "out")}
    for rows in ([(t(1), "a"), (t(2), "a"), (t(3), "b")], [(t(200), "a")], [(t(4), "a"), (t(400), "b")], [(t(800), "a")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(at["in"])
        S.run_to_end(S.windowed_counts(S.arriving(spark, at["in"], schema), "ts", "kind", "1 hour", "30 minutes"), at["state"], at["out"])
    got = {(r.start, r.kind): r.n for r in spark.read.parquet(at["out"]).collect()}
    assert got[(t(0), "a")] == 2 and got[(t(0), "b")] == 1


def test_tokenizers(spark):
    d = spark.createDataFrame([(1, "en", "hello there"), (2, "en", ""), (3, "fr", "été")], "doc_id bigint, lang string, text string")
    for path in (P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json")):
        back = d.select("text", T.text(path)(T.ids(path)(F.col("text"))).alias("back")).collect()
        assert all(r.text == r.back for r in back)
        assert T.inspected(d, "text", "lang", T.ids(path)).where("lang = 'en'").first().abnormal == 1
    assert d.select(T.ids(None)(F.col("text")).alias("i")).first().i[0] == 1 + ord("h")
    assert T.special_ids(P.path("piece_bpe_32k.model"))["<s>"] == 1
