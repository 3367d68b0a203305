"""How shards and budgets are dealt out."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import hashing as H
from quern.operators import layout as L
from quern.operators import manifest as N
from quern.plans.base import query, table

_FILES = "f AS (SELECT 'part_' || source || '_' || lpad((doc_id % 7)::VARCHAR, 6, '0') || '.parquet' AS name, source, lang AS domain, n_chars FROM documents)"


def _files(spark, at):
    d = table(spark, at, "documents")
    return d.select(L.shard_name("part", F.col("source"), F.col("doc_id") % 7, "parquet").alias("name"), "source", F.col("lang").alias("domain"), "n_chars")


@query("band_slots", "SELECT o_orderkey, (o_custkey + (o_orderkey % 4) * 1000003) % 16 AS slot FROM orders")
def band_slots(spark, at):
    return table(spark, at, "orders").select("o_orderkey", L.band_slot(F.col("o_orderkey") % 4, F.col("o_custkey"), 16).alias("slot"))


@query("hex_slots", "SELECT doc_id, CAST(('0x' || CASE WHEN regexp_full_match(substr(v, 1, 8), '[0-9a-fA-F]+') THEN substr(v, 1, 8) ELSE substr(sha1(v), 1, 8) END)::UBIGINT % 13 AS BIGINT) AS slot FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source || lang ELSE md5(source) END AS v FROM documents)")
def hex_slots(spark, at):
    v = F.when(F.col("doc_id") % 3 == 0, F.concat("source", "lang")).otherwise(F.md5("source"))
    return table(spark, at, "documents").select("doc_id", L.hex_slot(v, 13).alias("slot"))


@query("worker_budgets", "WITH b AS (SELECT lang, CAST(sum(strlen(text)) AS BIGINT) AS budget FROM documents GROUP BY ALL) SELECT lang, w::INTEGER AS worker, budget // 7 + CASE WHEN w < budget % 7 THEN 1 ELSE 0 END AS share FROM b, range(7) AS t(w)")
def worker_budgets(spark, at):
    b = table(spark, at, "documents").groupBy("lang").agg(F.sum(F.octet_length("text")).cast("bigint").alias("budget"))
    return L.split_budget(b, "budget", 7).select("lang", "worker", "share")


@query("next_shard_numbers", f"WITH {_FILES} SELECT source, max(n) + 1 AS next FROM (SELECT regexp_extract(name, '^part_(.*)_[0-9]+', 1) AS source, CAST(regexp_extract(name, '_([0-9]+)[.]', 1) AS BIGINT) AS n FROM f) GROUP BY source")
def next_shard_numbers(spark, at):
    return L.next_numbers(_files(spark, at).select("name"), "name", "part")


@query("selected_shards", f"WITH {_FILES}, m AS (SELECT DISTINCT name, source, domain FROM f) SELECT name, source, domain FROM m WHERE source IN ('src1', 'src4') AND domain IN ('en', 'fr') ORDER BY name, domain LIMIT 9")
def selected_shards(spark, at):
    m = _files(spark, at).select("name", "source", "domain").distinct().withColumn("place", F.concat("name", F.lit(" "), "domain"))
    return L.selected(m, ["src1", "src4"], ["en", "fr"], 9, "place").select("name", "source", "domain")


@query("pending_files", """WITH log AS (SELECT user_id AS path, event_id AS n, length(event_type) AS size_bytes, event_id % 3 AS mtime_ns FROM events),
last AS (SELECT path, max_by(size_bytes, n) AS s, max_by(mtime_ns, n) AS m FROM log GROUP BY path),
files AS (SELECT DISTINCT user_id AS path, length('purchase') AS size_bytes, user_id % 3 AS mtime_ns FROM events)
SELECT path, CAST(size_bytes AS BIGINT) AS size_bytes, mtime_ns FROM files WHERE NOT EXISTS (SELECT 1 FROM last WHERE last.path = files.path AND s = size_bytes AND m = mtime_ns)""")
def pending_files(spark, at):
    e = table(spark, at, "events")
    log = e.select(F.col("user_id").alias("path"), F.col("event_id").alias("n"), F.length("event_type").cast("bigint").alias("size_bytes"), (F.col("event_id") % 3).alias("mtime_ns"))
    files = e.select(F.col("user_id").alias("path")).distinct().select("path", F.lit(len("purchase")).cast("bigint").alias("size_bytes"), (F.col("path") % 3).alias("mtime_ns"))
    return L.pending(files, log)


@query("mixture_left_over", "WITH w AS (SELECT lang AS source, count(*)::DOUBLE AS weight FROM documents GROUP BY lang HAVING lang <> 'de') SELECT source, round(weight / sum(weight) OVER (), 9) AS probability FROM w")
def mixture_left_over(spark, at):
    d = table(spark, at, "documents")
    w = d.groupBy(F.col("lang").alias("source")).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return L.left_over(w, d.where("lang = 'de'").select(F.col("lang").alias("source"))).select("source", F.round("probability", 9).alias("probability"))


@query("byte_round_trip", "SELECT doc_id, sha256(coalesce(text, '')) AS text FROM documents")
def byte_round_trip(spark, at):
    text = F.coalesce("text", F.lit(""))
    ids = table(spark, at, "documents").select("doc_id", H.byte_ids(text, 258).alias("ids"))
    return ids.select("doc_id", F.sha2(H.byte_text(F.col("ids"), 258), 256).alias("text"))


@query("appended_run", "SELECT 'a' || p_partkey AS id, 'base/' || p_partkey AS uri FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT 'b' || p_partkey, 'base/shards/in/' || p_partkey || '.parquet' FROM part WHERE p_partkey % 3 = 1")
def appended_run(spark, at):
    p = table(spark, at, "part").select("p_partkey")
    base = p.where("p_partkey % 3 = 0").select(F.concat(F.lit("a"), "p_partkey").alias("id"), F.concat(F.lit("base/"), "p_partkey").alias("uri"))
    run = p.where("p_partkey % 3 = 1").select(F.concat(F.lit("b"), "p_partkey").alias("id"), F.concat(F.lit("run/shards/"), "p_partkey", F.lit(".parquet")).alias("uri"))
    return N.append_run(base, run, "run/shards", "base/shards/in/")
