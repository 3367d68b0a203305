"""Manifest algebra, over a manifest made from documents: a shard for each source and language."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import hashing as H
from quern.functions import text as T
from quern.operators import manifest as N
from quern.plans.base import query, table

WORLD, WORKERS, SEED, TARGET = 2, 3, 42, 2000

_MF = """mf AS (SELECT source || '/' || lang AS uri, source, lang AS domain, count(*) AS num_records, CAST(sum(strlen(text)) AS BIGINT) AS bytes,
  CAST(sum(greatest(1, strlen(text) // 4)) AS BIGINT) AS estimated_tokens, sha256(source || '/' || lang) AS sha256 FROM documents GROUP BY ALL)"""
_SLOTS = f"""{_MF}, sl AS (SELECT *, list_reduce(list_prepend(0::BIGINT, list_transform(string_split(sha256, ''), lambda c: ('0x' || c)::BIGINT)), lambda a, c: (a * 16 + c) % {WORLD * WORKERS}) AS slot, md5('{SEED}:' || uri) AS key FROM mf)"""
_SPLIT = f"""{_SLOTS}, sp AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY slot, key DESC) = 1 THEN CAST(greatest(1, least(num_records, ceil({TARGET} / greatest(1.0, bytes * 0.4::DOUBLE / greatest(1, num_records))))) AS BIGINT) END AS take FROM sl)"""


def manifest(spark, at):
    d = table(spark, at, "documents").withColumn("uri", F.concat("source", F.lit("/"), "lang"))
    m = N.inspect(d, "uri")
    return m.withColumn("source", F.split("uri", "/")[0]).withColumn("domain", F.split("uri", "/")[1])


@query("manifest_inspect", f"WITH {_MF} SELECT uri, num_records, bytes, estimated_tokens, sha256 FROM mf")
def manifest_inspect(spark, at):
    return manifest(spark, at).select("uri", "num_records", "bytes", "estimated_tokens", "sha256")


@query("manifest_totals", f"WITH {_MF} SELECT count(*) AS num_shards, CAST(sum(bytes) AS BIGINT) AS total_bytes, CAST(sum(num_records) AS BIGINT) AS total_records, CAST(sum(estimated_tokens) AS BIGINT) AS total_estimated_tokens FROM mf")
def manifest_totals(spark, at):
    return N.totals(manifest(spark, at))


@query("manifest_shares", f"WITH {_MF} SELECT coalesce(source, 'TOTAL') AS source, count(*) AS shards, CAST(sum(estimated_tokens) AS BIGINT) AS tokens, round(100.0 * sum(estimated_tokens)::DOUBLE / (SELECT sum(estimated_tokens) FROM mf)::DOUBLE, 6) AS share FROM mf GROUP BY ROLLUP (source)")
def manifest_shares(spark, at):
    return N.shares(manifest(spark, at), "source")


@query("token_estimate_by_source", "SELECT source, CAST(sum(greatest(1, strlen(text) // 4)) AS BIGINT) AS tokens, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents GROUP BY ALL")
def token_estimate_by_source(spark, at):
    return table(spark, at, "documents").groupBy("source").agg(F.sum(T.token_estimate(F.col("text"))).cast("bigint").alias("tokens"), F.sum(F.octet_length("text")).cast("bigint").alias("bytes"))


@query("shard_slots", f"WITH {_SLOTS} SELECT uri, slot, slot // {WORKERS} AS rank, slot % {WORKERS} AS worker FROM sl")
def shard_slots(spark, at):
    return N.with_slots(manifest(spark, at), WORLD, WORKERS).select("uri", "slot", "rank", "worker")


@query("val_split", f"WITH {_SPLIT} SELECT source, uri, 0::BIGINT AS record_start, take AS record_end FROM sp WHERE take IS NOT NULL")
def val_split(spark, at):
    return N.held_out(_split(spark, at)).select("source", "uri", "record_start", "record_end")


@query("train_minus_val", f"WITH {_SPLIT} SELECT uri, coalesce(take, 0) AS record_start, num_records - coalesce(take, 0) AS n FROM sp WHERE take IS NULL OR take < num_records")
def train_minus_val(spark, at):
    return N.remainder(_split(spark, at)).select("uri", "record_start", N.effective_records().cast("bigint").alias("n"))


def _split(spark, at):
    return N.validation_split(manifest(spark, at), TARGET, WORLD, WORKERS, SEED, by="source")


_PRUNED = f"""{_SLOTS}, tg(source, target) AS (VALUES ('src0', 60000), ('src1', 4000), ('src2', NULL), ('src3', 2000)),
f AS (SELECT *, (domain = 'fr' AND source IN ('src0', 'src1')) AS forced FROM sl LEFT JOIN tg USING (source)),
g AS (SELECT *, coalesce(sum(CASE WHEN NOT forced THEN estimated_tokens END) OVER (PARTITION BY source, slot ORDER BY key, uri ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  + coalesce(sum(CASE WHEN forced THEN estimated_tokens END) OVER (PARTITION BY source, slot), 0) AS before FROM f),
n AS (SELECT source, count(DISTINCT slot) AS slots FROM sl GROUP BY ALL),
pr AS (SELECT *, forced OR target IS NULL OR before < target / slots AS kept FROM g JOIN n USING (source))"""


def _pruned(spark, at):
    m = manifest(spark, at)
    targets = spark.sql("SELECT * FROM VALUES ('src0', 60000L), ('src1', 4000L), ('src2', NULL), ('src3', 2000L) AS t(source, target)")
    return N.prune(m, targets, m.where("domain = 'fr' and source in ('src0', 'src1')").select("uri"), by="source", world=WORLD, workers=WORKERS, seed=SEED)


@query("prune_manifest", f"WITH {_PRUNED} SELECT uri, slot, kept FROM pr")
def prune_manifest(spark, at):
    return _pruned(spark, at).select("uri", "slot", "kept")


@query("drop_uris", f"WITH {_PRUNED} SELECT uri FROM mf EXCEPT SELECT uri FROM pr WHERE kept")
def drop_uris(spark, at):
    return manifest(spark, at).select("uri").subtract(_pruned(spark, at).where("kept").select("uri"))


@query("prune_audit", f"WITH {_PRUNED} SELECT source, count(*) AS entries, count(*) FILTER (kept) AS kept_entries, CAST(sum(estimated_tokens) AS BIGINT) AS tokens, CAST(coalesce(sum(estimated_tokens) FILTER (kept), 0) AS BIGINT) AS kept_tokens, CAST(floor(coalesce(sum(estimated_tokens) FILTER (kept), 0) * 1.6) AS BIGINT) AS kept_real FROM pr GROUP BY ALL")
def prune_audit(spark, at):
    kept = F.coalesce(F.sum(F.when(F.col("kept"), F.col("estimated_tokens"))), F.lit(0))
    return _pruned(spark, at).groupBy("source").agg(F.count(F.lit(1)).alias("entries"), F.count_if("kept").alias("kept_entries"), F.sum("estimated_tokens").cast("bigint").alias("tokens"), kept.cast("bigint").alias("kept_tokens"), F.floor(kept * 1.6).cast("bigint").alias("kept_real"))


_RUNS = """ru AS (SELECT 'run' || (CAST(substr(source, 4) AS INTEGER) % 4) AS run, uri FROM mf), ch(run, parent) AS (VALUES ('run3', 'run1'), ('run1', 'run0'), ('run0', 'run3'), ('run2', NULL)),
us AS (SELECT DISTINCT uri FROM ru WHERE run IN ('run3', 'run1', 'run0'))"""


def _consumed(spark, at):
    m = manifest(spark, at)
    runs = m.select(F.concat(F.lit("run"), F.substring("source", 4, 9).cast("int") % 4).alias("run"), "uri")
    chain = spark.sql("SELECT * FROM VALUES ('run3', 'run1'), ('run1', 'run0'), ('run0', 'run3'), ('run2', NULL) AS t(run, parent)")
    return m, N.consumed(runs, chain, "run3")


@query("consumed_chain", f"WITH {_MF}, {_RUNS} SELECT uri FROM us")
def consumed_chain(spark, at):
    return _consumed(spark, at)[1]


@query("unconsumed_shards", f"WITH {_MF}, {_RUNS} SELECT uri, num_records FROM mf WHERE uri NOT IN (SELECT uri FROM us)")
def unconsumed_shards(spark, at):
    m, used = _consumed(spark, at)
    return N.without(m, used).select("uri", "num_records")


@query("consumed_ratio", f"WITH {_MF}, {_RUNS} SELECT source, count(*) AS total, count(us.uri) AS consumed, round(count(us.uri) / count(*), 6) AS ratio FROM mf LEFT JOIN us USING (uri) GROUP BY ALL")
def consumed_ratio(spark, at):
    m, used = _consumed(spark, at)
    return m.join(used.withColumn("used", F.lit(1)), "uri", "left").groupBy("source").agg(F.count(F.lit(1)).alias("total"), F.count("used").alias("consumed"), F.round(F.count("used") / F.count(F.lit(1)), 6).alias("ratio"))


@query("force_keep_shards", f"WITH {_SPLIT} SELECT uri FROM mf WHERE uri IN (SELECT uri FROM sp WHERE take IS NOT NULL)")
def force_keep_shards(spark, at):
    return N.only(manifest(spark, at), _split(spark, at).where("take is not null")).select("uri")


@query("merge_conflicts", f"WITH {_MF}, u AS (SELECT uri FROM mf WHERE domain <> 'fr' UNION ALL SELECT uri FROM mf WHERE source IN ('src1', 'src2')) SELECT uri, count(*) AS copies FROM u GROUP BY ALL HAVING count(*) > 1")
def merge_conflicts(spark, at):
    m = manifest(spark, at).withColumn("record_start", F.lit(0)).withColumn("record_end", F.lit(None).cast("int"))
    return N.duplicates(m.where("domain <> 'fr'"), m.where("source in ('src1', 'src2')")).select("uri", "copies")


@query("merge_manifests", f"WITH {_MF} SELECT uri, estimated_tokens FROM mf WHERE source <> 'src5'")
def merge_manifests(spark, at):
    m = manifest(spark, at).where("source <> 'src5'").withColumn("record_start", F.lit(0)).withColumn("record_end", F.lit(None).cast("int"))
    return N.merge(m.where("domain = 'fr'"), m.where("domain = 'de'"), m.where("domain not in ('fr', 'de')")).select("uri", "estimated_tokens")


@query("slot_cursors", f"""WITH {_MF}, s7 AS (SELECT uri, md5('{SEED}:' || uri) AS key, list_reduce(list_prepend(0::BIGINT, list_transform(string_split(sha256, ''), lambda c: ('0x' || c)::BIGINT)), lambda a, c: (a * 16 + c) % 200) AS slot FROM mf)
SELECT range AS slot, coalesce(min_by(uri, key), '') AS uri FROM range(200) LEFT JOIN s7 ON slot = range GROUP BY range""")
def slot_cursors(spark, at):
    return N.cursors(manifest(spark, at), 50, 4, SEED).select("slot", F.coalesce("uri", F.lit("")).alias("uri"))


@query("seeded_shuffle", f"WITH {_MF} SELECT uri, row_number() OVER (PARTITION BY source ORDER BY md5('7:' || uri)) AS n FROM mf")
def seeded_shuffle(spark, at):
    from pyspark.sql import Window

    return manifest(spark, at).select("uri", F.row_number().over(Window.partitionBy("source").orderBy(H.shuffled(7, F.col("uri")))).cast("bigint").alias("n"))


_MIX = f"{_MF}, wm AS (SELECT *, CASE domain WHEN 'en' THEN 2.0::DOUBLE WHEN 'fr' THEN 1.0 WHEN 'de' THEN 0.5 ELSE 0.0 END AS weight FROM mf)"


def _weighted(spark, at):
    return manifest(spark, at).withColumn("weight", F.when(F.col("domain") == "en", 2.0).when(F.col("domain") == "fr", 1.0).when(F.col("domain") == "de", 0.5).otherwise(0.0))


@query("mixture_probabilities", f"WITH {_MIX}, d AS (SELECT domain, sum(estimated_tokens * weight) AS w FROM wm GROUP BY ALL) SELECT domain, round(w, 3) AS weight, round(pow(greatest(w, 1e-12), 1.0 / 2) / sum(pow(greatest(w, 1e-12), 1.0 / 2)) OVER (), 6) AS probability FROM d")
def mixture_probabilities(spark, at):
    return N.mixture(_weighted(spark, at), "domain", temperature=2.0).select("domain", F.round("weight", 3).alias("weight"), F.round("probability", 6).alias("probability"))


@query("realised_ratio", f"WITH {_MF} SELECT source, round(sum(estimated_tokens)::DOUBLE / (sum(sum(estimated_tokens)) OVER ())::DOUBLE, 6) AS ratio FROM mf GROUP BY source")
def realised_ratio(spark, at):
    m = manifest(spark, at).groupBy("source").agg(F.sum("estimated_tokens").alias("t"))
    total = m.agg(F.sum("t").alias("all"))
    return m.join(F.broadcast(total)).select("source", F.round(F.col("t") / F.col("all"), 6).alias("ratio"))


@query("unresolved_blobs", "SELECT page_id FROM pages WHERE strlen(html) BETWEEN 500 AND 4000 AND page_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'fr')")
def unresolved_blobs(spark, at):
    p = table(spark, at, "pages").where(F.octet_length("html").between(500, 4000)).select("page_id")
    return p.join(table(spark, at, "documents").where("lang = 'fr'").select(F.col("doc_id").alias("page_id")), "page_id", "left_anti")


@query("shard_formats", "SELECT page_id, coalesce(regexp_extract(lower(url), '\\.(jsonl|ndjson|json|parquet|csv|txt|xml|html?)(?:\\.(?:gz|zst))?$', 1), '') AS ext FROM pages")
def shard_formats(spark, at):
    return table(spark, at, "pages").select("page_id", F.lower(F.regexp_extract("url", r"(?i)\.(jsonl|ndjson|json|parquet|csv|txt|xml|html?)(?:\.(?:gz|zst))?$", 1)).alias("ext"))
