"""Exact and near duplicates over whole documents."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from quern.functions import hashing as H
from quern.functions import text as T
from quern.functions.arrow import simhash_blake2b
from quern.operators import cleaning as C
from quern.operators import dedup as D
from quern.plans.base import SQL_CLEANED, SQL_DEDUP, keep, query, sql_clean, sql_reasons, table

_HASHED = f"h AS (SELECT doc_id, source, sha256({SQL_DEDUP('text')}) AS hash FROM documents)"


def _hashed(spark, at):
    return table(spark, at, "documents").select("doc_id", "source", T.exact_hash(F.col("text")).alias("hash"))


@query("exact_dedup_keep", f"WITH {_HASHED} SELECT doc_id, hash FROM h QUALIFY doc_id = min(doc_id) OVER (PARTITION BY hash)")
def exact_dedup_keep(spark, at):
    return D.exact(_hashed(spark, at), "doc_id", "hash").where("doc_id = first_id").select("doc_id", "hash")


@query("exact_dedup_drops", f"WITH {_HASHED} SELECT doc_id, first_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY hash) AS first_id FROM h) WHERE doc_id <> first_id")
def exact_dedup_drops(spark, at):
    return D.exact(_hashed(spark, at), "doc_id", "hash").where("doc_id <> first_id").select("doc_id", "first_id")


@query("dedup_against_state", f"WITH {_HASHED} SELECT doc_id FROM h WHERE source <> 'src3' AND hash NOT IN (SELECT hash FROM h WHERE source = 'src3')")
def dedup_against_state(spark, at):
    h = _hashed(spark, at)
    return D.against_state(h.where("source <> 'src3'"), h.where("source = 'src3'"), "hash").select("doc_id")


_BITS = ", ".join(f"sum(CASE WHEN ({c} >> {i}) & 1 = 1 THEN 1 ELSE -1 END) AS {c}{i}" for c in ("hi", "lo") for i in range(32))
_WORD = lambda c: " + ".join(f"CASE WHEN {c}{i} >= 0 THEN {1 << i}::UBIGINT ELSE 0 END" for i in range(32))
_SIMHASH = rf"""{SQL_CLEANED},
w0 AS (SELECT doc_id, regexp_extract_all(lower(clean), '{T.WORD}') AS ws, lower(clean) AS low FROM m),
w AS (SELECT doc_id, unnest(CASE WHEN len(ws) > 0 THEN ws ELSE [low] END) AS token FROM w0),
v AS (SELECT doc_id, ('0x' || substr(md5(token), 1, 8))::UBIGINT::BIGINT AS hi, ('0x' || substr(md5(token), 9, 8))::UBIGINT::BIGINT AS lo FROM w),
b AS (SELECT doc_id, {_BITS} FROM v GROUP BY doc_id),
p AS (SELECT doc_id, (({_WORD('hi')}) << 32) | ({_WORD('lo')}) AS fp FROM b)"""


def _prints(spark, at):
    d = table(spark, at, "documents").select("doc_id", T.clean(F.coalesce("text", F.lit(""))).alias("clean"))
    return H.simhash_md5(d, "doc_id", "clean")


@query("simhash_md5", f"WITH {_SIMHASH} SELECT doc_id, fp::VARCHAR AS simhash FROM p")
def simhash_md5(spark, at):
    return _prints(spark, at).select("doc_id", "simhash")


@query("simhash_bands", f"WITH {_SIMHASH} SELECT doc_id, i::INTEGER AS band, ((fp >> (16 * i)) & 65535)::BIGINT AS value FROM p, unnest([0, 1, 2, 3]) AS t(i)")
def simhash_bands(spark, at):
    return _prints(spark, at).select("doc_id", F.posexplode(H.bands(F.col("bits"))).alias("band", "value"))


def _distinct_prints(spark, at):
    return _prints(spark, at).groupBy("bits").agg(F.min("doc_id").alias("doc_id"))


@query("near_dup_pairs", f"""WITH {_SIMHASH}, q AS (SELECT fp, min(doc_id) AS doc_id FROM p GROUP BY fp)
SELECT x.doc_id AS a, y.doc_id AS b, bit_count(xor(x.fp, y.fp))::BIGINT AS distance FROM q x JOIN q y ON x.doc_id < y.doc_id AND bit_count(xor(x.fp, y.fp)) <= 3""")
def near_dup_pairs(spark, at):
    return D.pairs(keep(_distinct_prints(spark, at)), "doc_id")


@query("near_dup_classes", f"WITH {_SIMHASH} SELECT doc_id, min(doc_id) OVER (PARTITION BY fp) AS class_id FROM p")
def near_dup_classes(spark, at):
    p = keep(_prints(spark, at).select("doc_id", "bits"))
    return D.exact(p, "doc_id", "bits").select("doc_id", F.col("first_id").alias("class_id"))


def _own_votes():
    """What a cleaned document votes, if it passes so far: its text is of no more use, and is not kept."""
    return H.md5_votes(F.when(F.col("reason").isNull(), F.col("clean"))).alias("votes")


def serial_reasons(docs, rules):
    """(doc_id, reason, kept_by): the one-pass mode: cleaning, then exact and near copies of what was kept, then quality.

    A copy of a kept text is exact; a copy of a text that was itself dropped as
    near is near.  Equal fingerprints are one row for the pair search.
    """
    base = C.with_reasons(docs, replace(rules, min_quality=0.0), columns=[_own_votes()])
    prints = keep(H.simhash_of(base.where("reason is null").select("doc_id", "votes"), "doc_id").select("doc_id", "bits"))
    base = base.select("doc_id", "reason", "hash", "quality_score")
    passed = keep(base.where("reason is null or reason = 'exact_duplicate'").select("doc_id", "hash"))
    first = D.exact(passed, "doc_id", "hash")
    heads = D.exact(prints, "doc_id", "bits")
    edges = D.pairs(heads.where("doc_id = first_id").select("doc_id", "bits"), "doc_id").select("a", "b")
    near = D.greedy(edges, keep)
    # equal fingerprints share their first one's fate, but for that one itself
    dropped = heads.join(near, F.col("first_id") == F.col("id"), "left").select("doc_id", F.coalesce("kept_by", F.when(F.col("doc_id") != F.col("first_id"), F.col("first_id"))).alias("kept_by")).where("kept_by is not null")
    dropped = keep(dropped)
    own = first.join(dropped.withColumnRenamed("doc_id", "first_id"), "first_id", "left").select("doc_id", "first_id", "kept_by")
    label = F.when(F.col("kept_by").isNotNull(), "near_duplicate").when(F.col("doc_id") != F.col("first_id"), "exact_duplicate")
    labels = own.select(F.col("doc_id").alias("d"), label.alias("dup"), F.coalesce("kept_by", F.when(F.col("doc_id") != F.col("first_id"), F.col("first_id"))).alias("by"))
    out = base.join(labels, F.col("doc_id") == F.col("d"), "left")
    other = F.when(F.col("reason") != "exact_duplicate", F.col("reason"))
    return out.select("doc_id", F.coalesce("dup", other, F.when(F.col("quality_score") < rules.min_quality, "low_quality"), F.lit("kept")).alias("reason"), F.col("by").alias("kept_by"))


@query("near_dup_serial")
def near_dup_serial(spark, at):
    return serial_reasons(table(spark, at, "documents"), C.Cleaning())


def partitioned_reasons(docs, rules, print_of=None, cap=4096):
    """(doc_id, reason, capped): the partitioned mode: quality first, exact copies by hash, near copies per band's group, exact before near.

    capped: the row came to a group that already held `cap` kept ones, and wasn't
    compared with the later ones there; the serial mode has no such bound.
    """
    own = _own_votes() if print_of is None else print_of(F.col("clean")).alias("print")
    base = C.with_reasons(docs, rules, quality_first=True, columns=[own])
    candidates = base.where("reason is null or reason = 'exact_duplicate'")
    if print_of is None:
        prints = H.simhash_of(candidates.select("doc_id", "votes"), "doc_id").select("doc_id", "bits")
    else:
        number = F.col("print").cast("decimal(20,0)")
        half = F.lit(str(1 << 63)).cast("decimal(20,0)")  # the number as a signed one
        prints = candidates.select("doc_id", F.when(number >= half, number - half - half).otherwise(number).cast("bigint").alias("bits"))
    prints = keep(prints)
    near = D.banded_groups(prints, "doc_id", cap=cap).select(F.col("id").alias("d"), "first_id", F.col("capped").alias("full"))
    out = base.join(near, F.col("doc_id") == F.col("d"), "left")
    reason = F.coalesce("reason", F.when(F.col("first_id").isNotNull(), "near_duplicate"), F.lit("kept"))
    return out.select("doc_id", reason.alias("reason"), (F.coalesce("full", F.lit(False)) & (reason == "kept")).alias("capped"))


@query("near_dup_partitioned")
def near_dup_partitioned(spark, at):
    return partitioned_reasons(table(spark, at, "documents"), C.Cleaning())


@query("simhash_blake2b")
def simhash_blake2b_query(spark, at):
    return table(spark, at, "documents").select("doc_id", simhash_blake2b(T.clean(F.coalesce("text", F.lit("")))).alias("simhash"))


@query("near_dup_partitioned_blake2b")
def near_dup_partitioned_blake2b(spark, at):
    return partitioned_reasons(table(spark, at, "documents"), C.Cleaning(), simhash_blake2b)


@query("drop_reasons", f"""WITH {sql_reasons(alpha=0.75, rep=0.10, quality=0.95)}, d AS (
  SELECT doc_id, 0 AS priority, 'exact' AS reason FROM r WHERE reason = 'exact_duplicate' UNION ALL SELECT doc_id, 1, 'labelled' FROM labels WHERE toxic = 1)
SELECT doc_id, min_by(reason, priority) AS reason FROM d GROUP BY doc_id""")
def drop_reasons(spark, at):
    exact = C.with_reasons(table(spark, at, "documents"), C.STRICT, columns=[]).where("reason = 'exact_duplicate'").select(F.col("doc_id").alias("id"), F.lit(0).alias("priority"), F.lit("exact").alias("reason"))
    other = table(spark, at, "labels").where("toxic = 1").select(F.col("doc_id").alias("id"), F.lit(1).alias("priority"), F.lit("labelled").alias("reason"))
    return D.first_reason(exact.unionByName(other)).withColumnRenamed("id", "doc_id")


@query("incremental_dedup_stream", f"WITH h AS (SELECT sha256({SQL_DEDUP(sql_clean("coalesce(text, '')"))}) AS hash FROM documents) SELECT DISTINCT hash FROM h")
def incremental_dedup_stream(spark, at):
    from quern.plans.base import scratch
    from quern.streaming import incremental

    docs = table(spark, at, "documents")
    folder = scratch(spark, "stream")
    docs.select("doc_id", "text", "source").write.partitionBy("source").parquet(f"{folder}/in")
    schema = "doc_id bigint, text string, source string"
    found = incremental.new_documents(incremental.arriving(spark, f"{folder}/in", schema, files_each=1000)).select("doc_id", "hash")
    incremental.run_to_end(found, f"{folder}/state", f"{folder}/out")
    return spark.read.schema("doc_id bigint, hash string").parquet(f"{folder}/out").select("hash")


@query("stream_window_counts", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_window_counts(spark, at):
    return table(spark, at, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
