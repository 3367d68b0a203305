"""Tokens, packs, budgets, samples and distributions over whole documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions import hashing as H
from quern.functions import text as T
from quern.operators import cleaning as C
from quern.operators import metrics as M
from quern.operators import tokens as K
from quern.plans.base import SQL_CLEANED, query, sql_covered, table
from quern.sources import sinks

SEQ, END, BATCH = 4096, 258, 8


def _tokens(spark, at):
    return table(spark, at, "documents").select("doc_id", "lang", H.byte_ids(F.col("text")).alias("ids"))


@query("byte_tokens", "WITH h AS (SELECT doc_id, strlen(text) AS n, hex(encode(text)) AS x FROM documents), t AS (SELECT doc_id, unnest(regexp_extract_all(x, '..')) AS b FROM h) SELECT doc_id, any_value(n) AS n_tokens, CAST(sum(1 + ('0x' || b)::BIGINT % 257) AS BIGINT) AS id_sum FROM t JOIN h USING (doc_id) GROUP BY doc_id")
def byte_tokens(spark, at):
    total = F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, b: a + b)
    return _tokens(spark, at).where(F.size("ids") > 0).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), total.alias("id_sum"))


@query("token_stats_by_lang", "SELECT lang, count(*) AS records, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(strlen(text)) AS BIGINT) AS tokens, round(sum(strlen(text))::DOUBLE / sum(length(text))::DOUBLE, 6) AS tokens_per_char, count(*) FILTER (strlen(text) > greatest(32, 4 * length(text)) OR strlen(text) = 0) AS abnormal FROM documents GROUP BY ALL")
def token_stats_by_lang(spark, at):
    t = table(spark, at, "documents").select("lang", F.length("text").alias("c"), F.size(H.byte_ids(F.col("text"))).alias("n"))
    return t.groupBy("lang").agg(F.count(F.lit(1)).alias("records"), F.sum("c").cast("bigint").alias("chars"), F.sum("n").cast("bigint").alias("tokens"), F.round(F.sum("n") / F.sum("c"), 6).alias("tokens_per_char"), F.count_if((F.col("n") > F.greatest(F.lit(32), 4 * F.col("c"))) | (F.col("n") == 0)).alias("abnormal"))


# a pack's ids are, but for ends, one more than the texts' bytes, so hexadecimal texts tell them
_STREAM = f"""h AS (SELECT doc_id, hex(encode(text)) AS x, strlen(text) + 1 AS n FROM documents),
o AS (SELECT *, CAST(sum(n) OVER (ORDER BY doc_id) - n AS BIGINT) AS pos FROM h),
pc AS (SELECT o.*, unnest(range(pos // {SEQ}, (pos + n - 1) // {SEQ} + 1)) AS pack_id FROM o),
pd AS (SELECT pack_id, doc_id, greatest(pos, pack_id * {SEQ}) AS b, least(pos + n, (pack_id + 1) * {SEQ}) AS e, pos, x || '--' AS x FROM pc),
pk AS (SELECT pack_id, string_agg(substr(x, 2 * (b - pos) + 1, 2 * (e - b)), '' ORDER BY b) AS content, count(*) AS docs, min(doc_id) AS first_doc, max(doc_id) AS last_doc FROM pd GROUP BY pack_id HAVING sum(e - b) = {SEQ})"""


def _digest(packs):
    shown = F.array_join(F.transform("input_ids", lambda i: F.when(i == END, "--").otherwise(F.lpad(F.hex(i.cast("bigint") - 1), 2, "0"))), "")
    return packs.select("pack_id", F.sha2(shown, 256).alias("ids"), F.size(F.array_distinct("document_ids")).cast("bigint").alias("docs"), F.array_min("document_ids").alias("first_doc"), F.array_max("document_ids").alias("last_doc"))


@query("pack_sequences", f"WITH {_STREAM} SELECT pack_id, sha256(content) AS ids, docs, first_doc, last_doc FROM pk")
def pack_sequences(spark, at):
    return _digest(K.packed(_tokens(spark, at), SEQ, END))


@query("eval_packs", f"WITH {_STREAM} SELECT pack_id, sha256(content) AS ids, docs, first_doc, last_doc FROM pk WHERE pack_id < ((SELECT count(*) FROM pk) // {BATCH}) * {BATCH}")
def eval_packs(spark, at):
    return _digest(K.eval_packs(K.packed(_tokens(spark, at), SEQ, END), BATCH))


@query("unpack_segments", f"""WITH {_STREAM}, sg AS (SELECT pack_id, doc_id, replace(substr(x, 2 * (b - pos) + 1, 2 * (e - b)), '--', '') AS s FROM pd WHERE pack_id IN (SELECT pack_id FROM pk))
SELECT pack_id, doc_id, CAST(length(s) // 2 AS BIGINT) AS n, sha256(s) AS ids FROM sg WHERE s <> ''""")
def unpack_segments(spark, at):
    u = K.unpacked(K.packed(_tokens(spark, at), SEQ, END), END)
    return u.select("pack_id", F.col("doc").alias("doc_id"), F.size("ids").cast("bigint").alias("n"), F.sha2(F.array_join(F.transform("ids", lambda i: F.lpad(F.hex(i.cast("bigint") - 1), 2, "0")), ""), 256).alias("ids"))


@query("block_mask_sizes", f"""WITH {_STREAM} SELECT pack_id, CAST(sum((e - b) * (e - b + 1) // 2) AS BIGINT) AS visible FROM pd WHERE pack_id IN (SELECT pack_id FROM pk) GROUP BY pack_id""")
def block_mask_sizes(spark, at):
    seen = K.packed(_tokens(spark, at), SEQ, END).select("pack_id", F.explode("document_ids").alias("doc")).groupBy("pack_id", "doc").agg(F.count(F.lit(1)).alias("n"))
    # a document's n places see n * (n + 1) / 2 pairs; block_mask() lists them for short packs
    return seen.groupBy("pack_id").agg(F.sum((F.col("n") * (F.col("n") + 1) / 2).cast("bigint")).alias("visible"))


@query("token_audit", "WITH s AS (SELECT source, strlen(text) AS real, greatest(1, strlen(text) // 4) AS est, length(text) AS c FROM documents) SELECT coalesce(source, 'TOTAL') AS source, CAST(sum(est) AS BIGINT) AS est, round(sum(real)::DOUBLE / sum(est)::DOUBLE, 6) AS ratio, round(sum(c)::DOUBLE / sum(real)::DOUBLE, 6) AS chars_per_token FROM s GROUP BY ROLLUP (source)")
def token_audit(spark, at):
    s = table(spark, at, "documents").select("source", F.size(H.byte_ids(F.col("text"))).alias("real"), T.token_estimate(F.col("text")).alias("est"), F.length("text").alias("c"))
    return s.rollup("source").agg(F.sum("est").cast("bigint").alias("est"), F.round(F.sum("real") / F.sum("est"), 6).alias("ratio"), F.round(F.sum("c") / F.sum("real"), 6).alias("chars_per_token"), F.grouping("source").alias("g")).select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("source")).alias("source"), "est", "ratio", "chars_per_token")


_Q = [0.1, 0.25, 0.5, 0.9, 0.99]
_QSQL = lambda v, part="": ", ".join(f"min({v}) FILTER (rn = least(n, CAST(floor({q} * n) AS BIGINT) + 1)) AS p{round(q * 100)}" for q in _Q)


@query("floor_quantiles", f"WITH x AS (SELECT lang, length(text) AS v, row_number() OVER (PARTITION BY lang ORDER BY length(text)) AS rn, count(*) OVER (PARTITION BY lang) AS n FROM documents) SELECT lang, {_QSQL('v')} FROM x GROUP BY lang")
def floor_quantiles(spark, at):
    return K.floor_quantile(table(spark, at, "documents").select("lang", F.length("text").cast("bigint").alias("v")), "v", _Q, ["lang"])


_CUTS = [0.85, 0.9, 0.95, 0.98]


@query("score_distribution", f"WITH {SQL_CLEANED}, s AS (SELECT round(score, 6) AS s, greatest(1, strlen(clean) // 4) AS k FROM m) SELECT t::DOUBLE AS threshold, count(*) FILTER (s >= t) AS docs, CAST(coalesce(sum(k) FILTER (s >= t), 0) AS BIGINT) AS tokens FROM s, unnest({_CUTS}) AS u(t) GROUP BY t")
def score_distribution(spark, at):
    d = C.scored(C.cleaned(table(spark, at, "documents"), C.Cleaning())).select(F.round("quality_score", 6).alias("s"), T.token_estimate(F.col("clean")).alias("k"))
    one = d.agg(*(x for i, t in enumerate(_CUTS) for x in (F.count_if(F.col("s") >= t).alias(f"d{i}"), F.coalesce(F.sum(F.when(F.col("s") >= t, F.col("k"))), F.lit(0)).alias(f"t{i}"))))
    return one.select(F.inline(F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"d{i}").alias("docs"), F.col(f"t{i}").cast("bigint").alias("tokens")) for i, t in enumerate(_CUTS)))))


@query("score_quantiles", f"WITH {SQL_CLEANED}, x AS (SELECT round(score, 6) AS v, row_number() OVER (ORDER BY round(score, 6)) AS rn, count(*) OVER () AS n FROM m) SELECT {_QSQL('v')} FROM x")
def score_quantiles(spark, at):
    return K.floor_quantile(C.scored(C.cleaned(table(spark, at, "documents"), C.Cleaning())).select(F.round("quality_score", 6).alias("v")), "v", _Q)


_LENGTHS = [512, 2048, 8192, 16384]


@query("length_histogram", f"WITH s AS (SELECT greatest(1, strlen(text) // 4) AS k FROM documents) SELECT t::BIGINT AS threshold, count(*) FILTER (k >= t) AS docs, CAST(coalesce(sum(k) FILTER (k >= t), 0) AS BIGINT) AS tokens, CAST(sum(greatest(0, k - t)) AS BIGINT) AS beyond FROM s, unnest({_LENGTHS}) AS u(t) GROUP BY t")
def length_histogram(spark, at):
    d = table(spark, at, "documents").select(T.token_estimate(F.col("text")).alias("k"))
    one = d.agg(*(x for i, t in enumerate(_LENGTHS) for x in (F.count_if(F.col("k") >= t).alias(f"d{i}"), F.coalesce(F.sum(F.when(F.col("k") >= t, F.col("k"))), F.lit(0)).alias(f"t{i}"), F.sum(F.greatest(F.lit(0), F.col("k") - t)).alias(f"b{i}"))))
    return one.select(F.inline(F.array(*(F.struct(F.lit(t).cast("bigint").alias("threshold"), F.col(f"d{i}").alias("docs"), F.col(f"t{i}").cast("bigint").alias("tokens"), F.col(f"b{i}").cast("bigint").alias("beyond")) for i, t in enumerate(_LENGTHS)))))


@query("raw_file_estimate", f"SELECT source, round(avg(length(text)), 6) AS mean, round(count(*) FILTER (length(text) >= 8192) / count(*), 6) AS share_8k, round(count(*) FILTER (length(text) >= 16384) / count(*), 6) AS share_16k, round(sum({sql_covered('text', T.CJK + '+')})::DOUBLE / sum(length(text))::DOUBLE, 6) AS cjk FROM documents GROUP BY ALL")
def raw_file_estimate(spark, at):
    n, share = F.length("text"), lambda k: F.round(F.count_if(F.length("text") >= k) / F.count(F.lit(1)), 6)
    return table(spark, at, "documents").groupBy("source").agg(F.round(F.avg(n), 6).alias("mean"), share(8192).alias("share_8k"), share(16384).alias("share_16k"), F.round(F.sum(T.matched(F.col("text"), f"{T.CJK}+")) / F.sum(n), 6).alias("cjk"))


_BUDGETS = {"en": 300_000, "fr": 100_000, "de": 50_000}


@query("corpus_budget_sample", f"WITH x AS (SELECT doc_id, lang, strlen(text) + 1 AS size, md5('42:' || doc_id) AS key FROM documents), y AS (SELECT *, sum(size) OVER (PARTITION BY lang ORDER BY key) AS s FROM x), z AS (SELECT * FROM y WHERE s <= CASE lang WHEN 'en' THEN 300000 WHEN 'fr' THEN 100000 WHEN 'de' THEN 50000 ELSE 0 END), a AS (SELECT *, sum(size) OVER (ORDER BY key) AS t FROM z) SELECT doc_id, size FROM a WHERE t <= 400000")
def corpus_budget_sample(spark, at):
    d = table(spark, at, "documents").select("doc_id", "lang", (F.octet_length("text") + 1).cast("bigint").alias("size"))
    return K.within_budget(d, H.shuffled(42, F.col("doc_id")), "size", _BUDGETS, 400_000, "lang").select("doc_id", "size")


@query("sampler_stats", "SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, count(*) AS records, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents GROUP BY GROUPING SETS ((lang), (source))")
def sampler_stats(spark, at):
    d = table(spark, at, "documents").select("lang", "source", F.octet_length("text").alias("b"))
    return d.groupingSets([[d.lang], [d.source]], d.lang, d.source).agg(F.count(F.lit(1)).alias("records"), F.sum("b").cast("bigint").alias("bytes")).select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "records", "bytes")


@query("first_n_per_domain", "SELECT lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 20")
def first_n_per_domain(spark, at):
    return K.first_of_each(table(spark, at, "documents").select("lang", "doc_id"), "lang", "doc_id", 20)


@query("abnormal_first_20", "SELECT doc_id FROM documents WHERE length(text) < 60 ORDER BY doc_id LIMIT 20")
def abnormal_first_20(spark, at):
    return table(spark, at, "documents").where(F.length("text") < 60).select("doc_id").orderBy("doc_id").limit(20)


@query("offset_limit", "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 50 OFFSET 100")
def offset_limit(spark, at):
    return table(spark, at, "documents").select("doc_id").orderBy("doc_id").offset(100).limit(50)


@query("stride_sample", "SELECT doc_id FROM documents QUALIFY (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) % 10 = 0")
def stride_sample(spark, at):
    n = F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1
    return table(spark, at, "documents").select("doc_id", n.alias("n")).where("n % 10 = 0").select("doc_id")


@query("hashed_sample", "SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id) LIMIT 100")
def hashed_sample(spark, at):
    return table(spark, at, "documents").select("doc_id").orderBy(H.shuffled(42, F.col("doc_id"))).limit(100)


@query("weighted_interleave", "WITH x AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) / CASE lang WHEN 'en' THEN 0.6::DOUBLE WHEN 'fr' THEN 0.3 WHEN 'de' THEN 0.1 END AS turn FROM documents WHERE lang IN ('en', 'fr', 'de')) SELECT doc_id, lang, round(turn, 6) AS turn FROM x")
def weighted_interleave(spark, at):
    d = K.interleaved(table(spark, at, "documents").select("doc_id", "lang"), "lang", "doc_id", {"en": 0.6, "fr": 0.3, "de": 0.1, "es": 0.0})
    return d.select("doc_id", "lang", F.round("turn", 6).alias("turn"))


@query("numbered_shards", "SELECT source, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 16 AS shard, doc_id FROM documents")
def numbered_shards(spark, at):
    return sinks.numbered_shards(table(spark, at, "documents").select("source", "doc_id"), ["doc_id"], 16).select("source", "shard", "doc_id")


def _rolled(passes: str) -> str:
    """Each record in turn, as a writer sees it: the size held by the open shard decides whether the next one opens another."""
    return f"""WITH RECURSIVE x AS (SELECT source, doc_id, strlen(text) + 1 AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
r AS (SELECT source, doc_id, i, size AS held, 0::BIGINT AS shard FROM x WHERE i = 1
  UNION ALL SELECT x.source, x.doc_id, x.i, CASE WHEN {passes} THEN x.size ELSE r.held + x.size END, CASE WHEN {passes} THEN r.shard + 1 ELSE r.shard END FROM r JOIN x ON x.source = r.source AND x.i = r.i + 1)
SELECT source, doc_id, shard FROM r"""


@query("sized_shards", _rolled("r.held + x.size > 65536"))
def sized_shards(spark, at):
    d = table(spark, at, "documents").select("source", "doc_id", F.octet_length("text").alias("bytes"))
    return sinks.rolled(d, "source", ["doc_id"], F.col("bytes") + 1, 65536).select("source", "doc_id", "shard")


@query("filled_shards", _rolled("r.held >= 65536"))
def filled_shards(spark, at):
    d = table(spark, at, "documents").select("source", "doc_id", F.octet_length("text").alias("bytes"))
    return sinks.rolled(d, "source", ["doc_id"], F.col("bytes") + 1, 65536, before=False).select("source", "doc_id", "shard")


@query("canonical_records", "SELECT CAST(doc_id AS VARCHAR) AS id, sha256(text) AS text, source, coalesce(nullif(lang, 'es'), 'unknown') AS domain, 'unknown' AS language, '{}' AS metadata FROM documents")
def canonical_records(spark, at):
    d = table(spark, at, "documents").select(F.col("doc_id").alias("id"), "text", "source", F.when(F.col("lang") == "es", "").otherwise(F.col("lang")).alias("domain"))
    return sinks.canonical(d).withColumn("text", F.sha2("text", 256))


@query("scored_subset", f"WITH {SQL_CLEANED} SELECT doc_id, round(score, 6) AS score FROM m WHERE round(score, 6) >= 0.97")
def scored_subset(spark, at):
    d = C.scored(C.cleaned(table(spark, at, "documents"), C.Cleaning())).select("doc_id", F.round("quality_score", 6).alias("score"))
    return d.where("score >= 0.97")


@query("score_summary", f"WITH {SQL_CLEANED} SELECT count(*) AS n, round(min(score), 6) AS least, round(max(score), 6) AS most, round(avg(round(score, 6)), 5) AS mean FROM m")
def score_summary(spark, at):
    d = C.scored(C.cleaned(table(spark, at, "documents"), C.Cleaning())).select(F.round("quality_score", 6).alias("s"))
    return M.summary(d, "s", 5).select("n", "least", "most", "mean")


@query("length_summary", f"WITH x AS (SELECT greatest(1, strlen(text) // 4)::BIGINT AS v FROM documents), y AS (SELECT v, row_number() OVER (ORDER BY v) AS rn, count(*) OVER () AS n FROM x) SELECT count(*) AS docs, CAST(sum(v) AS BIGINT) AS total, round(avg(v), 6) AS mean, {_QSQL('v')} FROM y")
def length_summary(spark, at):
    d = table(spark, at, "documents").select(T.token_estimate(F.col("text")).cast("bigint").alias("v"))
    whole = M.summary(d, "v").select(F.col("n").alias("docs"), F.col("total").cast("bigint").alias("total"), "mean")
    return whole.join(F.broadcast(K.floor_quantile(d, "v", _Q)))  # a row with a row


@query("raw_file_quantiles", "WITH x AS (SELECT source, strlen(text)::BIGINT AS v, row_number() OVER (PARTITION BY source ORDER BY strlen(text)) AS rn, count(*) OVER (PARTITION BY source) AS n FROM documents) SELECT source, CAST(sum(v) AS BIGINT) AS total, min(v) FILTER (rn = least(n, CAST(floor(0.5 * n) AS BIGINT) + 1)) AS p50, min(v) FILTER (rn = least(n, CAST(floor(0.9 * n) AS BIGINT) + 1)) AS p90 FROM x GROUP BY source")
def raw_file_quantiles(spark, at):
    d = table(spark, at, "documents").select("source", F.octet_length("text").cast("bigint").alias("v"))
    return K.floor_quantile(d, "v", [0.5, 0.9], ["source"]).join(d.groupBy("source").agg(F.sum("v").alias("total")), "source")
