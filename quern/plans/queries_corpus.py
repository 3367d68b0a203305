"""Runs of turns, evaluation results and logs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.functions.prefix import bucket, cuts, running_total
from quern.operators import dedup as D
from quern.operators import metrics as M
from quern.plans.base import keep, query, sql_strip, table
from quern.sources import sinks

_TURNS = f"""x AS (SELECT conv_id, turn, role, {sql_strip("coalesce(text, '')")} AS t, row_number() OVER (ORDER BY conv_id, turn) AS n FROM conversations),
y AS (SELECT * FROM x WHERE t <> '')"""


def _chapters(spark, at):
    c = table(spark, at, "conversations").select("conv_id", "turn", "role", T.strip(F.coalesce("text", F.lit(""))).alias("t"))
    return c.where("t <> ''")


@query("concat_turns", f"WITH {_TURNS} SELECT conv_id, count(*) AS chapters, sha256(string_agg(t, chr(10) || chr(10) ORDER BY turn)) AS text FROM y GROUP BY conv_id HAVING sum(length(t) + 2) >= 500")
def concat_turns(spark, at):
    g = _chapters(spark, at).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "t"))).alias("c"), F.sum(F.length("t") + 2).alias("n")).where("n >= 500")
    return g.select("conv_id", F.size("c").cast("bigint").alias("chapters"), F.sha2(F.array_join(F.col("c.t"), "\n\n"), 256).alias("text"))


@query("role_islands", f"WITH {_TURNS}, z AS (SELECT *, CASE WHEN role IS DISTINCT FROM lag(role) OVER w THEN 1 ELSE 0 END AS chg FROM y WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), g AS (SELECT *, sum(chg) OVER (PARTITION BY conv_id ORDER BY turn) AS grp FROM z) SELECT conv_id, CAST(grp AS BIGINT) AS island, role, count(*) AS n, sha256(string_agg(t, chr(10) ORDER BY turn)) AS text FROM g GROUP BY ALL")
def role_islands(spark, at):
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = _chapters(spark, at).withColumn("chg", F.when(F.col("role").eqNullSafe(F.lag("role").over(w)), 0).otherwise(1)).withColumn("island", F.sum("chg").over(w))
    g = c.groupBy("conv_id", "island", "role").agg(F.array_sort(F.collect_list(F.struct("turn", "t"))).alias("c"))
    return g.select("conv_id", "island", "role", F.size("c").cast("bigint").alias("n"), F.sha2(F.array_join(F.col("c.t"), "\n"), 256).alias("text"))


def split_runs(chapters, title: str, order: str, text: str, max_chars: int, min_chars: int):
    """(first, title, part, n, text): chapters in order, a run of one title each, joined by an empty line.

    A run ends where the title changes, so two runs of one title are two.  A new
    part begins once one holds max_chars; a run's last part goes if it has less
    than both max_chars and min_chars.  A null or empty title is `untitled`; empty
    chapters are passed over.  `order` holds whole numbers, each once.
    """
    name = T.strip(F.coalesce(F.col(title).cast("string"), F.lit("")))
    own = chapters.select(F.col(order).alias("k"), F.when(name == "", "untitled").otherwise(name).alias("title"), T.strip(F.coalesce(F.col(text), F.lit(""))).alias("t")).where("t <> ''")
    own = keep(own.withColumn("size", (F.length("t") + 2).cast("bigint")))
    run = islands(own.select("k", "title"), "k", "title").select(F.col("k").alias("k2"), "run")
    cut = sinks.rolled(own.join(run, F.col("k") == F.col("k2")).drop("k2"), "run", ["k"], F.col("size"), max_chars, before=False)
    parts = cut.groupBy("run", "title", F.col("shard").alias("part")).agg(F.array_sort(F.collect_list(F.struct("k", "t"))).alias("c"), F.sum("size").alias("size"))
    parts = parts.where(F.col("size") >= min(max_chars, min_chars))
    return parts.select(F.col("c")[0]["k"].alias("first"), "title", "part", F.size("c").cast("bigint").alias("n"), F.array_join(F.col("c.t"), "\n\n").alias("text"))


def islands(rows, key: str, value: str, rows_each: int = 20_000):
    """rows with run, a number for each stretch of equal values in the order of key; nulls are equal.

    Stretches are told within buckets of neighbouring keys, and each bucket's first
    row from the last one of the bucket before.
    """
    cut = rows.withColumn("__b", bucket(F.col(key), cuts(rows, key, rows_each)))
    w = Window.partitionBy("__b").orderBy(key)
    last = cut.groupBy("__b").agg(F.max_by(F.struct(F.col(value).alias("v")), key).alias("last"))  # a row a bucket
    before = last.select("__b", F.lag("last").over(Window.orderBy("__b")).alias("__prior"))
    cut = cut.withColumn("__prev", F.lag(F.struct(F.col(value).alias("v"))).over(w)).join(F.broadcast(before), "__b")
    cut = cut.withColumn("__new", F.when(F.coalesce("__prev", "__prior").eqNullSafe(F.struct(F.col(value).alias("v"))), 0).otherwise(1)).drop("__b", "__prev", "__prior")
    return running_total(cut, key, "__new", "__run", rows_each).withColumn("run", F.col("__run") + F.col("__new")).drop("__new", "__run")


@query("concat_split", f"""WITH RECURSIVE {_TURNS}, z AS (SELECT n AS k, CAST(conv_id // 2 % 2 AS VARCHAR) AS title, t, length(t) + 2 AS size FROM y),
f AS (SELECT *, CASE WHEN title IS DISTINCT FROM lag(title) OVER (ORDER BY k) THEN 1 ELSE 0 END AS new FROM z),
g AS (SELECT *, sum(new) OVER (ORDER BY k) AS run FROM f), i AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY k) AS i FROM g),
p AS (SELECT run, i, size AS held, 0::BIGINT AS part FROM i WHERE i = 1
  UNION ALL SELECT i.run, i.i, CASE WHEN p.held >= 2000 THEN i.size ELSE p.held + i.size END, CASE WHEN p.held >= 2000 THEN p.part + 1 ELSE p.part END FROM p JOIN i ON i.run = p.run AND i.i = p.i + 1)
SELECT min(k) AS first, title, part, count(*) AS n, sha256(string_agg(t, chr(10) || chr(10) ORDER BY k)) AS text FROM p JOIN i USING (run, i) GROUP BY run, title, part HAVING sum(size) >= 500""")
def concat_split(spark, at):
    c = table(spark, at, "conversations")
    numbered = running_total(c.withColumn("k", F.col("conv_id") * 100_000 + F.col("turn")).withColumn("one", F.lit(1).cast("bigint")), "k", "one", "n").withColumn("n", F.col("n") + 1)
    return split_runs(numbered.withColumn("title", F.floor(F.col("conv_id") / 2) % 2), "title", "n", "text", 2000, 500).withColumn("text", F.sha2("text", 256))


_LOSS = "e AS (SELECT doc_id, toxic, quality, lang, (length(text) % 97) / 10.0 AS loss, greatest(1, strlen(text) // 4) AS n FROM documents JOIN labels USING (doc_id))"


@query("weighted_eval_by_label", f"WITH {_LOSS}, r AS (SELECT coalesce(toxic::VARCHAR, 'ALL') AS g, sum(loss * n)::DOUBLE AS l, sum(n) AS n FROM e GROUP BY ROLLUP (toxic)) SELECT g AS \"group\", CAST(n AS BIGINT) AS n_tokens, round(l / greatest(1, n), 6) AS mean_ce, round(CASE WHEN l / greatest(1, n) < 50 THEN exp(l / greatest(1, n)) ELSE 'inf'::DOUBLE END, 6) AS ppl FROM r")
def weighted_eval_by_label(spark, at):
    d = table(spark, at, "documents").join(table(spark, at, "labels"), "doc_id").withColumn("n", T.token_estimate(F.col("text")))
    d = d.withColumn("loss", (F.length("text") % 97) / 10.0 * F.col("n"))
    return M.weighted_loss(d, "toxic", "loss", "n")


@query("exact_match_rate", f"WITH x AS (SELECT coalesce(text, '') AS a, lag(text) OVER (PARTITION BY source ORDER BY doc_id) AS b FROM documents) SELECT count(*) AS n, count(*) FILTER ({sql_strip(f'''regexp_replace(a, '{T.WS}+', ' ', 'g')''')} = {sql_strip(f'''regexp_replace(b, '{T.WS}+', ' ', 'g')''')}) AS matches, round(count(*) FILTER ({sql_strip(f'''regexp_replace(a, '{T.WS}+', ' ', 'g')''')} = {sql_strip(f'''regexp_replace(b, '{T.WS}+', ' ', 'g')''')}) / count(*), 6) AS rate FROM x")
def exact_match_rate(spark, at):
    d = table(spark, at, "documents").select(F.coalesce("text", F.lit("")).alias("a"), F.lag("text").over(Window.partitionBy("source").orderBy("doc_id")).alias("b"))
    return M.exact_match(d, T.training_text(F.col("a")), T.training_text(F.col("b")))


@query("latest_status_summary", "WITH l AS (SELECT user_id, max_by(event_type, event_id) AS status, max_by(value, event_id) AS value FROM events GROUP BY user_id) SELECT status, count(*) AS n, round(sum(value), 4) AS total FROM l GROUP BY ALL")
def latest_status_summary(spark, at):
    last = D.latest(table(spark, at, "events").select("user_id", "event_id", F.col("event_type").alias("status"), "value"), ["user_id"], "event_id")
    return last.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("stage_pivot", "SELECT conv_id, coalesce(max(text) FILTER (role = 'user'), '-') AS user_text, coalesce(max(text) FILTER (role = 'assistant'), '-') AS assistant_text, coalesce(max(text) FILTER (role = 'system'), '-') AS system_text FROM conversations GROUP BY conv_id")
def stage_pivot(spark, at):
    p = table(spark, at, "conversations").groupBy("conv_id").pivot("role", ["user", "assistant", "system"]).agg(F.max("text"))
    return p.select("conv_id", *(F.coalesce(r, F.lit("-")).alias(f"{r}_text") for r in ("user", "assistant", "system")))


@query("positional_zip", "WITH a AS (SELECT row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, conv_id, turn FROM conversations WHERE role = 'user'), b AS (SELECT row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, conv_id, turn FROM conversations WHERE role = 'assistant') SELECT conv_id, n, coalesce(a.turn, -1) AS left_turn, coalesce(b.turn, -1) AS right_turn FROM a FULL JOIN b USING (conv_id, n)")
def positional_zip(spark, at):
    def numbered(role, name):
        c = table(spark, at, "conversations").where(F.col("role") == role)
        return c.select("conv_id", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).cast("bigint").alias("n"), F.col("turn").alias(name))

    both = numbered("user", "a").join(numbered("assistant", "b"), ["conv_id", "n"], "full")
    return both.select("conv_id", "n", F.coalesce("a", F.lit(-1)).alias("left_turn"), F.coalesce("b", F.lit(-1)).alias("right_turn"))


@query("step_deltas", "SELECT event_id, round(value - coalesce(lag(value) OVER w, 0), 6) AS delta, date_diff('second', lag(ts) OVER w, ts) AS seconds FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def step_deltas(spark, at):
    w = Window.partitionBy("user_id").orderBy("event_id")
    e = table(spark, at, "events")
    return e.select("event_id", F.round(F.col("value") - F.coalesce(F.lag("value").over(w), F.lit(0.0)), 6).alias("delta"), (F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(F.lag("ts").over(w).cast("timestamp"))).alias("seconds"))


@query("scheduled_buckets", "WITH r AS (SELECT event_id, user_id, sum(value) OVER (PARTITION BY user_id ORDER BY event_id) AS total FROM events), b AS (SELECT *, CAST(floor(total / 250) AS BIGINT) AS bucket, lag(CAST(floor(total / 250) AS BIGINT), 1, 0) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM r) SELECT event_id, bucket FROM b WHERE bucket > prev")
def scheduled_buckets(spark, at):
    # events that share an id count together, those without one come last, as in SQL
    w = Window.partitionBy("user_id").orderBy(F.asc_nulls_last("event_id")).rangeBetween(Window.unboundedPreceding, 0)
    log = table(spark, at, "events").withColumn("total", F.sum("value").over(w))
    return M.advanced(log, "user_id", "event_id", "total", 250).select("event_id", "bucket")


@query("rank_metrics", "SELECT user_id % 8 AS rank, event_type, count(*) AS n, round(sum(value), 4) AS total, round(max(value), 6) AS most FROM events GROUP BY ALL")
def rank_metrics(spark, at):
    return table(spark, at, "events").groupBy((F.col("user_id") % 8).alias("rank"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"), F.round(F.max("value"), 6).alias("most"))


@query("learning_curve", "SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, round(avg(value), 6) AS mean FROM events GROUP BY ALL")
def learning_curve(spark, at):
    return table(spark, at, "events").groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.round(F.avg("value"), 6).alias("mean"))


@query("learning_rates", """WITH t AS (SELECT o_orderkey, (o_orderkey % 1000) * 1000 AS k FROM orders)
SELECT o_orderkey, round(CASE WHEN k < 50000 THEN 0.001 * k / 50000 ELSE 0.5 * 0.001 * (1 + cos(3.141592653589793 * least(1.0, (k - 50000) / 900000::DOUBLE))) END, 9) AS cosine,
  round(CASE WHEN k < 50000 THEN 0.001 * k / 50000 WHEN k < 760000 THEN 0.001 ELSE 0.001 * greatest(0.0, (950000 - k) / 190000::DOUBLE) END, 9) AS wsd FROM t""")
def learning_rates(spark, at):
    k = (F.col("o_orderkey") % 1000) * 1000
    return table(spark, at, "orders").select("o_orderkey", F.round(M.learning_rate(k, "cosine", 0.001, 950_000, 50_000), 9).alias("cosine"), F.round(M.learning_rate(k, "wsd", 0.001, 950_000, 50_000), 9).alias("wsd"))


@query("distinct_urls", "SELECT url, min(page_id) AS first FROM pages WHERE url NOT LIKE '#%' GROUP BY url")
def distinct_urls(spark, at):
    return table(spark, at, "pages").where(~F.col("url").startswith("#")).groupBy("url").agg(F.min("page_id").alias("first"))


@query("label_join_check", "SELECT lang, count(*) AS n, count(quality) AS labelled, CAST(coalesce(sum(quality), 0) AS BIGINT) AS good FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL")
def label_join_check(spark, at):
    d = table(spark, at, "documents").select("doc_id", "lang").join(table(spark, at, "labels").select("doc_id", "quality"), "doc_id", "left")
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count("quality").alias("labelled"), F.coalesce(F.sum("quality"), F.lit(0)).cast("bigint").alias("good"))
