"""Roll-ups of evaluation results, logs and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def perplexity(ce: Column) -> Column:
    return F.when(ce < 50, F.exp(ce)).otherwise(float("inf"))


def weighted_loss(rows: DataFrame, by: str, loss: str, tokens: str) -> DataFrame:
    """Mean loss by tokens, and its perplexity, per group and, as the group ALL, over all."""
    rolled = rows.rollup(by).agg(F.sum(loss).alias("l"), F.sum(tokens).cast("bigint").alias("n_tokens"), F.grouping(by).alias("g"))
    ce = F.col("l") / F.greatest(F.lit(1), F.col("n_tokens"))
    return rolled.select(F.when(F.col("g") == 1, "ALL").otherwise(F.col(by).cast("string")).alias("group"), "n_tokens", F.round(ce, 6).alias("mean_ce"), F.round(perplexity(ce), 6).alias("ppl"))


def exact_match(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    same = F.when(a == b, 1).otherwise(0)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum(same).cast("bigint").alias("matches"), F.round(F.sum(same) / F.greatest(F.lit(1), F.count(F.lit(1))), 6).alias("rate"))


def counters(docs: DataFrame, by: str, reason: str) -> DataFrame:
    """Seen, written and rejected per group and, as TOTAL, over all."""
    return docs.rollup(by).agg(F.count(F.lit(1)).alias("seen"), F.count_if(F.col(reason).isNull()).alias("written"), F.count(reason).alias("rejected"), F.grouping(by).alias("g")).select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col(by)).alias(by), "seen", "written", "rejected")


def summary(rows: DataFrame, value: str, digits: int = 6) -> DataFrame:
    """Rows, total, least, most and mean of a column."""
    return rows.agg(F.count(value).alias("n"), F.sum(value).alias("total"), F.min(value).alias("least"), F.max(value).alias("most"), F.round(F.avg(value), digits).alias("mean"))


def reason_counts(docs: DataFrame, by: str, reason: str) -> DataFrame:
    """(by, name, n): rejected_REASON for each reason of a group and, as TOTAL, of all."""
    rolled = docs.where(F.col(reason).isNotNull()).groupBy(by, reason).agg(F.count(F.lit(1)).alias("n"))
    every = rolled.unionByName(rolled.groupBy(reason).agg(F.sum("n").alias("n")).withColumn(by, F.lit("TOTAL")))
    return every.select(by, F.concat(F.lit("rejected_"), F.col(reason)).alias("name"), F.col("n").cast("bigint").alias("n"))


def flag_counts(docs: DataFrame, by: str, flag: str, name: str) -> DataFrame:
    """(by, name, n): the rows of each group, and of all, that have the flag."""
    rolled = docs.where(F.col(flag)).groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    every = rolled.unionByName(rolled.agg(F.sum("n").alias("n")).where("n is not null").withColumn(by, F.lit("TOTAL")))
    return every.select(by, F.lit(name).alias("name"), F.col("n").cast("bigint").alias("n"))


def advanced(log: DataFrame, by: str, order: str, total: str, interval: float) -> DataFrame:
    """Rows at which the running total passes another multiple of the interval; of rows that share a place in the order, which have one total, any of them.  Nulls come last."""
    bucket = F.floor(F.col(total) / interval)
    before = F.lag(bucket, 1, 0).over(Window.partitionBy(by).orderBy(F.asc_nulls_last(order)))
    return log.withColumn("bucket", bucket.cast("bigint")).withColumn("__b", before).where("bucket > __b").drop("__b")


def learning_rate(tokens: Column, kind: str, peak: float, total: int, warmup: int, decay: float = 0.2, least: float = 0.0) -> Column:
    """Learning rate as a function of tokens: `cosine`, or `wsd` (warm-up, stable, linear decay over the last share)."""
    up = peak * tokens / warmup
    if kind == "cosine":
        x = F.least(F.lit(1.0), (tokens - warmup) / (total - warmup))
        then = least + 0.5 * (peak - least) * (1 + F.cos(F.lit(3.141592653589793) * x))
    else:
        start = total * (1 - decay)
        then = F.when(tokens < start, peak).otherwise(least + (peak - least) * F.greatest(F.lit(0.0), (total - tokens) / (total - start)))
    return F.when(tokens < warmup, up).otherwise(then)
