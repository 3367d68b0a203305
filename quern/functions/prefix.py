"""Buckets of neighbouring keys of about equal size, and running totals over a whole table, without one task that sees it all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of neighbouring keys, at most.
BUCKETS = 4096


def cuts(table: DataFrame, key: str, rows_each: int, most: int = BUCKETS) -> list[int]:
    """The least keys of all buckets but the first: quantiles, so one far-off key doesn't put all others into one bucket."""
    n = table.count()
    buckets = max(1, min(most, -(-n // rows_each)))
    if buckets == 1:
        return []
    found = table.agg(F.percentile_approx(key, [i / buckets for i in range(1, buckets)], 10 * buckets)).first()[0]
    return sorted(set(found or []))


def bucket(key: Column, at: list[int]) -> Column:
    """The number of the bucket that the key lies in, by a binary search among the cuts; -1 for null."""
    steps = [1 << i for i in reversed(range(len(at).bit_length()))]
    padded = [*at, *[None] * (sum(steps) - len(at))]
    low: Column = F.lit(0)
    if at:
        held = F.array(*(F.lit(x).cast("bigint") for x in padded))
        low = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda low, step: F.when(F.coalesce(F.element_at(held, low + step) <= key, F.lit(False)), low + step).otherwise(low))
    return F.when(key.isNull(), F.lit(-1)).otherwise(low)


def running_total(table: DataFrame, key: str, value: str, name: str, rows_each: int = 20_000) -> DataFrame:
    """table with the sum of value over all rows of lesser key, in the column name; rows with a null key come first.

    Keys are whole numbers; each bucket of neighbours is summed by itself, and the
    totals of at most BUCKETS buckets before it are added.  Rows that share a key
    follow each other in any order; a null value counts as 0.
    """
    cut = table.withColumn("__bucket", bucket(F.col(key), cuts(table, key, rows_each)))
    size = F.coalesce(F.col(value), F.lit(0))
    totals = cut.groupBy("__bucket").agg(F.sum(size).alias("__total"))
    before = totals.select("__bucket", (F.sum("__total").over(Window.orderBy("__bucket")) - F.col("__total")).alias("__before"))
    own = F.sum(size).over(Window.partitionBy("__bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)) - size
    return cut.withColumn("__own", own).join(F.broadcast(before), "__bucket").withColumn(name, F.col("__own") + F.col("__before")).drop("__bucket", "__own", "__before")
