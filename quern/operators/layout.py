"""How work and files are dealt out: slots by hash or band, budgets, balanced chunks, names and numbers of shards, what is left to do."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: what a band's number counts for in the slot of its values.
BAND_STEP = 1_000_003


def band_slot(band: Column, value: Column, slots: int) -> Column:
    """The slot of a band's value; equal values of different bands go apart."""
    return F.pmod(value + band.cast("bigint") * BAND_STEP, F.lit(slots))


def hex_slot(value: Column, slots: int) -> Column:
    """The first eight digits of a hexadecimal value modulo slots; of its sha1 where they aren't all digits."""
    head = F.substring(value, 1, 8)
    digits = F.when(head.rlike("^[0-9a-fA-F]+$"), head).otherwise(F.substring(F.sha1(value), 1, 8))
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(slots))


def split_budget(budgets: DataFrame, budget: str, workers: int) -> DataFrame:
    """budgets with a row for each worker: its share, the remainder going to the first ones."""
    each = budgets.withColumn("worker", F.explode(F.sequence(F.lit(0), F.lit(workers - 1))))
    b = F.col(budget)
    return each.withColumn("share", F.floor(b / workers).cast("bigint") + F.when(F.col("worker") < b % workers, 1).otherwise(0))


def balanced_chunks(files: list[tuple[str, int]], chunks: int) -> list[list[str]]:
    """Files (name, size) in at most `chunks` lists of about equal size: the largest first, each to the list that holds least.

    A list of files is the driver's own business, and as long as a listing is; rows
    are balanced by Spark.
    """
    held = [(0, i) for i in range(max(1, min(chunks, len(files))))]
    out: list[list[str]] = [[] for _ in held]
    for name, size in sorted(files, key=lambda f: (-f[1], f[0])):
        total, i = heapq.heappop(held)
        out[i].append(name)
        heapq.heappush(held, (total + size, i))
    return [names for names in out if names]


def shard_name(prefix: str, source: Column, number: Column, suffix: str) -> Column:
    """PREFIX_SOURCE_000000.SUFFIX"""
    return F.concat(F.lit(f"{prefix}_"), source, F.lit("_"), F.lpad(number.cast("string"), 6, "0"), F.lit(f".{suffix}"))


def shard_source(name: Column, prefix: str) -> Column:
    """The source in a shard's name; empty where it has another prefix."""
    return F.regexp_extract(name, rf"^\Q{prefix}\E_(.*)_[^_]*?(?:\.[^.]*)?$", 1)


def next_numbers(names: DataFrame, name: str, prefix: str) -> DataFrame:
    """(source, next): the number of each source's next shard, one more than the largest in the names."""
    n = F.regexp_extract(F.col(name), r"_(\d+)(?:\.[^.]*)?$", 1)
    own = names.select(shard_source(F.col(name), prefix).alias("source"), F.when(n != "", n.cast("bigint")).alias("n")).where("source <> '' and n is not null")
    return own.groupBy("source").agg((F.max("n") + 1).alias("next"))


def selected(manifest: DataFrame, sources: list[str] | None = None, domains: list[str] | None = None, limit: int | None = None, order: str = "uri") -> DataFrame:
    """The shards of these sources and domains (none named: all), the first `limit` of them; an error if there are none."""
    out = manifest
    for name, values in (("source", sources), ("domain", domains)):
        if values:
            out = out.where(F.col(name).isin(values))
    if limit is not None:
        out = out.orderBy(order).limit(limit)
    if out.isEmpty():
        raise ValueError("no shard is of these sources and domains")
    return out


def pending(files: DataFrame, log: DataFrame, key: str = "path", unchanged: tuple[str, ...] = ("size_bytes", "mtime_ns")) -> DataFrame:
    """files but those whose last row in the log has the same size and time; the log's `n` numbers its rows."""
    last = log.groupBy(F.col(key).alias("__key")).agg(F.max_by(F.struct(*unchanged), "n").alias("__last"))
    same = F.col(key) == F.col("__key")
    for c in unchanged:
        same = same & (files[c] == F.col(f"__last.{c}"))
    return files.join(last, same, "left_anti")


def with_weights(manifest: DataFrame, weights: dict[str, float], by: str = "source") -> DataFrame:
    """manifest with each source's weight; sources of weight 0 go, and an error if that leaves none."""
    out = manifest.withColumn("weight", F.coalesce(*(F.when(F.col(by) == k, F.lit(float(w))) for k, w in weights.items()), F.lit(0.0))).where("weight > 0")
    if out.isEmpty():
        raise ValueError("every source has weight 0")
    return out


def left_over(weights: DataFrame, exhausted: DataFrame, by: str = "source") -> DataFrame:
    """(by, weight, probability) once the exhausted sources are out: those left share what they had."""
    rest = weights.join(exhausted.select(by).distinct(), by, "left_anti")
    return rest.withColumn("probability", F.col("weight") / F.sum("weight").over(Window.partitionBy()))
