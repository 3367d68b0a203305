"""Algebra over manifests: one row for each shard of a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import hashing as H
from quern.functions import text as T


def inspect(records: DataFrame, uri: str, text: str = "text") -> DataFrame:
    """A row for each uri: records, bytes and estimated tokens; sha256 is that of the uri where there is no file."""
    t = F.coalesce(F.col(text), F.lit(""))
    return records.groupBy(F.col(uri).alias("uri")).agg(F.count(F.lit(1)).alias("num_records"), F.sum(F.octet_length(t)).cast("bigint").alias("bytes"), F.sum(T.token_estimate(t)).cast("bigint").alias("estimated_tokens")).withColumn("sha256", F.sha2("uri", 256))


def totals(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.count(F.lit(1)).alias("num_shards"), *(F.sum(a).cast("bigint").alias(b) for a, b in (("bytes", "total_bytes"), ("num_records", "total_records"), ("estimated_tokens", "total_estimated_tokens"))))


def shares(manifest: DataFrame, by: str) -> DataFrame:
    """Shards, tokens and share per group, and a TOTAL row."""
    rolled = manifest.rollup(by).agg(F.count(F.lit(1)).alias("shards"), F.sum("estimated_tokens").cast("bigint").alias("tokens"), F.grouping(by).alias("g"))
    total = manifest.agg(F.sum("estimated_tokens").alias("all_tokens"))
    return rolled.join(F.broadcast(total)).select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col(by)).alias(by), "shards", "tokens", F.round(100.0 * F.col("tokens") / F.col("all_tokens"), 6).alias("share"))


def with_slots(manifest: DataFrame, world: int, workers: int) -> DataFrame:
    """manifest with the slot (rank and worker) that reads each shard, by its sha256."""
    n = world * workers
    slot = H.slot(F.col("sha256"), n)
    return manifest.withColumn("slot", slot).withColumn("rank", F.floor(F.col("slot") / workers).cast("bigint")).withColumn("worker", F.col("slot") % workers)


def validation_split(manifest: DataFrame, target: int, world: int = 2, workers: int = 3, seed: int = 42, by: str = "domain", ratio: float = 0.4) -> DataFrame:
    """manifest with take: of each group's chosen shard (the last, in seeded order, of its first slot) the first records held out; null elsewhere."""
    slots = with_slots(manifest, world, workers).withColumn("key", H.shuffled(seed, F.col("uri")))
    w = Window.partitionBy(by).orderBy(F.col("slot"), F.col("key").desc())
    average = F.col("bytes") * ratio / F.greatest(F.lit(1), F.col("num_records"))
    k = F.greatest(F.lit(1), F.least(F.col("num_records"), F.ceil(target / F.greatest(F.lit(1.0), average))))
    return slots.withColumn("take", F.when(F.row_number().over(w) == 1, k.cast("bigint"))).drop("key")


def held_out(split: DataFrame) -> DataFrame:
    return split.where("take is not null").withColumn("record_start", F.lit(0).cast("bigint")).withColumn("record_end", F.col("take"))


def remainder(split: DataFrame) -> DataFrame:
    """What is left for training; a shard that was taken whole goes."""
    return split.where("take is null or take < num_records").withColumn("record_start", F.coalesce("take", F.lit(0)).cast("bigint")).withColumn("record_end", F.lit(None).cast("bigint"))


def effective_records() -> Column:
    return F.coalesce("record_end", "num_records") - F.coalesce("record_start", F.lit(0))


def prune(manifest: DataFrame, targets: DataFrame, forced: DataFrame, by: str = "domain", world: int = 2, workers: int = 3, seed: int = 42) -> DataFrame:
    """manifest with kept: forced uris stay; of the others, in each slot's seeded order, those before which less than the slot's share of the group's target is kept.

    targets(by, target): a group without a target, or with a null one, keeps all.
    The last kept shard may overshoot, as its own tokens aren't counted before it.
    """
    slots = with_slots(manifest, world, workers).withColumn("key", H.shuffled(seed, F.col("uri")))
    slots = slots.join(F.broadcast(targets), by, "left").join(F.broadcast(forced.select("uri", F.lit(True).alias("forced"))), "uri", "left").withColumn("forced", F.coalesce("forced", F.lit(False)))
    n = slots.groupBy(by).agg(F.count_distinct("slot").alias("n_slots"))
    own = Window.partitionBy(by, "slot")
    before = F.coalesce(F.sum(F.when(~F.col("forced"), F.col("estimated_tokens"))).over(own.orderBy("key", "uri").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = F.coalesce(F.sum(F.when(F.col("forced"), F.col("estimated_tokens"))).over(own), F.lit(0))
    out = slots.join(F.broadcast(n), by).withColumn("before", before + base)
    return out.withColumn("kept", F.col("forced") | F.col("target").isNull() | (F.col("before") < F.col("target") / F.col("n_slots"))).drop("key", "n_slots")


def duplicates(*manifests: DataFrame) -> DataFrame:
    """Shard slices that several of the manifests hold, for which a merge fails."""
    every = manifests[0].select("uri", "record_start", "record_end")
    for m in manifests[1:]:
        every = every.unionAll(m.select("uri", "record_start", "record_end"))
    return every.groupBy("uri", "record_start", "record_end").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def merge(*manifests: DataFrame) -> DataFrame:
    """All rows of the manifests; an error if two hold the same slice."""
    if found := duplicates(*manifests).limit(5).collect():  # a few, for the message
        raise ValueError(f"slices in several manifests: {[r.uri for r in found]}")
    out = manifests[0]
    for m in manifests[1:]:
        out = out.unionByName(m)
    return out


def append_run(base: DataFrame, run: DataFrame, old: str, new: str) -> DataFrame:
    """base and the shards of another run, whose files went from the folder old to new; an error for one outside of old, or an id or uri that base has."""
    inside = F.col("uri").startswith(old.rstrip("/") + "/")
    if (stray := run.where(~inside).select("uri").first()) is not None:
        raise ValueError(f"a shard outside of the run: {stray.uri}")
    moved = run.withColumn("uri", F.concat(F.lit(new.rstrip("/")), F.substring("uri", len(old.rstrip("/")) + 1, 1 << 20)))
    for name in ("id", "uri"):
        if (twice := moved.select(name).join(base.select(name), name, "left_semi").first()) is not None:
            raise ValueError(f"duplicate shard {name} after merge: {twice[0]}")
    return base.unionByName(moved)


def reshard(manifest: DataFrame, old: tuple[int, int], new: tuple[int, int], reset_positions: bool = False, seed: int = 42) -> DataFrame:
    """cursors() for another (world, workers); places of the old one don't carry over, so `reset_positions` must say that they may go."""
    if old != new and not reset_positions:
        raise ValueError(f"positions of {old} ranks and workers mean nothing for {new}: reset_positions is needed")
    return cursors(manifest, *new, seed=seed)


def without(manifest: DataFrame, uris: DataFrame) -> DataFrame:
    return manifest.join(uris.select("uri"), "uri", "left_anti")


def only(manifest: DataFrame, uris: DataFrame) -> DataFrame:
    return manifest.join(uris.select("uri"), "uri", "left_semi")


def mixture(manifest: DataFrame, by: str, weight: str = "weight", temperature: float = 1.0) -> DataFrame:
    """(by, weight, probability): tokens times weight, and its share after the temperature; the least weight is 1e-12."""
    w = manifest.groupBy(by).agg(F.sum(F.col("estimated_tokens") * F.col(weight)).alias("weight"))
    p = F.pow(F.greatest(F.col("weight"), F.lit(1e-12)), F.lit(1.0 / temperature) if temperature != 1.0 else F.lit(1.0))
    return w.withColumn("p", p).withColumn("probability", F.col("p") / F.sum("p").over(Window.partitionBy())).drop("p")


def cursors(manifest: DataFrame, world: int, workers: int, seed: int = 42) -> DataFrame:
    """(slot, uri): each slot's first shard in seeded order, where reading starts anew for another world size; null for a slot without one."""
    every = manifest.sparkSession.range(world * workers).select(F.col("id").alias("slot"))
    first = with_slots(manifest, world, workers).groupBy("slot").agg(F.min_by("uri", H.shuffled(seed, F.col("uri"))).alias("uri"))
    return every.join(first, "slot", "left")


def consumed(runs: DataFrame, chain: DataFrame, run: str) -> DataFrame:
    """uris of runs(run, uri) over the chain(run, parent) of warm starts that ends in `run`; a cycle ends the walk."""
    seen, now = set(), run
    parents = {r.run: r.parent for r in chain.collect()}  # one row a run
    while now is not None and now not in seen:
        seen.add(now)
        now = parents.get(now)
    return runs.where(F.col("run").isin(sorted(seen))).select("uri").distinct()
