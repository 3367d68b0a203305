"""Records of a manifest's shards in order, shard by shard, with a place that can be saved and resumed."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession

from quern.functions import hashing as H
from quern.operators import manifest as N
from quern.sources import readers, sinks


class IncompatibleState(ValueError):
    """A saved place belongs to another manifest, rank, worker or filter."""


class ShardReader:
    """The records of this rank's and worker's shards, one shard at a time.

    Spark reads and orders each shard; the driver holds the records of one
    partition and, with `prefetch`, asks for the next meanwhile.  The state names
    the shard and how many of its records were taken, so that a resumed reader
    gives each record once.
    """

    def __init__(self, spark: SparkSession, manifest: DataFrame, *, world: int = 1, rank: int = 0, workers: int = 1, worker: int = 0, seed: int | None = None, source: str | None = None, domain: str | None = None, exclude: DataFrame | None = None, prefetch: bool = True):
        self.spark, self.prefetch = spark, prefetch
        self.fixed = {"manifest_hash": sinks.manifest_digest(manifest), "world_size": world, "rank": rank, "num_workers": workers, "worker_id": worker, "source_filter": source, "domain_filter": domain}
        own = manifest
        for name, value in (("source", source), ("domain", domain)):
            own = own.where(own[name] == value) if value is not None else own
        own = N.without(own, exclude) if exclude is not None else own
        own = N.with_slots(own, world, workers).where(f"rank = {rank} and worker = {worker}")
        # a manifest is a row a file; these are one worker's
        self.shards = own.orderBy(H.shuffled(seed, own["uri"]) if seed is not None else own["uri"]).select("id", "uri", "record_start", "record_end").collect()
        self.at, self.taken = 0, 0

    def __iter__(self) -> Iterator[Row]:
        while self.at < len(self.shards):
            s = self.shards[self.at]
            rest = readers.shard_records(self.spark, s.uri, (s.record_start or 0) + self.taken, s.record_end).drop("line")
            for row in rest.toLocalIterator(prefetchPartitions=self.prefetch):
                self.taken += 1
                yield row
            self.at, self.taken = self.at + 1, 0

    def state(self) -> dict[str, Any]:
        return self.fixed | {"current_shard_id": self.shards[self.at].id if self.at < len(self.shards) else "", "shard_index": self.at, "consumed_records": self.taken}

    def load(self, state: dict[str, Any]) -> None:
        """Goes on from a saved place; an error if it isn't this reader's."""
        for key, value in self.fixed.items():
            if state.get(key) != value:
                raise IncompatibleState(f"{key} mismatch: expected {value}, got {state.get(key)}")
        at, name = int(state["shard_index"]), state.get("current_shard_id")
        if name and (at >= len(self.shards) or self.shards[at].id != name):
            raise IncompatibleState(f"current_shard_id mismatch: got {name}")
        self.at, self.taken = at, int(state["consumed_records"])
