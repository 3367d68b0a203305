"""Token ids in shards of raw payload, with keyed access by a minimal perfect hash.

A shard is a row of a Parquet table: the ids of its documents end to end, in
ascending document order, as little-endian integers, and an index.  The index maps
a document's key through a minimal perfect hash to a slot that holds the key's
fingerprint, the offset of its first id and its number of ids; a key that isn't
there is told by its fingerprint (but for one in 2^32).  A Parquet table can be
written to and read from any store that Spark knows, and a lost task's shards are
written anew.  A shard closes at SHARD_IDS ids, so a writer's memory is bounded by
that and the longest text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.perfect_hash import PerfectHash, fingerprints
from quern.llm.store import Store, prepare
from quern.llm.vectors import U, blocks
from quern.llm.word_bpe import word_encoder

SHARD_IDS, END = 1 << 20, 1
#: Up to so many keys are looked for one by one in the shards' ranges.
SINGLY = 64
SHARD = "part int, shard int, low bigint, high bigint, n_ids bigint, n_docs bigint, payload binary, docs binary, lengths binary, unkeyed int, sizes binary, bits binary, ranks binary, prints binary, starts binary, counts binary"


@dataclass
class Shard:
    """One shard as read back.  docs: the keys in order (the first `unkeyed` texts had none); lengths: the ids of each text."""

    payload: np.ndarray
    docs: np.ndarray
    lengths: np.ndarray
    unkeyed: int
    index: PerfectHash
    prints: np.ndarray
    starts: np.ndarray
    counts: np.ndarray

    @classmethod
    def read(cls, row: dict, kind: str = "<u2") -> Shard:
        get = lambda name, of: np.frombuffer(row[name], of)
        return cls(get("payload", kind), get("docs", "<i8"), get("lengths", "<u4").astype(np.int64), row["unkeyed"], PerfectHash(get("sizes", "<u4"), get("bits", np.uint8), get("ranks", "<u4")), get("prints", "<u4"), get("starts", "<u4"), get("counts", "<u4"))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First id and number of ids of each key; -1 and 0 where the shard hasn't the key."""
        keys = keys.astype(np.int64).view(U)
        if not len(self.prints):
            return np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        slot = self.index.find(keys)
        there = (slot >= 0) & (self.prints[slot] == fingerprints(keys))
        return np.where(there, self.starts[slot].astype(np.int64), -1), np.where(there, self.counts[slot].astype(np.int64), 0)


    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """First id and number of ids of each text: of a key of its own by the index; lengths tell those apart that share a key or have none."""
        at, count = self.find(self.docs)
        own = self.lengths[self.unkeyed :]
        first = np.flatnonzero(np.concatenate([[True], self.docs[1:] != self.docs[:-1]])[: len(self.docs)])
        texts = np.diff(np.append(first, len(self.docs)))
        before = np.cumsum(own) - own
        within = before - np.repeat(before[first], texts)
        several = np.repeat(texts > 1, texts)
        bare = self.lengths[: self.unkeyed]
        return np.concatenate([np.cumsum(bare) - bare, at + within]), np.concatenate([bare, np.where(several, own, count)])


def _shard(part: int, number: int, docs: list[int | None], ids: list[bytes], width: int) -> dict:
    count = np.array([len(x) // width for x in ids], np.int64)
    start = np.cumsum(count) - count
    unkeyed = sum(x is None for x in docs)
    keys = np.array(docs[unkeyed:], np.int64)
    # rows that share a key lie next to each other; the key finds the first of them and all their ids
    distinct, first = np.unique(keys, return_index=True)
    total = np.add.reduceat(count[unkeyed:], first) if len(first) else count[:0]
    index = PerfectHash.build(distinct.view(U))
    slot = index.find(distinct.view(U))
    prints, starts, counts = (np.zeros(len(distinct), "<u4") for _ in range(3))
    prints[slot], starts[slot], counts[slot] = fingerprints(distinct.view(U)), start[unkeyed:][first], total
    return {"part": part, "shard": number, "low": docs[unkeyed] if len(keys) else None, "high": docs[-1], "n_ids": int(count.sum()), "n_docs": len(docs), "payload": b"".join(ids), "docs": keys.astype("<i8").tobytes(), "lengths": count.astype("<u4").tobytes(), "unkeyed": unkeyed, "sizes": index.sizes.tobytes(), "bits": index.bits.tobytes(), "ranks": index.ranks.tobytes(), "prints": prints.tobytes(), "starts": starts.tobytes(), "counts": counts.tobytes()}


_TYPES = {"part": pa.int32(), "shard": pa.int32(), "low": pa.int64(), "high": pa.int64(), "n_ids": pa.int64(), "n_docs": pa.int64(), "unkeyed": pa.int32()}
_SCHEMA = pa.schema([(n, _TYPES.get(n, pa.binary())) for n in (x.split()[0] for x in SHARD.split(", "))])


def shards(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Shards of all texts in ascending id order (null ids first, unkeyed), each text closed by the id END."""
    prepare(docs.sparkSession)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, size, keys, ids = TaskContext.get().partitionId(), 0, 0, [], []
        encoder, close = word_encoder(path, False), np.array([END], "<u2").tobytes()
        for rows, texts in blocks(batches, "__text"):
            for key, x in zip(rows.column(0).to_pylist(), encoder.encode(texts), strict=True):
                if size >= SHARD_IDS and key != keys[-1]:
                    yield pa.RecordBatch.from_pylist([_shard(part, number, keys, ids, 2)], _SCHEMA)
                    number, size, keys, ids = number + 1, 0, [], []
                keys.append(key)
                ids.append(x + close)
                size += len(x) // 2 + 1
        if keys:
            yield pa.RecordBatch.from_pylist([_shard(part, number, keys, ids, 2)], _SCHEMA)

    plain = docs.select(docs[id].cast("bigint").alias("__id"), docs[text].alias("__text"))
    return plain.repartitionByRange("__id").sortWithinPartitions("__id", "__text").mapInArrow(write, SHARD)


def listing(table: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, each found through its shard's index; start counts the ids of all documents before it."""

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in rows.to_pylist():
                shard = Shard.read(row)
                start, count = shard.places()
                if (count <= 0).any() or (shard.payload[start + count - 1] != END).any():
                    raise ValueError("the index and the payload disagree")
                wide = memoryview(shard.payload.astype("<u4").tobytes())
                crc = [zlib.crc32(wide[4 * a : 4 * (a + n)]) for a, n in zip(start.tolist(), count.tolist(), strict=True)]
                keys = pa.concat_arrays([pa.nulls(shard.unkeyed, pa.int64()), pa.array(shard.docs)])
                same_part = [pa.array(np.full(row["n_docs"], row[x], np.int32)) for x in ("part", "shard")]
                yield pa.RecordBatch.from_arrays([*same_part, keys, pa.array(start), pa.array(count), pa.array(crc, pa.int64())], ["part", "shard", "doc_id", "own_start", "n_tokens", "ids_crc32"])

    found = table.mapInArrow(look, "part int, shard int, doc_id bigint, own_start bigint, n_tokens bigint, ids_crc32 bigint")
    sizes = table.select("part", "shard", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))  # as many rows as the writer had tasks
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    within = Window.partitionBy("part").orderBy("shard")
    base = sizes.withColumn("own", F.sum("n_ids").over(within) - F.col("n_ids")).join(before, "part").select("part", "shard", (F.col("own") + F.col("before")).alias("base"))
    return found.join(base, ["part", "shard"]).select("doc_id", (F.col("base") + F.col("own_start")).alias("start"), "n_tokens", "ids_crc32")


def lookup(table: DataFrame, keys: list[int], id: str = "doc_id") -> DataFrame:
    """(id, ids array<int>) for those of the keys (a short list, sent to every task) that the shards hold.

    A shard says which keys it lies between, and shards are written in the order of
    keys, so the store gives up those alone that a key can be in; within, a key
    costs a look at the hash's levels.
    """

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = np.array(sorted(set(keys)), np.int64)
        for rows in batches:
            for row in rows.to_pylist():
                shard = Shard.read(row)
                at, n = shard.find(ask)
                hit = np.flatnonzero(at >= 0)
                yield pa.RecordBatch.from_arrays([pa.array(ask[hit]), pa.array([shard.payload[at[i] : at[i] + n[i]].astype(np.int32) for i in hit], pa.list_(pa.int32()))], [id, "ids"])

    if not keys:
        return table.limit(0).mapInArrow(find, f"{id} bigint, ids array<int>")
    near = (F.col("low") <= max(keys)) & (F.col("high") >= min(keys))
    if len(keys) <= SINGLY:
        near = reduce(or_, ((F.col("low") <= k) & (F.col("high") >= k) for k in sorted(set(keys))))
    return table.where(near).mapInArrow(find, f"{id} bigint, ids array<int>")


def write(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """Writes the shards to a table in the shared folder and returns it as read back."""
    return Store(spark, "shards").keep(shards(docs, path))
