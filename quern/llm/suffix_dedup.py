"""Substring removal over bytes: every 100-byte string that also starts earlier goes, by distributed prefix doubling.

The rank of a position tells the bytes that begin there from all others of that
length.  The first ranks are of 25 bytes; a position's rank and that of the
position as many bytes on are a pair, Spark orders the pairs into groups, and each
group is a new rank, that of twice the bytes: 25, 50, 100.  The first pairs lie in
one document and so in one task, the later ones meet in a join.  A position whose
rank is unique, or whose partner's is, is out of play; those that share a pair of
two times 50 bytes begin the same string, and all but the first of them go.

Ranking every byte of a corpus would shuffle it many times over, so three sieves
stand before, and most windows are decided there.  Winnowing keeps one 25-byte
string of each window, equal windows the same one; a window whose string occurs
once is unique.  A run of windows around such a string that is the same in several
documents is one to be ranked, the rest are copies.  And so with bins of 8 windows
of those runs, by the bytes that the 8 share.  Ranks are numbers without an order among them, as equality
is all that is asked; the first ones are 64-bit hashes of the 25 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.spans import Finish, covered, in_bins, numbered, repeated_windows, with_spans
from quern.llm.store import Store
from quern.llm.vectors import blocks, byte_symbols, grams, mix, prefix

LENGTH, RANK0, BIN = 100, 25, 8


def first_pairs(docs: DataFrame, todo: DataFrame, length: int) -> DataFrame:
    """(row, pos, part, r1, r2): of each half of each window of the runs todo, hashes of its first and its last quarter.

    part: 1 where a window begins, 2 where its second half does, 3 for both.  Halves
    and quarters of an odd number of bytes overlap.
    """
    half = -(-length // 2)
    quarter = -(-half // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches):
            flat, first = byte_symbols(texts)
            names = mix(grams(prefix(flat), quarter)).view(np.int64)
            todo = rows.column(rows.schema.get_field_index("todo"))
            owner = np.repeat(np.arange(len(todo)), np.diff(todo.offsets.to_numpy()))
            begin, n = (x.to_numpy().astype(np.int64) for x in todo.flatten().flatten())
            each = np.repeat(np.arange(len(begin)), n)
            window = (begin + first[owner])[each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            pos, at = np.unique(np.concatenate([window, window + (length - half)]), return_inverse=True)
            part = np.zeros(len(pos), np.int32)
            np.bitwise_or.at(part, at, np.repeat([1, 2], len(window)).astype(np.int32))
            of = np.searchsorted(first, pos, "right") - 1
            columns = [pa.array((pos - first[of]).astype(np.int32)), pa.array(part), pa.array(names[pos]), pa.array(names[pos + half - quarter])]
            yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(of)), *columns], ["row", "pos", "part", "r1", "r2"])

    grouped = todo.groupBy("row").agg(F.collect_list(F.struct("begin", "n")).alias("todo"))
    return docs.join(grouped, "row").select("row", "text", "todo").mapInArrow(run, "row bigint, pos int, part int, r1 bigint, r2 bigint")


def ranked(store: Store, pairs: DataFrame) -> DataFrame:
    """(row, pos, part, r) of pairs(row, pos, part, r1, r2): a number for each group of equal pairs; positions alone in their group go."""
    groups = pairs.groupBy(F.col("r1").alias("a"), F.col("r2").alias("b")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    numbers = store.keep(groups.select("a", "b", F.monotonically_increasing_id().alias("r")))
    out = store.keep(pairs.join(numbers, (F.col("r1") == F.col("a")) & (F.col("r2") == F.col("b"))).select("row", "pos", "part", "r"))
    store.drop(numbers)
    return out


def doubling(length: int) -> Finish:
    """Decides undecided runs by ranks of a quarter, of half and of all of `length` bytes."""
    step = length - -(-length // 2)

    def finish(store: Store, docs: DataFrame, todo: DataFrame) -> DataFrame:
        start = store.keep(first_pairs(docs, todo, length))
        halves = ranked(store, start)
        store.drop(start)
        ahead = halves.where("part >= 2").select(F.col("row").alias("row2"), (F.col("pos") - step).alias("pos2"), F.col("r").alias("r2"))
        begun = halves.where("part % 2 = 1").select("row", "pos", F.col("r").alias("r1"))
        pairs = begun.join(ahead, (F.col("row") == F.col("row2")) & (F.col("pos") == F.col("pos2"))).select("row", "pos", "r1", "r2")
        whole = store.keep(pairs.join(docs.select("doc", "row"), "row").select("doc", "row", "pos", "r1", "r2"))
        store.drop(halves)
        place = F.struct("doc", "row", "pos")
        first = whole.groupBy(F.col("r1").alias("a"), F.col("r2").alias("b")).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1")
        later = whole.join(first, (F.col("r1") == F.col("a")) & (F.col("r2") == F.col("b"))).where(~place.eqNullSafe(F.col("first")))
        out = store.keep(later.select("row", F.col("pos").alias("begin"), F.lit(1).alias("n")))
        store.drop(whole)
        return out

    return finish


def repeated_spans(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """docs as (doc, row, text, whole: all its columns but the text), and for each row the runs of `length`-byte windows that also begin earlier."""
    store = Store(docs.sparkSession, "suffix")
    whole = F.struct(*(docs[x] for x in docs.columns if x != text))
    docs = numbered(store, docs.select(docs[id].cast("bigint").alias("doc"), docs[text].alias("text"), whole.alias("whole")), F.col("whole"))
    return docs, repeated_windows(store, docs, byte_symbols, length, RANK0, in_bins(byte_symbols, length, [BIN], True, doubling(length)), keep_first=True)


def _kept(batches: Iterator[pa.RecordBatch], text: str, length: int) -> Iterator[tuple[pa.RecordBatch, list[bytes], list[bytes], np.ndarray, np.ndarray]]:
    for rows, texts in blocks(batches, text):
        first = np.cumsum([0] + [len(x) for x in texts])
        inside, starts, _ = covered(rows, first, length)
        flat = np.frombuffer(b"".join(texts), np.uint8)
        left = np.concatenate([[0], np.cumsum(~inside)])[first]
        rest = flat[~inside].tobytes()
        yield rows, texts, [rest[a:b] for a, b in zip(left[:-1], left[1:], strict=True)], np.diff(first) - np.diff(left), np.diff(np.searchsorted(starts, first))


def digest(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document.

    A null or empty text has no bytes and the digest of nothing; texts shorter
    than `length` lose nothing; of equal texts the least id stays whole.  Other
    columns of docs are not read.
    """
    docs, found = repeated_spans(docs.select(docs[id], docs[text]), id, text, length)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts, kept, removed, spans in _kept(batches, "text", length):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([len(x) for x in texts], pa.int64()), pa.array(removed), pa.array(spans), pa.array([hashlib.sha256(x).hexdigest() for x in kept])], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return with_spans(docs, found).mapInArrow(summed, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """docs with the repeated bytes cut out of the text; what is left of a split character goes too.  A null text becomes empty."""
    schema = docs.schema
    at = docs.columns.index(text)
    own, found = repeated_spans(docs, id, text, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, kept, _, _ in _kept(batches, "text", length):
            new = pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())
            other = rows.column(rows.schema.get_field_index("whole")).flatten()
            yield pa.RecordBatch.from_arrays([*other[:at], new, *other[at:]], schema.names)

    return with_spans(own, found).select("text", "whole", "spans").mapInArrow(cut, schema)
