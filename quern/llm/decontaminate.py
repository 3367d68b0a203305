"""Benchmark decontamination by winnowing.

Of every window of 10 words the least 5-word name is kept, the leftmost of equals,
on both sides alike, so a shared window always shares a kept name.  The test items'
kept names are joined to the documents'; each meeting is extended to the windows of
10 words that hold it, which count if an item has them.  An item of fewer words is
one window of its own length, and is looked for by a name of that length.

The items are a query set: they go to every task in blocks of a bounded size, and
each block meets all documents.  One block takes one pass over the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.store import Store, prepare
from quern.llm.vectors import ALNUM_WORDS, blocks, grams, minimizers, prefix, words

WINDOW, GRAM = 10, 5
#: Bytes of item text in a block, which is what a broadcast holds (times a small factor).
BLOCK_BYTES = 8 << 20


@dataclass
class Index:
    """kept: kept names, sorted.  For each window length: names of windows, sorted, and for each the range of its items in `items`."""

    kept: np.ndarray
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def build_index(items: list[tuple[int, bytes]], window: int, gram: int) -> Index:
    """items: numbers and texts."""
    _, _, _, names, first = words([x for _, x in items], ALNUM_WORDS, lower=True)
    sums = prefix(names)
    kept, found = [], {}
    gram_names = grams(sums, gram)
    for (number, _), a, b in zip(items, first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b > a:
            length = min(window, b - a)
            own = grams(sums, length)[a : b - length + 1] if length < window else _window_names(sums, window)[a : b - window + 1]
            found.setdefault(length, []).append((own, np.full(len(own), number, np.int64)))
            if length == window:
                kept.append(gram_names[a + minimizers(gram_names[a : b - gram + 1], window - gram + 1)])
    windows = {}
    for length, parts in found.items():
        names_of, numbers = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
        order = np.lexsort((numbers, names_of))
        names_of, numbers = names_of[order], numbers[order]
        distinct, at = np.unique(names_of, return_index=True)
        windows[length] = (distinct, np.append(at, len(names_of)), numbers)
    return Index(np.unique(np.concatenate([np.zeros(0, np.uint64), *kept])), windows)


def _window_names(sums: np.ndarray, window: int) -> np.ndarray:
    return grams(sums, window)


def _among(names: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Where each name stands among the known, sorted; -1 where it doesn't."""
    if not len(known):
        return np.full(len(names), -1)
    at = np.minimum(np.searchsorted(known, names), len(known) - 1)
    return np.where(known[at] == names, at, -1)


def hits(index: Index, texts: list[bytes], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words before each text (one more at the end); begin, length, window number and owner text of each occurrence of a window."""
    _, _, _, names, first = words(texts, ALNUM_WORDS, lower=True)
    sums = prefix(names)
    begins, lengths, numbers = [], [], []
    for length, (known, _, _) in index.windows.items():
        if length < window:
            at = np.arange(max(0, len(names) - length + 1))
            own = grams(sums, length)
        else:
            gram_names = grams(sums, gram)
            # the kept names of all windows; a window across two texts keeps one too many, which does no harm
            kept = minimizers(gram_names, window - gram + 1)
            kept = kept[np.concatenate([[True], kept[1:] != kept[:-1]])] if len(kept) else kept
            kept = kept[_among(gram_names[kept], index.kept) >= 0]
            # extended: windows that hold the kept name
            at = np.unique((kept[:, None] - np.arange(window - gram + 1)).ravel())
            at = at[(at >= 0) & (at + window <= len(names))]
            own = grams(sums, window)[at] if len(at) else np.zeros(0, np.uint64)
        which = _among(own, known)
        at, which = at[which >= 0], which[which >= 0]
        inside = at + length <= first[np.searchsorted(first, at, "right")] if len(at) else at < 0
        begins.append(at[inside])
        lengths.append(np.full(inside.sum(), length))
        numbers.append(which[inside])
    begin, length, number = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (begins, lengths, numbers))
    return first, begin, length, number, np.searchsorted(first, begin, "right") - 1


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK_BYTES, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, n_words, spans, items) of every document: merged hit stretches (begin, end, in words) and the ids of items found.

    A null text has no words.  Items of no words are never found; items that
    share an id, or a null id, count as one each time they appear in `items`.
    Rows of docs that share an id, or have none, are told apart by their text.  An
    empty table has no rows; texts may be of any length.
    """
    spark = docs.sparkSession
    prepare(spark)
    items = items.select(items[item_id].cast("bigint").alias("item"), F.coalesce(items[item_text], F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    n_blocks = max(1, -(-size // block_bytes))
    out = None
    for block in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == block) if n_blocks > 1 else items
        rows = sorted(part.collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))  # a block, bounded by block_bytes
        index = spark.sparkContext.broadcast((build_index([(i, r[1].encode()) for i, r in enumerate(rows)], window, gram), [r[0] for r in rows]))
        found = docs.select(docs[id].cast("bigint").alias("__id"), docs[text].alias("__text")).mapInArrow(_search(index, window, gram, n_blocks > 1), "id bigint, digest binary, n_words bigint, spans array<struct<begin:int,end:int>>, items array<bigint>")
        out = found if out is None else out.unionByName(found)
    if n_blocks > 1:  # each document's rows, one for each block, meet
        out = out.groupBy("id", "digest").agg(F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"), (F.count(F.lit(1)) / n_blocks).cast("int").alias("times"))
        out = out.withColumn("again", F.explode(F.sequence(F.lit(1), "times")))
    return out.select(F.col("id").alias(id), "n_words", "spans", F.array_distinct("items").alias("items"))


def _search(index, window: int, gram: int, digests: bool):
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ids = index.value
        for rows, texts in blocks(batches, "__text"):
            first, begin, length, number, owner = hits(own, texts, window, gram)
            spans, items = [[] for _ in texts], [set() for _ in texts]
            for doc, a, n, w in sorted(zip(owner.tolist(), (begin - first[owner]).tolist(), length.tolist(), number.tolist(), strict=True)):
                if spans[doc] and a <= spans[doc][-1]["end"]:
                    spans[doc][-1]["end"] = max(spans[doc][-1]["end"], a + n)
                else:
                    spans[doc].append({"begin": a, "end": a + n})
                _, at, numbers = own.windows[n]
                items[doc].update(numbers[at[w] : at[w + 1]].tolist())
            digest = [hashlib.blake2b(x, digest_size=16).digest() for x in texts] if digests else [b""] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(digest, pa.binary()), pa.array(np.diff(first)), pa.array(spans, kind), pa.array([[ids[i] for i in sorted(x)] for x in items], pa.list_(pa.int64()))],
                ["id", "digest", "n_words", "spans", "items"],
            )

    return run


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = occurrences(docs, items, **options)
    # stretches of several blocks may overlap: sorted by begin, each adds what lies beyond the end so far
    ordered = F.array_sort("spans")
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
    beyond = lambda s, x: F.greatest(F.lit(0), x["end"] - F.greatest(s["end"], x["begin"]))
    n_hit = F.aggregate(ordered, start, lambda s, x: F.struct((s["n"] + beyond(s, x)).alias("n"), F.greatest(s["end"], x["end"]).alias("end")), lambda s: s["n"])
    names = F.array_sort(F.transform("items", lambda x: F.coalesce(x.cast("string"), F.lit(""))))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without those that share a window with an item; all columns stay.  Every row is a document of its own, whatever its id."""
    store, columns = Store(docs.sparkSession, "decontaminate"), docs.columns
    rows = store.keep(docs.select(F.struct(*(docs[x] for x in columns)).alias("whole"), docs[text].alias("text"), F.monotonically_increasing_id().alias("row")))
    bad = store.keep(occurrences(rows.select("row", "text"), items, id="row").where(F.size("spans") > 0).select(F.col("row").alias("bad")).distinct())
    return rows.join(bad, F.col("row") == F.col("bad"), "left_anti").select("whole.*")
