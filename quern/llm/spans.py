"""Windows of L symbols that occur more than once, over a whole corpus, without comparing pairs.

The search narrows in rounds.  The first names the runs of windows that share a
winnowed anchor: a name that occurs once ends the search for its windows, runs of
one class are decided together, and only one run of each class goes on, where its
anchor has several classes.  What is left is finished as the operator says, for
one in bins of a few windows that share all but a few of their symbols and then in
single windows.  Every step is an
aggregation that combines before it shuffles or an equi-join whose other side has
one row per key, so a name held by a third of all rows is split like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.runs import find_runs
from quern.llm.store import Store
from quern.llm.vectors import BLANK_WORDS, U, blocks, mix, prefix, spans, words

RUN = "doc bigint, row bigint, begin int, n int, lead int, a bigint, c bigint"
RUN_COLUMNS = ["doc", "row", "begin", "n", "lead", "a", "c"]
_RUN = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("begin", pa.int32()), ("n", pa.int32()), ("lead", pa.int32()), ("a", pa.int64()), ("c", pa.int64())])

Symbols = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def word_symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    _, _, _, names, first = words(texts, BLANK_WORDS)
    return names, first


def numbered(store: Store, docs: DataFrame, *columns: Column) -> DataFrame:
    """docs(doc, text, columns) with row, a number of its own for each row; kept, so that a row never gets another."""
    return store.keep(docs.select("doc", F.monotonically_increasing_id().alias("row"), "text", *columns))


def _batch(rows: pa.RecordBatch, owner: np.ndarray, begin, n, lead, a, c) -> pa.RecordBatch:
    of = [*(rows.column(i).take(pa.array(owner)) for i in (0, 1)), *(pa.array(x.astype(np.int32)) for x in (begin, n, lead)), pa.array(a.view(np.int64)), pa.array(c.view(np.int64))]
    return pa.RecordBatch.from_arrays(of, schema=_RUN)


def runs(docs: DataFrame, symbols: Symbols, length: int, k: int) -> DataFrame:
    """One row for each run of windows of docs(doc, row, text)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches):
            doc, *rest = find_runs(*symbols(texts), length, k)
            yield _batch(rows, doc, *rest)

    return docs.select("doc", "row", "text").mapInArrow(find, RUN)


def reopened(docs: DataFrame, todo: DataFrame, symbols: Symbols, length: int, width: int) -> DataFrame:
    """The runs todo, cut into bins of `width` windows by their distance from the anchor; a is what all windows of a bin share."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches):
            flat, first = symbols(texts)
            sums = prefix(flat)
            todo = rows.column(rows.schema.get_field_index("todo"))
            owner = np.repeat(np.arange(len(todo)), np.diff(todo.offsets.to_numpy()))
            begin, n, lead = (x.to_numpy().astype(np.int64) for x in todo.flatten().flatten())
            # bin q holds the windows that begin between q * width and q * width + width - 1 before the anchor
            high, low = lead // width, (lead - n + 1) // width
            count = high - low + 1
            run = np.repeat(np.arange(len(begin)), count)
            q = high[run] - (np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count))
            far, near = np.minimum(lead[run], q * width + width - 1), np.maximum((lead - n + 1)[run], q * width)
            base = first[owner[run]]
            anchor = base + begin[run] + lead[run]
            start, size = anchor - far, far - near + 1
            core = mix(spans(sums, anchor - q * width, anchor - q * width - width + 1 + length) + U(1))
            body = spans(sums, start, start + size - 1 + length)
            kind = mix(mix(body) + core + (size * 1_000_003 + (far - q * width)).astype(U))
            yield _batch(rows, owner[run], start - base, size, far, core, kind)

    grouped = todo.groupBy("row").agg(F.collect_list(F.struct("begin", "n", "lead")).alias("todo"))
    return docs.join(grouped, "row").select("doc", "row", "text", "todo").mapInArrow(cut, RUN)


def classes(found: DataFrame) -> DataFrame:
    """Each class once, with its first and last place."""
    place = F.struct("doc", "row", "begin")
    return found.groupBy("a", "c").agg(F.min(place).alias("f"), F.max(place).alias("g"), F.first("n").alias("n"), F.first("lead").alias("lead"))


def decided(found: DataFrame, known: DataFrame, keep_first: bool) -> DataFrame:
    """Runs whose windows occur elsewhere (keep_first: earlier)."""
    twice = known.where(~F.col("f").eqNullSafe(F.col("g"))).select(F.col("a").alias("a2"), F.col("c").alias("c2"), "f")
    out = found.join(twice, (F.col("a") == F.col("a2")) & (F.col("c") == F.col("c2")))
    return (out.where(~F.struct("doc", "row", "begin").eqNullSafe(F.col("f"))) if keep_first else out).select("row", "begin", "n")


def undecided(store: Store, known: DataFrame) -> DataFrame:
    """One run of each class whose anchor has several classes."""
    several = store.keep(known.groupBy(F.col("a").alias("a2")).agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("a2"))
    return known.join(several, F.col("a") == F.col("a2")).select("f.row", "f.begin", "n", "lead")


Finish = Callable[[Store, DataFrame, DataFrame], DataFrame]


def in_bins(symbols: Symbols, length: int, widths: list[int], keep_first: bool, then: Finish | None = None) -> Finish:
    """Decides undecided runs in bins of ever fewer windows; what these leave goes on to `then`, if there is one."""

    def finish(store: Store, docs: DataFrame, todo: DataFrame) -> DataFrame:
        out = None
        for i, width in enumerate(widths):
            found = store.keep(reopened(docs, todo, symbols, length, width))
            known = store.keep(classes(found))
            done = store.keep(decided(found, known, keep_first))
            out = done if out is None else out.unionByName(done)
            if then or i + 1 < len(widths):
                todo = store.keep(undecided(store, known))
            store.drop(found, known)
        return out.unionByName(then(store, docs, todo)) if then else out

    return finish


def repeated_windows(store: Store, docs: DataFrame, symbols: Symbols, length: int, k: int, finish: Finish, keep_first: bool) -> DataFrame:
    """(row, spans: begin, n): runs of windows of docs(doc, row, text) whose symbols also begin elsewhere; with keep_first, only where they do so earlier.

    finish(store, docs, todo) gives the runs or windows (row, begin, n) of this kind
    among the runs todo(row, begin, n, lead): one of each class whose anchor has
    several, the first.

    Order is by doc (null first), then row, then place.  Rows that share a doc are
    texts of their own.
    """
    every = runs(docs, symbols, length, k)
    # kept, so that the joins stand right above their exchanges and Spark can split a frequent anchor's rows
    often = store.keep(every.groupBy(F.col("a").alias("a2")).agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("a2"))
    found = store.keep(every.join(often, F.col("a") == F.col("a2")).select(*RUN_COLUMNS))
    known = store.keep(classes(found))
    done = store.keep(decided(found, known, keep_first))
    todo = store.keep(undecided(store, known))
    store.drop(found, known, often)
    part = store.keep(docs.join(todo.select("row").distinct(), "row", "left_semi").select("doc", "row", "text"))
    late = finish(store, part, todo)
    store.drop(part, todo)
    return done.unionByName(late).groupBy("row").agg(F.collect_list(F.struct("begin", "n")).alias("spans"))


def with_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs(doc, row, text) with the spans of each (null: none) in the last column."""
    own = [x for x in docs.columns if x != "row"]
    return docs.join(found, "row", "left").select(*own, "spans")


def covered(rows: pa.RecordBatch, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the block's symbols, which lie in a window of the spans (the last column); and for each maximal covered stretch its begin and end.

    first: where each row's symbols begin, and the end.  Places beyond a text are cut off.
    """
    todo = rows.column(rows.num_columns - 1)
    owner = np.repeat(np.arange(len(todo)), np.diff(todo.offsets.to_numpy()))
    begin, n = (x.to_numpy().astype(np.int64) for x in todo.flatten().flatten())
    begin, end = begin + first[owner], begin + n - 1 + length + first[owner]
    begin, end = np.minimum(begin, first[owner + 1]), np.minimum(end, first[owner + 1])
    level = np.zeros(first[-1] + 1, np.int32)
    np.add.at(level, begin, 1)
    np.add.at(level, end, -1)
    inside = np.cumsum(level)[:-1] > 0
    cut = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = cut[::2], cut[1::2]
    # a stretch that runs on into the next document is two
    cross = first[1:-1][inside[np.minimum(first[1:-1], max(0, len(inside) - 1))]] if len(inside) else first[:0]
    cross = np.unique(cross[(cross > 0) & (cross < first[-1])])
    cross = cross[inside[cross - 1]]
    return inside, np.sort(np.concatenate([starts, cross])), np.sort(np.concatenate([ends, cross]))
