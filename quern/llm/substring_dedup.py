"""Substring removal over words: every window of 35 words that occurs more than once goes.

The corpus is its own reference.  Winnowing cuts every document into runs of
windows that share an anchor, so equal text is cut alike; the index holds each
run's name, and a run that the index has from elsewhere is a factor copied whole.
Where a copy ends, at a factor's boundary, the run differs from those that share
its anchor; it is opened into shorter pieces, down to the single window of 35
words, and each is looked up again.  What is covered by windows that occur
elsewhere is a duplicate span.

This stands in for relative Lempel-Ziv parsing and isn't it: no document is read
against a reference block from left to right for its longest factors.  A greedy
parse holds one block at a time against all documents, so its cost is documents
times blocks; the index answers the same question, which windows occur elsewhere,
in three passes over the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.spans import covered, in_bins, numbered, repeated_windows, with_spans, word_symbols
from quern.llm.store import Store
from quern.llm.vectors import BLANK_WORDS, blocks, words

LENGTH, ANCHOR, BIN = 35, 10, 4


def factors(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """docs as (doc, row, text), and for each row the runs of windows of `length` words that occur elsewhere."""
    store = Store(docs.sparkSession, "substring")
    docs = numbered(store, docs.select(docs[id].cast("bigint").alias("doc"), docs[text].alias("text")))
    return docs, repeated_windows(store, docs, word_symbols, length, ANCHOR, in_bins(word_symbols, length, [BIN, 1], keep_first=False), keep_first=False)


def remove_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space) of each document.

    A null, empty or blank text has no words; a document of fewer words than a
    window loses nothing; all copies of a repeated window go, in one document
    as in several.  Rows that share an id, or have none, are documents of their
    own, repeated rows copies of each other.  An empty table has no rows.  Texts
    may have up to 2^28 words.  Other columns of docs are not read.
    """
    docs, found = factors(docs, id, text, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches, "text"):
            buf, begin, end, _, first = words(texts, BLANK_WORDS)
            inside, _, _ = covered(rows, first, length)
            whole = buf.tobytes()
            kept = []
            for a, b in zip(first[:-1], first[1:], strict=True):
                left = np.flatnonzero(~inside[a:b]) + a
                kept.append(b" ".join([whole[x:y] for x, y in zip(begin[left].tolist(), end[left].tolist(), strict=True)]))
            gone = np.concatenate([[0], np.cumsum(inside)])[first]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(first)), pa.array(np.diff(gone)), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return with_spans(docs, found).mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return remove_duplicates(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
