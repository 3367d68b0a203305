"""Tokens per document from flat token files without an index.

A file is a row of blocks of ids; a block ends after BLOCK_IDS ids wherever that
falls.  Each block is searched by itself for the end-of-document id, with one
vectorised comparison; it reports how many it has, the ids before the first and
after the last, and the lengths between.  A prefix scan over these few numbers per
block then says which document a block begins in and how many of its ids came
before, which stitches the documents that cross blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.store import Store, prepare
from quern.llm.vectors import blocks
from quern.llm.word_bpe import word_encoder

BLOCK_IDS = 1 << 18
FILES = "file int, block int, payload binary, docs array<bigint>"


def token_files(docs: DataFrame, path: str, end: int, id: str = "doc_id", text: str = "text", block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of the flat files, one file a task: the texts' ids, each text closed by `end`, which no text yields by itself.

    docs lists the ids of the documents that end within the block; the scan
    doesn't read it, it only names the counts afterwards.
    """
    prepare(docs.sparkSession)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, number, held, keys = TaskContext.get().partitionId(), 0, b"", []
        encoder, close = word_encoder(path, True), np.array([end], "<u2").tobytes()
        size = 2 * block_ids

        def out(payload: bytes) -> pa.RecordBatch:
            nonlocal number, keys
            n = int(np.count_nonzero(np.frombuffer(payload, "<u2") == end))
            done, keys = keys[:n], keys[n:]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([file], pa.int32()), pa.array([number - 1], pa.int32()), pa.array([payload], pa.binary()), pa.array([done], pa.list_(pa.int64()))], ["file", "block", "payload", "docs"])

        for rows, texts in blocks(batches, "__text"):
            keys.extend(rows.column(0).to_pylist())
            held += b"".join([x + close for x in encoder.encode(texts)])
            while len(held) >= size:
                yield out(held[:size])
                held = held[size:]
        if held:
            yield out(held)

    return docs.select(docs[id].cast("bigint").alias("__id"), docs[text].alias("__text")).mapInArrow(write, FILES)


def scan(files: DataFrame, end: int) -> DataFrame:
    """(file, block, n, gaps): of each block, the number of end ids, and the ids before the first, between them and after the last."""
    prepare(files.sparkSession)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for file, block, payload in zip(*(rows.column(i).to_pylist() for i in range(3)), strict=True):
                ids = np.frombuffer(payload, "<u2")
                at = np.flatnonzero(ids == end)
                gaps = np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1
                yield pa.RecordBatch.from_arrays([pa.array([file], pa.int32()), pa.array([block], pa.int32()), pa.array([len(at)], pa.int64()), pa.array([gaps], pa.list_(pa.int64()))], ["file", "block", "n", "gaps"])

    return files.select("file", "block", "payload").mapInArrow(search, "file int, block int, n bigint, gaps array<bigint>")


def stitched(found: DataFrame) -> DataFrame:
    """(file, block, i, n_tokens): the count, without the end id, of the i-th document that ends in the block."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    run = found.withColumn("tail", F.element_at("gaps", -1)).withColumn("all", F.aggregate("gaps", F.lit(0).cast("bigint"), lambda a, b: a + b))
    # ids of the open document: all ids before this block less those up to the last end id before it
    run = run.withColumn("ids", F.sum("all").over(before)).withColumn("inner", F.when(F.col("n") > 0, F.coalesce("ids", F.lit(0)) + F.col("all") - F.col("tail")))
    run = run.withColumn("carry", F.coalesce(F.col("ids") - F.coalesce(F.max("inner").over(before), F.lit(0)), F.lit(0)))
    done = run.where("n > 0").select("file", "block", "carry", F.posexplode(F.slice("gaps", F.lit(1), F.col("n").cast("int"))).alias("i", "gap"))
    return done.select("file", "block", "i", (F.col("gap") + F.when(F.col("i") == 0, F.col("carry")).otherwise(0)).alias("n_tokens"))


def counts(docs: DataFrame, path: str, end: int, id: str = "doc_id", text: str = "text", block_ids: int = BLOCK_IDS) -> DataFrame:
    """(id, n_tokens) of each text: written to flat files, scanned and stitched.  A null, empty or blank text has none."""
    files = Store(docs.sparkSession, "flat").keep(token_files(docs, path, end, id, text, block_ids))
    names = files.select("file", "block", F.posexplode("docs").alias("i", id))
    return stitched(scan(files, end)).join(names, ["file", "block", "i"]).select(id, "n_tokens")
