"""JSONL and Parquet files behind URLs, fetched in the tasks, with a cursor that says how many rows of each were taken."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.sources.readers import Source, _fields, _metadata, documents, jsonl_lines, unpacked

#: Rows that go to the JVM at once.
BATCH = 2000


def _rows(spark: SparkSession, urls: list[str], get: Callable[[str], bytes], cursor: dict[str, int], each: Callable[[bytes], Iterator[str]]) -> DataFrame:
    """(file, line, value) of each URL's rows after those that the cursor says were taken; one URL is one task."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for url in part["url"]:
                skip, held = cursor.get(url, 0), []
                for i, value in enumerate(each(get(url))):
                    if i < skip:
                        continue
                    held.append((url, i, value))
                    if len(held) == BATCH:
                        yield pd.DataFrame(held, columns=["file", "line", "value"])
                        held = []
                yield pd.DataFrame(held, columns=["file", "line", "value"])

    table = spark.createDataFrame([(u,) for u in sorted(urls)], "url string")
    return table.repartition(max(1, min(len(urls), 10_000)), "url").mapInPandas(run, "file string, line bigint, value string")


def _lines(content: bytes) -> Iterator[str]:
    return (x.decode("utf-8", "replace").rstrip("\r\n") for x in unpacked(content))


def _records(content: bytes) -> Iterator[str]:
    import json

    import pyarrow.parquet as pq

    for batch in pq.ParquetFile(io.BytesIO(content)).iter_batches(BATCH):
        for row in batch.to_pylist():
            yield json.dumps(row, ensure_ascii=False, default=str)


def read_remote(spark: SparkSession, source: Source, urls: list[str], get: Callable[[str], bytes], kind: str = "jsonl", cursor: dict[str, int] | None = None) -> DataFrame:
    """Documents of remote files (kind: jsonl, whatever its compression, or parquet) from the cursor on; `get` fetches a URL in a task."""
    lines = _rows(spark, urls, get, cursor or {}, _lines if kind == "jsonl" else _records)
    if kind == "jsonl":
        return jsonl_lines(lines, source)
    rows = lines.withColumn("row", F.from_json("value", _fields(source)))
    return documents(rows, source, F.col(f"row.{source.text_field}"), F.col(f"row.{source.id_field}"), _metadata(source, F.col("file").alias("path"), F.col("line")), ["file", "line"])


def advanced(taken: DataFrame, cursor: dict[str, int] | None = None) -> dict[str, int]:
    """The cursor after the documents taken(file, line): one number a URL."""
    return (cursor or {}) | {r.file: r.n for r in taken.groupBy("file").agg((F.max("line") + 1).alias("n")).collect()}
