"""Deduplication and counters over files as they arrive, with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text as T


def arriving(spark: SparkSession, path: str, schema, files_each: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_each).parquet(path)


def new_documents(stream: DataFrame, text: str = "text", time: str | None = None, keep: str = "7 days") -> DataFrame:
    """The first document of each normalised hash.

    With an event time, a hash is remembered for `keep` after it, so the state is
    bounded; without one it is remembered for ever, as long as the checkpoint.
    """
    hashed = stream.withColumn("hash", T.exact_hash(T.clean(F.coalesce(F.col(text), F.lit("")))))
    if time is None:
        return hashed.dropDuplicates(["hash"])
    return hashed.withWatermark(time, keep).dropDuplicatesWithinWatermark(["hash"])


def windowed_counts(stream: DataFrame, time: str, by: str, width: str, late: str) -> DataFrame:
    """Counts per event-time window and group; rows later than `late` are dropped, and a window is final once that has passed."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n")


def run_to_end(df: DataFrame, checkpoint: str, path: str, mode: str = "append") -> None:
    """All that is there now, exactly once, into a Parquet table; a later call goes on from the checkpoint."""
    query = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).option("path", path).format("parquet").trigger(availableNow=True).start()
    query.awaitTermination()
