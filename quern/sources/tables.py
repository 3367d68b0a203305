"""Tables: those between the steps of a plan, in the folder that the cluster shares, and Parquet tables dealt out to all tasks where a file has too few row groups for that."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as tasks can run at once.

    A table of one row group is one task however long its texts take; dealing its
    rows out costs one shuffle of a table that is smaller than that.  Tables with
    enough partitions stay as they are.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks) if df._jdf.rdd().getNumPartitions() < tasks else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.  Only a local session may be without one: then a local folder is set."""
    if not (base := spark.conf.get("spark.checkpoint.dir", None)):
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        base = f"{tempfile.gettempdir()}/quern-checkpoints"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the one that the cluster shares."""
    return f"{shared_folder(spark)}/quern/{name}-{uuid.uuid4().hex[:12]}"


def kept_table(df: DataFrame) -> DataFrame:
    """Written and read back, which cuts the lineage."""
    path = scratch(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
