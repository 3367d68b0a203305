"""Tables between the steps of an operator, in the folder that all machines share."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from quern.sources.tables import shared_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package, and keep their batches small."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


class Store:
    """A folder of its own under the shared one: keep() writes a table and reads it back, which cuts the lineage; drop() deletes it, clear() all others."""

    def __init__(self, spark: SparkSession, name: str):
        prepare(spark)
        self.spark, self.path, self.n = spark, f"{shared_folder(spark)}/quern/{name}-{uuid.uuid4().hex[:12]}", 0
        self.paths: dict[int, str] = {}

    def keep(self, df: DataFrame, codec: str = "zstd") -> DataFrame:
        self.n += 1
        path = f"{self.path}/{self.n}"
        before = self.spark.conf.get(_CLEANUP)
        self.spark.conf.set(_CLEANUP, "true")  # the shuffle files of a table that is written are of no more use
        try:
            df.write.option("compression", codec).parquet(path)
        finally:
            self.spark.conf.set(_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            if path := self.paths.pop(id(df), None):
                self._delete(path)

    def clear(self, *tables: DataFrame) -> None:
        """Deletes every table but these."""
        kept = {id(df): self.paths[id(df)] for df in tables}
        for n in range(1, self.n + 1):
            if (path := f"{self.path}/{n}") not in kept.values():
                self._delete(path)
        self.paths = kept

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
