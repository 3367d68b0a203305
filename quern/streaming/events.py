"""Events of runs: an append-only log and a heartbeat, as JSON in any store that Spark knows."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _line(record: dict[str, Any]) -> str:
    return json.dumps({"timestamp": datetime.now(timezone.utc).isoformat(), **record}, ensure_ascii=False, sort_keys=True)


def log(spark: SparkSession, path: str, *records: dict[str, Any]) -> None:
    """Appends a line for each record, with the time."""
    spark.createDataFrame([(_line(r),) for r in records], "value string").coalesce(1).write.mode("append").text(path)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def heartbeat(spark: SparkSession, path: str, **record: Any) -> None:
    """The latest state of a run, in place of the one before."""
    spark.createDataFrame([(_line(record),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def step_metrics(steps: DataFrame, run: str, step: str, tokens: str, seconds: str, target: int) -> DataFrame:
    """steps with tokens a second since the step before, the share of the target that is reached, and the seconds left at the mean speed so far."""
    from pyspark.sql import Window

    w = Window.partitionBy(run).orderBy(step)
    ahead = F.col(tokens) - F.coalesce(F.lag(tokens).over(w), F.lit(0))
    took = F.col(seconds) - F.coalesce(F.lag(seconds).over(w), F.lit(0))
    speed = F.when(took > 0, ahead / took)
    left = F.greatest(F.lit(0), F.lit(target) - F.col(tokens))
    return steps.select("*", speed.alias("tokens_per_second"), F.least(F.lit(1.0), F.col(tokens) / F.lit(target)).alias("progress"), F.when(F.col(tokens) > 0, left * F.col(seconds) / F.col(tokens)).alias("eta_seconds"))
