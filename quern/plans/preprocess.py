"""A preprocessing run: sources, cleaning, copies, scores, shards and their manifest."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import hashing as H
from quern.functions.prefix import running_total
from quern.operators import cleaning as C
from quern.operators import dedup as D
from quern.operators import metrics as M
from quern.plans.base import keep
from quern.sources import readers, sinks


@dataclass(frozen=True)
class Run:
    sources: list[readers.Source]
    output: str
    rules: C.Cleaning = field(default_factory=C.Cleaning)
    mode: str = "serial"
    near: bool = True
    threshold: int = 3
    group_cap: int = 4096
    shard_max_bytes: int = 128 << 20
    #: A table of the hashes and fingerprints that earlier runs kept; this run's are added to it, under its name.
    state: str | None = None
    name: str = "0"


def sequenced(docs: DataFrame) -> DataFrame:
    """docs with seq, a number that follows the order of sources, files and lines.

    Files are numbered (there are few), and a file's lines keep their numbers, so
    no step orders all documents.
    """
    files = docs.groupBy("source_index", "file").agg((F.max("line") + 1).alias("n"))
    numbered = files.withColumn("k", F.row_number().over(_by_file()).cast("bigint"))
    at = running_total(numbered, "k", "n", "base").select("source_index", "file", "base")
    return docs.join(F.broadcast(at), ["source_index", "file"]).withColumn("seq", F.col("base") + F.col("line"))


def _by_file():
    from pyspark.sql import Window

    return Window.orderBy("source_index", "file")


def decided(docs: DataFrame, run: Run) -> DataFrame:
    """docs with one reason each (null: kept), in the run's mode."""
    first = run.mode != "serial"
    base = C.with_reasons(docs, run.rules if first else _lenient(run.rules), id="seq", domain="domain", quality_first=first)
    base = keep(base.withColumn("poor", F.col("quality_score") < run.rules.min_quality))
    if run.state:
        known = base.sparkSession.read.parquet(run.state)
        seen = known.select(F.col("hash").alias("h"), F.lit(True).alias("seen")).distinct()
        base = base.join(seen, F.col("hash") == F.col("h"), "left").withColumn("reason", F.coalesce("reason", F.when(F.col("seen"), "exact_duplicate"))).drop("h", "seen")
    near = full = None
    if run.near:
        passed = base.where("reason is null" if not first else "reason is null or reason = 'exact_duplicate'").select("seq", "clean")
        prints = H.simhash_md5(passed, "seq", "clean").select("seq", "bits")
        if run.state:  # fingerprints that earlier runs kept come before all of this one
            earlier = known.where("bits is not null").select("bits").distinct().select((-F.pmod(F.xxhash64("bits"), F.lit(1 << 62)) - 1).alias("seq"), "bits")
            prints = prints.unionByName(earlier)
        prints = keep(prints)
        if first:
            grouped = keep(D.banded_groups(prints, "seq", run.threshold, run.group_cap))
            near = grouped.where("first_id is not null").select(F.col("id").alias("n"))
            full = grouped.where("first_id is null and capped").select(F.col("id").alias("f"))
        else:
            heads = D.exact(prints, "seq", "bits")
            gone = D.greedy(D.pairs(heads.where("seq = first_id").select("seq", "bits"), "seq", run.threshold), keep)
            near = heads.join(gone, F.col("first_id") == F.col("id"), "left").where("kept_by is not null or seq <> first_id").select(F.col("seq").alias("n"))
        own = prints.where("seq >= 0").select(F.col("seq").alias("p"), "bits")
        base = base.join(own, F.col("seq") == F.col("p"), "left").drop("p")
    else:
        base = base.withColumn("bits", F.lit(None).cast("bigint"))
    if near is not None:
        base = base.join(near.distinct(), F.col("seq") == F.col("n"), "left").withColumn("reason", F.coalesce("reason", F.when(F.col("n").isNotNull(), "near_duplicate"))).drop("n")
    if not first:
        base = base.withColumn("reason", F.coalesce("reason", F.when(F.col("poor"), "low_quality")))
    # rows that stay because their group held its bound of others to compare with
    base = base.withColumn("capped", F.lit(False)) if full is None else base.join(full.distinct(), F.col("seq") == F.col("f"), "left").withColumn("capped", F.col("f").isNotNull() & F.col("reason").isNull()).drop("f")
    return base


def _lenient(rules: C.Cleaning) -> C.Cleaning:
    """The same rules, but for quality, which comes last in the serial mode."""
    from dataclasses import replace

    return replace(rules, min_quality=0.0)


class Stages:
    """A run's tables by name; one that was written to its end is read instead of made again, if the run resumes."""

    def __init__(self, spark: SparkSession, path: str, resume: bool):
        self.spark, self.path, self.resume = spark, path, resume

    def done(self, path: str) -> bool:
        """Whether Spark's own mark says that the folder was written to its end."""
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return self.resume and mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(mark)

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.path}/{name}"
        if not self.done(path):
            make().write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)

    def write(self, path: str, write: Callable[[], None]) -> None:
        if not self.done(path):
            write()


def _same_run(stages: Stages, run: Run) -> None:
    """Writes down what the run is; an error if a run that resumes is another."""
    text = json.dumps(asdict(run), sort_keys=True)
    path = f"{stages.path}/config"
    if stages.done(path):
        if stages.spark.read.text(path, wholetext=False).first()[0] != text:
            raise ValueError("the run to resume had another configuration")
        return
    stages.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def preprocess(spark: SparkSession, run: Run, resume: bool = False) -> list[dict]:
    """Writes kept documents in shards, the rejected beside them, the manifest and the counters; returns the counters.

    Its stages are tables under output/stages.  With `resume`, a run that was cut
    off goes on after the last whole one, so that each record is written once.
    """
    stages = Stages(spark, f"{run.output}/stages", resume)
    _same_run(stages, run)
    docs = stages.table("documents", lambda: sequenced(keep(readers.read_all(spark, run.sources))))
    done = stages.table("decided", lambda: decided(docs, run))
    meta = F.to_json(F.struct(F.col("metadata").alias("source"), F.struct("control_char_ratio", "alpha_or_cjk_ratio", "repeated_line_ratio").alias("cleaning"), F.col("hash").alias("dedup_hash"), H.unsigned(F.col("bits")).alias("simhash"), "quality_score", F.col("signals").alias("quality_signals")))
    kept = done.where("reason is null").select("id", F.col("clean").alias("text"), "source", "domain", "language", meta.alias("metadata"), "seq")
    stages.write(f"{run.output}/shards", lambda: sinks.write_shards(sinks.sized_shards(kept, ["seq"], run.shard_max_bytes), f"{run.output}/shards", again=resume))
    stages.write(f"{run.output}/rejected", lambda: done.where("reason is not null").select("id", "source", "reason").write.mode("overwrite" if resume else "errorifexists").json(f"{run.output}/rejected"))
    counts = [r.asDict() for r in M.counters(done, "source", "reason").collect()]  # a row a source, and below a row a source and reason
    reasons: dict[str, dict[str, int]] = {}
    for r in M.reason_counts(done, "source", "reason").unionByName(M.flag_counts(done, "source", "capped", "simhash_capped")).collect():
        reasons.setdefault(r["source"], {})[r["name"]] = r["n"]
    counts = [c | reasons.get(c["source"], {}) for c in counts]
    if not done.where("reason is null").isEmpty():
        stages.write(f"{run.output}/manifest/meta", lambda: sinks.write_manifest(sinks.build_manifest(spark, f"{run.output}/shards", "all"), f"{run.output}/manifest", again=resume))
    if run.state:
        sinks.save_state(done.where("reason is null").select("hash", "bits"), run.state, run.name)
    spark.createDataFrame([(json.dumps(c, sort_keys=True),) for c in counts], "value string").coalesce(1).write.mode("overwrite" if resume else "errorifexists").text(f"{run.output}/stats")
    return counts
