"""Shards, manifests, side outputs and state on disk."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quern.functions import text as T

CANONICAL = ["id", "text", "source", "domain", "language", "metadata"]


def sized_shards(records: DataFrame, order: list[str], max_bytes: int, before: bool = True, by: str = "source") -> DataFrame:
    """records with shard, per source and in order.

    With `before`, a record that would take its shard past max_bytes opens a new
    one, so no shard of more than one record is larger than that; else the shard
    that a record fills is closed after it.  `order` must tell a source's records
    apart.
    """
    size = F.octet_length(F.to_json(F.struct(*[c for c in CANONICAL if c in records.columns]))) + 1
    return rolled(records, by, order, size, max_bytes, before)


def rolled(records: DataFrame, by: str, order: list[str], size: Column, most: int, before: bool = True) -> DataFrame:
    """records with shard: a new one whenever the sizes of those in order would pass (before) or have reached (else) `most`.

    Where a shard begins depends on where the last one did, so a group's sizes
    pass through one task; but nothing else of its records does, and the task
    holds only the batch at hand.
    """
    own = records.select(F.col(by).alias("__by"), *(F.col(o).alias(f"__o{i}") for i, o in enumerate(order)), size.cast("bigint").alias("__size"))
    keys = [f"__o{i}" for i in range(len(order))]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard, group = 0, 0, object()
        for rows in batches:
            out = []
            for g, n in zip(rows.column(0).to_pylist(), rows.column(rows.num_columns - 1).to_pylist(), strict=True):
                if g != group:
                    held, shard, group = 0, 0, g
                if before and held and held + n > most or not before and held >= most:
                    held, shard = 0, shard + 1
                held += n
                out.append(shard)
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(out, pa.int64())], [*rows.schema.names[:-1], "shard"])

    schema = StructType([*own.schema.fields[:-1], StructField("shard", LongType())])
    dealt = own.repartition("__by").sortWithinPartitions("__by", *keys).mapInArrow(cut, schema)
    same = records[by].eqNullSafe(dealt["__by"])
    for o, k in zip(order, keys, strict=True):
        same = same & records[o].eqNullSafe(dealt[k])
    return records.join(dealt, same).select(*(records[c] for c in records.columns), "shard")


def numbered_shards(records: DataFrame, order: list[str], each: int, by: str = "source") -> DataFrame:
    """records with shard: `each` of a source, in order, to a shard."""
    n = F.row_number().over(Window.partitionBy(by).orderBy(*order)) - 1
    return records.withColumn("shard", F.floor(n / each).cast("bigint"))


def canonical(records: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    """The six string columns; empty values become the defaults, and metadata JSON."""
    defaults = defaults or {}
    out = []
    for name in CANONICAL:
        c = F.col(name) if name in records.columns else F.lit(None)
        if name == "metadata" and name in records.columns and dict(records.dtypes)[name] != "string":
            c = F.to_json(c)
        c = c.cast("string")
        out.append(c.alias(name) if name in ("id", "text") else F.coalesce(F.nullif(c, F.lit("")), F.lit(defaults.get(name, "{}" if name == "metadata" else "unknown"))).alias(name))
    return records.select(*out)


def write_shards(records: DataFrame, path: str, kind: str = "parquet", again: bool = False) -> None:
    """One file for each source and shard, in folders by both."""
    writer = records.repartition("source", "shard").sortWithinPartitions("source", "shard").write.mode("overwrite" if again else "errorifexists").partitionBy("source", "shard")
    if kind == "parquet":
        writer.option("compression", "zstd").option("parquet.block.size", str(64 << 20)).parquet(path)
    else:
        writer.option("compression", "zstd").json(path)


def split(docs: DataFrame, reason: str, kept_path: str, rejected_path: str, id: str = "id") -> None:
    """Kept documents and, beside them, the rejected with their reasons."""
    docs.where(F.col(reason).isNull()).drop(reason).write.parquet(kept_path)
    docs.where(F.col(reason).isNotNull()).select(id, reason).write.json(rejected_path)


def build_manifest(spark: SparkSession, path: str, source: str, domain: str = "general", language: str = "unknown", weight: float = 1.0, license: str = "unknown") -> DataFrame:
    """A row for each Parquet file under path: records, bytes, estimated tokens and the file's sha256."""
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:///")  # noqa: E731  local files are named in two ways
    rows = spark.read.parquet(path).select("text", plain(F.col("_metadata.file_path")).alias("uri"))
    counts = rows.groupBy("uri").agg(F.count(F.lit(1)).alias("num_records"), F.sum(T.token_estimate(F.coalesce("text", F.lit("")))).alias("estimated_tokens"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    files = files.select(plain("path").alias("uri"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    fixed = {"source": source, "domain": domain, "language": language, "format": "parquet", "license": license}
    out = files.join(counts, "uri", "left").na.fill(0, ["num_records", "estimated_tokens"])
    out = out.withColumns({k: F.lit(v) for k, v in fixed.items()}).withColumn("weight", F.lit(weight)).withColumn("created_at", F.lit(datetime.now(timezone.utc).isoformat()))
    return out.withColumn("id", F.regexp_extract("uri", r"([^/]+)\.[^./]+$", 1)).withColumn("record_start", F.lit(0).cast("bigint")).withColumn("record_end", F.lit(None).cast("bigint"))


def manifest_digest(manifest: DataFrame) -> str:
    """sha256 of the rows as sorted JSON, in uri order; a manifest is one row a file, and goes through the driver a row at a time."""
    h = hashlib.sha256()
    for r in manifest.orderBy("uri", "record_start").toLocalIterator():
        h.update((json.dumps(r.asDict(), sort_keys=True, default=str) + "\n").encode())
    return h.hexdigest()


def write_manifest(manifest: DataFrame, path: str, version: str = "0.1.0", again: bool = False) -> dict:
    mode = "overwrite" if again else "errorifexists"
    manifest.write.mode(mode).json(f"{path}/manifest")
    spark = manifest.sparkSession
    own = spark.read.schema(manifest.schema).json(f"{path}/manifest")
    t = own.agg(F.count(F.lit(1)), F.sum("bytes"), F.sum("num_records"), F.sum("estimated_tokens")).first()
    meta = {"manifest_version": version, "created_at": datetime.now(timezone.utc).isoformat(), "manifest_sha256": manifest_digest(own), "num_shards": t[0], "total_bytes": t[1] or 0, "total_records": t[2] or 0, "total_estimated_tokens": t[3] or 0}
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "value string").coalesce(1).write.mode(mode).text(f"{path}/meta")
    return meta


def validate_manifest(spark: SparkSession, path: str, schema) -> dict:
    """The manifest's meta; an error if the manifest, its count or a shard's bytes have changed."""
    own = spark.read.schema(schema).json(f"{path}/manifest")
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    if manifest_digest(own) != meta["manifest_sha256"]:
        raise ValueError("the manifest differs from its digest")
    if own.count() != meta["num_shards"]:
        raise ValueError("the number of shards differs")
    uris = own.select("uri").distinct()
    folders = [r[0] for r in uris.select(F.regexp_extract("uri", r"^(.*)/[^/]+$", 1).alias("d")).distinct().collect()]
    if folders:
        files = spark.read.format("binaryFile").load(folders).select(F.regexp_replace("path", "^file:/+", "file:///").alias("uri"), F.sha2("content", 256).alias("now"))
        bad = own.join(files, "uri", "left").where("now is null or now <> sha256").select("uri").limit(5).collect()
        if bad:
            raise ValueError(f"shards differ from their digests: {[r[0] for r in bad]}")
    return meta


def save_state(hashes: DataFrame, path: str, run: str) -> None:
    """Digests and fingerprints that the run kept, for the next one; a run that is done again replaces its own."""
    hashes.write.mode("overwrite").parquet(f"{path}/run={run}")


def corpus_text(docs: DataFrame, path: str, text: str = "text") -> None:
    """One line a document, in folders by shard, to train or test tokenizers on."""
    docs.select(F.regexp_replace(text, r"\n", " ").alias("value")).write.option("compression", "gzip").text(path)
