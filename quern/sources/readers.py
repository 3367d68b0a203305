"""Scans of raw files into documents: id, text, source, domain, language, metadata (JSON).

Each scan is a plan over Spark's own readers, so it reads any store that Spark
knows; file_index and line_index keep the order that "first" refers to.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import text as X
from quern.functions.arrow import html_text

#: What a code tree yields, and what it leaves out, where a source doesn't say.
EXTENSIONS = [".py", ".js", ".ts", ".tsx", ".java", ".go", ".rs", ".cpp", ".c", ".h", ".hpp", ".md", ".txt"]
SKIPPED_FOLDERS = [".git", "node_modules", "vendor", "dist", "build", "__pycache__"]
GZIP, ZSTD = b"\x1f\x8b", b"\x28\xb5\x2f\xfd"


@dataclass(frozen=True)
class Source:
    """Where documents come from, and how their columns are named there."""

    name: str
    kind: str
    paths: list[str]
    domain: str = "general"
    language: str = "unknown"
    text_field: str = "text"
    id_field: str = "id"
    metadata_fields: list[str] = field(default_factory=list)
    skip: int = 0
    limit: int | None = None
    max_file_bytes: int = 1_000_000
    lenient: bool = False
    license: str = "unknown"
    include_extensions: list[str] = field(default_factory=lambda: list(EXTENSIONS))
    exclude_dirs: list[str] = field(default_factory=lambda: list(SKIPPED_FOLDERS))
    #: Columns of a JSONL file, as DDL; those named above if left out.
    schema: str | None = None


def documents(rows: DataFrame, source: Source, text: Column, id: Column, metadata: Column, order: list[str]) -> DataFrame:
    """Rows of a scan as documents: those without text go and aren't counted; an id that is null, empty or 0 becomes NAME/INDEX.

    skip and limit count the rows that have text, skip within limit.  The index is
    made for what needs it, from each file's count and the places within a file,
    and no text goes through that.
    """
    rows = rows.withColumn("__text", text.cast("string")).where("__text is not null").withColumn("__id", F.when(~id.cast("string").isin("", "0"), id.cast("string")))
    if source.limit is not None or source.skip:
        rows = rows.join(indexed(rows, order), order)
        if source.limit is not None:
            rows = rows.where(F.col("__index") < source.limit)
        rows = rows.where(F.col("__index") >= source.skip)
    else:
        given = rows.where("__id is not null").withColumn("__index", F.lit(None).cast("bigint"))
        other = rows.where("__id is null")
        rows = given.unionByName(other.join(indexed(rows, order), order))
    return rows.select(
        F.coalesce("__id", F.concat(F.lit(source.name + "/"), F.col("__index"))).alias("id"), F.col("__text").alias("text"), F.lit(source.name).alias("source"),
        F.lit(source.domain).alias("domain"), F.lit(source.language).alias("language"), metadata.alias("metadata"), *(F.col(o) for o in order),
    )


def indexed(rows: DataFrame, order: list[str]) -> DataFrame:
    """(file, line, __index) of rows(file, line): how many rows stand before, files by name and lines by number."""
    places = rows.select(*order)
    before = Window.orderBy(order[0]).rowsBetween(Window.unboundedPreceding, -1)
    files = places.groupBy(order[0]).agg(F.count(F.lit(1)).alias("__n")).withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0)))  # a row a file
    own = F.row_number().over(Window.partitionBy(order[0]).orderBy(*order[1:])) - 1
    return places.withColumn("__own", own).join(files, order[0]).select(*order, (F.col("__base") + F.col("__own")).alias("__index"))


def read(spark: SparkSession, source: Source) -> DataFrame:
    return KINDS[source.kind](spark, source)


def read_all(spark: SparkSession, sources: list[Source]) -> DataFrame:
    """All sources, in the order given, as source_index."""
    out = None
    for i, s in enumerate(sources):
        own = read(spark, s).select("id", "text", "source", "domain", "language", "metadata", F.lit(i).alias("source_index"), F.col("file").alias("file"), F.col("line").alias("line"))
        out = own if out is None else out.unionByName(own)
    return out


def _fields(source: Source) -> T.StructType:
    if source.schema:
        return T.StructType.fromDDL(source.schema)
    return T.StructType([T.StructField(x, T.StringType()) for x in dict.fromkeys([source.text_field, source.id_field, *source.metadata_fields])])


def _metadata(source: Source, *more: Column) -> Column:
    return F.to_json(F.struct(*(F.col(f"row.{x}").alias(x) for x in source.metadata_fields), *more))


def jsonl_lines(lines: DataFrame, source: Source) -> DataFrame:
    """Documents of lines(file, line, value); blank lines are skipped, and malformed ones end the run, or with `lenient` are skipped."""
    options = {"mode": "PERMISSIVE" if source.lenient else "FAILFAST", "allowUnescapedControlChars": str(source.lenient).lower()}
    rows = lines.where(F.length(X.strip(F.col("value"))) > 0).withColumn("row", F.from_json("value", _fields(source), options))
    return documents(rows, source, F.col(f"row.{source.text_field}"), F.col(f"row.{source.id_field}"), _metadata(source, F.col("file").alias("path"), F.col("line")), ["file", "line"])


def read_jsonl(spark: SparkSession, source: Source) -> DataFrame:
    """JSONL whatever its compression, told by the first bytes and not the name, up to four layers deep."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source.paths)
    return jsonl_lines(files.select(F.col("path").alias("file"), "content").mapInPandas(_lines, "file string, line bigint, value string"), source)


def read_jsonl_plain(spark: SparkSession, source: Source) -> DataFrame:
    """Uncompressed JSONL, or compressed as its name says: files are split and lines go by their offset."""
    rows = spark.read.text(source.paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    return jsonl_lines(rows.withColumn("line", F.row_number().over(Window.partitionBy("file").orderBy("block", "n")) - 1), source)


def unpacked(content: bytes, layers: int = 4) -> Iterator[bytes]:
    """Lines of a file, through up to four layers of gzip or zstd, told by their first bytes."""
    import zstandard

    stream: io.BufferedIOBase = io.BufferedReader(io.BytesIO(content))
    for _ in range(layers):
        head = stream.peek(4)[:4]
        if head.startswith(GZIP):
            stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
        elif head == ZSTD:
            stream = io.BufferedReader(zstandard.ZstdDecompressor().stream_reader(stream, read_across_frames=True))
        else:
            break
    yield from stream


def _lines(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        for file, content in zip(part["file"], part["content"], strict=True):
            held: list[tuple[str, int, str]] = []
            for i, line in enumerate(unpacked(content)):
                held.append((file, i, line.decode("utf-8", "replace").rstrip("\r\n")))
                if len(held) == 5000:
                    yield pd.DataFrame(held, columns=["file", "line", "value"])
                    held = []
            yield pd.DataFrame(held, columns=["file", "line", "value"])


def _whole(content: bytes, layers: int = 4) -> bytes:
    """The file's plain bytes; an error if a layer ends early."""
    import zstandard

    for _ in range(layers):
        if content.startswith(GZIP):
            content = gzip.decompress(content)
        elif content.startswith(ZSTD):
            parts = []
            while content:
                layer = zstandard.ZstdDecompressor().decompressobj()
                parts.append(layer.decompress(content))
                if not layer.eof:
                    raise EOFError("a zstd frame ends early")
                content = layer.unused_data
            content = b"".join(parts)
        else:
            break
    return content


def verify(files: DataFrame) -> DataFrame:
    """(path, status, message) of files(path, content): ok, or corrupt if a layer can't be read to its end."""

    def test(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for path, content in zip(part["path"], part["content"], strict=True):
                try:
                    _whole(content)
                    out.append((path, "ok", ""))
                except Exception as e:  # whatever a decoder raises is what the row reports
                    out.append((path, "corrupt", f"{type(e).__name__}: {e}"[:200]))
            yield pd.DataFrame(out, columns=["path", "status", "message"])

    return files.select("path", "content").mapInPandas(test, "path string, status string, message string")


def read_parquet(spark: SparkSession, source: Source) -> DataFrame:
    names = list(dict.fromkeys([source.text_field, source.id_field, *source.metadata_fields]))
    rows = spark.read.parquet(*source.paths)
    there = [n for n in names if n in rows.columns]
    rows = rows.select(F.struct(*(rows[n] for n in there), *(F.lit(None).cast("string").alias(n) for n in names if n not in there)).alias("row"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("line"))
    return documents(rows, source, F.col(f"row.{source.text_field}"), F.col(f"row.{source.id_field}"), _metadata(source), ["file", "line"])


def read_csv(spark: SparkSession, source: Source) -> DataFrame:
    rows = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').option("maxCharsPerColumn", "-1").csv(source.paths)
    names = [n for n in dict.fromkeys([source.text_field, source.id_field, *source.metadata_fields]) if n in rows.columns]
    rows = rows.withColumn("file", F.col("_metadata.file_path")).withColumn("line", F.monotonically_increasing_id()).select("file", "line", F.struct(*names).alias("row"))
    id = F.col(f"row.{source.id_field}") if source.id_field in names else F.lit(None)
    return documents(rows, source, F.col(f"row.{source.text_field}"), id, _metadata(source), ["file", "line"])


def _binary(spark: SparkSession, source: Source, pattern: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(source.paths).select(F.col("path").alias("file"), F.lit(0).cast("bigint").alias("line"), "length", "content")
    return files


def stem(source: Source) -> Column:
    """SOURCE/NAME of the file, without its last extension."""
    return F.concat(F.lit(f"{source.name}/"), F.regexp_extract("file", r"([^/]+?)(?:\.[^./]*)?$", 1))


def _about(source: Source, parser: str, *fields: Column) -> Column:
    return F.to_json(F.struct(*fields, F.lit(source.license).alias("license"), F.lit(parser).alias("parser")))


def text_like(content: Column) -> Column:
    """No NUL among the first 4096 bytes."""
    return ~F.contains(F.hex(F.substring(content, 1, 4096)), F.lit("00")) | ~F.hex(F.substring(content, 1, 4096)).rlike("^(?:..)*00")


def read_text(spark: SparkSession, source: Source) -> DataFrame:
    """Whole files as documents; those too large or binary are skipped."""
    files = _binary(spark, source).where((F.col("length") <= source.max_file_bytes) & text_like(F.col("content")))
    return documents(files, source, F.decode("content", "UTF-8"), stem(source), _about(source, "text", F.col("file").alias("path")), ["file", "line"])


def read_code(spark: SparkSession, source: Source) -> DataFrame:
    """Files of a tree by extension, without the folders that hold no source, those too large and binary ones; the id is the path within the tree."""
    root = source.paths[0].rstrip("/")
    files = _binary(spark, source)
    relative = F.regexp_extract("file", f"\\Q{root.split('://')[-1]}\\E/(.*)$", 1)
    files = files.withColumn("relative", relative).withColumn("ext", F.lower(F.regexp_extract("relative", r"[^/](\.[^./]+)$", 1)))
    skipped = F.exists(F.split("relative", "/"), lambda p: p.isin(source.exclude_dirs))
    files = files.where(F.col("ext").isin([x.lower() for x in source.include_extensions]) & ~skipped & (F.col("length") <= source.max_file_bytes) & text_like(F.col("content")))
    return documents(files, source, F.decode("content", "UTF-8"), F.concat(F.lit(f"{source.name}/"), "relative"), _about(source, "git", F.lit(root).alias("repo"), F.col("relative").alias("path"), F.col("ext")), ["file", "line"])


def read_html(spark: SparkSession, source: Source) -> DataFrame:
    files = _binary(spark, source, "*.{html,htm,xhtml}").withColumn("page", html_text(F.decode("content", "UTF-8")))
    return documents(files, source, F.col("page.text"), stem(source), _about(source, "html", F.col("page.title").alias("title"), F.col("file").alias("path")), ["file", "line"])


def read_wiki(spark: SparkSession, source: Source) -> DataFrame:
    """Pages of name space 0 with text, their markup cleaned."""
    schema = "title string, ns string, id string, revision struct<text:string>"
    rows = spark.read.format("xml").option("rowTag", "page").schema(schema).load(",".join(source.paths))
    # a page's number within its dump is its place there: dumps list pages by it, and it is the same in every scan
    rows = rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("id").cast("bigint").alias("line"))
    rows = rows.withColumn("ns", F.coalesce("ns", F.lit("0")))
    rows = rows.where((F.col("ns") == "0") & (F.length(X.strip(F.coalesce("revision.text", F.lit("")))) > 0))
    return documents(rows, source, X.wiki_clean(F.col("revision.text")), F.concat(F.lit(f"{source.name}/"), F.col("id")), _about(source, "wiki_xml", F.col("title"), F.col("file").alias("path")), ["file", "line"])


def read_pdf(spark: SparkSession, source: Source) -> DataFrame:
    """Pages' text, joined by line feeds; needs the library pypdf on the executors."""

    @F.pandas_udf("string")
    def pages(contents: pd.Series) -> pd.Series:
        import pypdf

        return contents.map(lambda x: "\n".join(p.extract_text() or "" for p in pypdf.PdfReader(io.BytesIO(x)).pages))

    files = _binary(spark, source, "*.pdf")
    return documents(files, source, pages("content"), stem(source), _about(source, "pdf", F.col("file").alias("path")), ["file", "line"])


def resolve_urls(explicit: list[str], lists: list[str], listing: list[str], globs: list[str]) -> list[str]:
    """Sorted URLs: those given, those of list files' lines (# begins a comment), and those of a listing that match a glob.  An error if there are none."""
    import fnmatch

    found = set(explicit) | {x.strip() for text in lists for x in text.splitlines() if x.strip() and not x.strip().startswith("#")}
    found |= {x for x in listing if any(fnmatch.fnmatch(x, g) for g in globs)}
    if not found:
        raise ValueError("no URL is given, listed or matched")
    return sorted(found)


def fetch(urls: DataFrame, get: Callable[[str], bytes], retries: int = 3) -> DataFrame:
    """(url, content, error) of urls(url): `get` is called in the tasks, and again with growing pauses when it fails."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        for part in parts:
            for url in part["url"]:
                content, error = None, None
                for attempt in range(retries):
                    try:
                        content, error = get(url), None
                        break
                    except Exception as e:
                        error = str(e)[:200]
                        time.sleep(min(10.0, 0.1 * 2**attempt))
                yield pd.DataFrame({"url": [url], "content": [content], "error": [error]})

    return urls.select("url").mapInPandas(run, "url string, content binary, error string")


KINDS: dict[str, Callable[[SparkSession, Source], DataFrame]] = {
    "jsonl": read_jsonl, "jsonl_plain": read_jsonl_plain, "parquet": read_parquet, "csv": read_csv, "text": read_text, "code": read_code, "html": read_html, "wiki": read_wiki, "pdf": read_pdf,
}


def shard_records(spark: SparkSession, uri: str, start: int = 0, end: int | None = None, schema: str = "id string, text string, source string, domain string, language string, metadata string") -> DataFrame:
    """Records [start, end) of one shard, in order, by their place in the file."""
    if uri.endswith(".parquet"):
        rows = spark.read.parquet(uri).withColumn("line", F.col("_metadata.row_index"))
    else:
        lines = spark.read.text(uri).withColumn("line", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.monotonically_increasing_id())) - 1)
        rows = lines.select(F.from_json("value", schema).alias("r"), "line").select("r.*", "line")
    return rows.where((F.col("line") >= start) & (F.lit(end is None) | (F.col("line") < (end or 0)))).orderBy("line")
