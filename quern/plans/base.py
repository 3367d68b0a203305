"""How queries are registered, and the pieces of SQL that several share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.functions import text as T
from quern.sources.tables import kept_table, scratch, spread  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of (spark, folder), with the same in DuckDB SQL where there is such."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table; texts, which take long a row, go to as many tasks as there are."""
    read = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(read) if name in ("documents", "pages") else read


keep = kept_table


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A{T.WS}+|{T.WS}+\z', '', 'g')"


def sql_covered(x: str, runs: str) -> str:
    return f"(length({x}) - length(regexp_replace({x}, '{runs}', '', 'g')))"


def sql_clean(x: str) -> str:
    spaced = f"regexp_replace(regexp_replace({x}, '{T.CONTROL}', ' ', 'g'), '[ \\t]+', ' ', 'g')"
    return sql_strip(f"regexp_replace({spaced}, '{T.WS}*{T.BREAK}{T.WS}*', chr(10), 'g')")


SQL_DEDUP = lambda x: f"lower({sql_strip(f'''regexp_replace({x}, '{T.WS}+', ' ', 'g')''')})"

#: Cleaned documents with their metrics, as CTEs that end in m.
SQL_CLEANED = f"""
c0 AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {sql_clean("coalesce(text, '')")} AS whole FROM documents),
c1 AS (SELECT *, CASE WHEN length(whole) > 200000 THEN regexp_replace(substr(whole, 1, 200000), '{T.WS}+\\z', '') ELSE whole END AS clean FROM c0),
c2 AS (SELECT *, CASE WHEN clean = '' THEN [] ELSE string_split(clean, chr(10)) END AS lines,
  CASE WHEN length(t) = 0 THEN 0.0 ELSE {sql_covered('t', T.CONTROL + '+')} / length(t) END AS ctl,
  length(regexp_replace(clean, '{T.WS}+', '', 'g')) AS vis, {sql_covered('clean', T.LETTER + '+')} AS let FROM c1),
c3 AS (SELECT *, CASE WHEN vis = 0 THEN 0.0 ELSE let / vis END AS alpha,
  CASE WHEN len(lines) = 0 THEN 0.0 ELSE (len(lines) - len(list_distinct(lines))) / len(lines) END AS rep,
  least(1.0, ln(greatest(1, length(clean)) + 1) / ln(2000.0)) AS s_length,
  least(1.0, ((length(clean) - greatest(len(lines) - 1, 0)) / greatest(1, len(lines))) / 80.0) AS s_line,
  1.0 - least(1.0, greatest(0.0, (vis - let) / greatest(1, length(clean)) - 0.35) / 0.65) AS s_symbol,
  1.0 - least(1.0, len(regexp_extract_all(clean, '{T.URL}')) / 10.0) AS s_url FROM c2),
m AS (SELECT *, greatest(0.0, least(1.0, 0.30 * s_length + 0.20 * s_line + 0.20 * s_symbol + 0.20 * (1.0 - least(1.0, rep)) + 0.10 * s_url)) AS score,
  sha256({SQL_DEDUP('clean')}) AS hash FROM c3)
"""


def sql_reasons(alpha: float = 0.15, rep: float = 0.35, quality: float = 0.45, quality_first: bool = False) -> str:
    """CTEs that end in r: each document's reason."""
    poor = f"CASE WHEN score < {quality} THEN 'low_quality' END"
    first = f"coalesce(reason0, {poor})" if quality_first else "reason0"
    last = "reason1" if quality_first else f"coalesce(reason1, {poor})"
    return f"""{SQL_CLEANED},
r0 AS (SELECT *, CASE WHEN ctl > 0.02 THEN 'control_char_ratio' WHEN length(whole) < 50 THEN 'too_short' WHEN alpha < {alpha} THEN 'low_text_ratio' WHEN rep > {rep} THEN 'repeated_lines' END AS reason0 FROM m),
r1 AS (SELECT *, {first} AS passed FROM r0),
r2 AS (SELECT *, CASE WHEN passed IS NULL AND doc_id <> min(CASE WHEN passed IS NULL THEN doc_id END) OVER (PARTITION BY hash) THEN 'exact_duplicate' ELSE passed END AS reason1 FROM r1),
r AS (SELECT *, {last} AS reason FROM r2)"""
