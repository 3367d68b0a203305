"""Documents to cleaned documents, with one reject reason each and metrics."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.sources.tables import kept_table


@dataclass(frozen=True)
class Cleaning:
    min_chars: int = 50
    max_chars: int = 200_000
    min_alpha_ratio: float = 0.15
    max_repeated_lines: float = 0.35
    max_control_ratio: float = 0.02
    min_quality: float = 0.45
    #: Column name to denied values; compared stripped and without regard to case.
    excluded: dict[str, list[str]] = field(default_factory=dict)


#: Thresholds under which every branch has rows on the test tables.
STRICT = Cleaning(min_alpha_ratio=0.75, max_repeated_lines=0.10, min_quality=0.95)


def excluded_reason(rules: Cleaning) -> Column:
    """excluded_metadata_FIELD for the first field whose value is denied."""
    out = F.lit(None).cast("string")
    for name, values in reversed(rules.excluded.items()):
        denied = T.folded(T.strip(F.col(name).cast("string"))).isin([v.strip().casefold() for v in values])
        out = F.when(denied, f"excluded_metadata_{name}").otherwise(out)
    return out


def cleaned(docs: DataFrame, rules: Cleaning, text: str = "text", normalise=None) -> DataFrame:
    """docs with clean, control_char_ratio, alpha_or_cjk_ratio, repeated_line_ratio, and reason (null: passes)."""
    raw = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("raw", normalise(raw) if normalise else raw)
    out = out.withColumn("control_char_ratio", T.control_ratio(F.col("raw"))).withColumn("whole", T.clean(F.col("raw"))).withColumn("clean", T.truncate(F.col("whole"), rules.max_chars))
    out = out.withColumn("alpha_or_cjk_ratio", T.alpha_ratio(F.col("clean"))).withColumn("repeated_line_ratio", T.repeated_line_ratio(F.col("clean")))
    reason = F.coalesce(
        excluded_reason(rules),
        F.when(F.col("control_char_ratio") > rules.max_control_ratio, "control_char_ratio"),
        F.when(F.length("whole") < rules.min_chars, "too_short"),
        F.when(F.col("alpha_or_cjk_ratio") < rules.min_alpha_ratio, "low_text_ratio"),
        F.when(F.col("repeated_line_ratio") > rules.max_repeated_lines, "repeated_lines"),
    )
    return out.withColumn("reason", reason).drop("raw", "whole")


def scored(docs: DataFrame, domain: str | None = None) -> DataFrame:
    """docs with signals and quality_score of the column clean."""
    kind = F.col(domain) if domain else F.lit(None).cast("string")
    return docs.withColumn("signals", T.quality_signals(F.col("clean"), kind, F.col("repeated_line_ratio"))).withColumn("quality_score", T.quality_score(F.col("signals")))


def with_reasons(docs: DataFrame, rules: Cleaning, id: str = "doc_id", text: str = "text", domain: str | None = None, quality_first: bool = False, columns: list[str] | None = None) -> DataFrame:
    """docs with one reason each: cleaning, then exact copies and quality in the mode's order.

    Copies are those of a document that passed all that comes before: with
    quality_first, a poor first copy doesn't stand for the later ones.  columns:
    those that are needed beside id, hash, reason and quality_score (all, if left
    out).
    """
    out = scored(cleaned(docs, rules, text), domain).withColumn("hash", T.exact_hash(F.col("clean")))
    poor = F.when(F.col("quality_score") < rules.min_quality, "low_quality")
    if quality_first:
        out = out.withColumn("reason", F.coalesce("reason", poor))
    # kept, as the texts are cleaned once for the search of copies and for the rows; which needs ids and hashes alone
    out = kept_table(out if columns is None else out.select(id, *columns, "hash", "reason", "quality_score"))
    first = out.where("reason is null").groupBy(F.col("hash").alias("__hash")).agg(F.min(id).alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")
    passed = F.col("reason").isNull()
    joined = out.join(first, F.col("hash") == F.col("__hash"), "left").withColumn("reason", F.when(passed & (F.col(id) != F.col("__first")), "exact_duplicate").otherwise(F.col("reason"))).drop("__hash", "__first")
    return joined if quality_first else joined.withColumn("reason", F.coalesce("reason", poor))


def rule_score(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, entropy, score): the score by rules on character entropy, punctuation, digits, white space and repeated trigrams.

    Entropy comes from counts per document and character, combined before the
    shuffle.  An empty text scores 0.
    """
    own = docs.select(id, F.coalesce(F.col(text), F.lit("")).alias("t"))
    counts = own.select(id, F.length("t").alias("n"), F.explode(F.split("t", "")).alias("c")).where("c <> ''").groupBy(id, "n", "c").agg(F.count(F.lit(1)).alias("k"))
    p = F.col("k") / F.col("n")
    entropy = counts.groupBy(id).agg((-F.sum(p * F.log2(p + 1e-10))).alias("entropy"), F.count(F.lit(1)).alias("kinds"))
    t, n = F.col("t"), F.length("t")
    words = F.filter(F.split(T.strip(t), f"{T.WS}+"), lambda w: w != "")
    trigrams = F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.array_join(F.slice("words", i + 1, 3), " "))
    own = own.withColumn("words", words)
    parts = own.select(
        id, n.alias("n"), (T.matched(t, f"{T.PUNCTUATION}+") / n).alias("punct"), (T.matched(t, r"\p{Nd}+") / n).alias("digit"), (T.matched(t, f"{T.WS}+") / n).alias("space"),
        F.when(F.size("words") > 10, 1 - F.size(F.array_distinct(trigrams)) / (F.size("words") - 2)).otherwise(0.0).alias("dup"),
    ).join(entropy, id, "left")
    when = lambda *cases: F.coalesce(*(F.when(c, F.lit(v)) for c, v in cases), F.lit(1.0))
    e = F.col("entropy")
    score = when(((F.col("kinds") > 1) & (e < 3), 0.2), ((F.col("kinds") > 1) & (e < 4), 0.6)) * when((F.col("punct") > 0.2, 0.4), (F.col("punct") < 0.01, 0.7)) * when((F.col("digit") > 0.3, 0.3))
    score = score * when(((F.col("space") > 0.4) | (F.col("space") < 0.05), 0.5)) * when((F.col("dup") > 0.5, 0.2), (F.col("dup") > 0.3, 0.5))
    return parts.select(id, F.when(F.col("n") == 0, 0.0).otherwise(e).alias("entropy"), F.when(F.col("n") == 0, 0.0).otherwise(score).alias("score"), F.col("n").cast("bigint").alias("n_chars"))


def decision(scores: DataFrame, min_chars: int = 50, max_chars: int = 100_000, min_score: float = 0.3) -> Column:
    """Reason of the stand-alone filter: too_short, too_long, low_quality_x.xx or ok."""
    return F.when(F.col("n_chars") < min_chars, "too_short").when(F.col("n_chars") > max_chars, "too_long").when(F.col("score") < min_score, F.concat(F.lit("low_quality_"), F.format_string("%.2f", "score"))).otherwise("ok")


def training_filter(docs: DataFrame, text: str, score: Column | None = None, min_chars: int = 1, max_chars: int | None = None, min_score: float | None = None) -> DataFrame:
    """docs whose collapsed text is within the lengths and whose score, if a threshold is set, is there and reaches it."""
    out = docs.withColumn(text, T.training_text(F.col(text)))
    out = out.where(F.length(text) >= min_chars)
    if max_chars is not None:
        out = out.where(F.length(text) <= max_chars)
    return out if min_score is None else out.where(score >= min_score)
