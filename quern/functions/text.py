"""Text functions as columns: whitespace, cleaning, ratios, scores, markup.

The character classes are spelled out, because Java's and other engines' short
forms differ beyond ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Character classes, as regular expressions.
WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\p{Z}]"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
BREAK = r"(?:\r\n|[\n\r\x{85}\x{2028}\x{2029}])"
LETTER = r"[\p{L}\x{4e00}-\x{9fff}]"
WORD = r"[\p{L}\p{N}_\x{4e00}-\x{9fff}]+"
URL = r"(?i)https?://|www\."
PUNCTUATION = r"[,.!?;:，。！？；：]"
CJK = r"[\x{4e00}-\x{9fff}]"


def strip(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, rf"\A{WS}+|{WS}+\z", "")


def control_ratio(text: Column) -> Column:
    return F.when(F.length(text) == 0, 0.0).otherwise(matched(text, f"{CONTROL}+") / F.length(text))


def matched(text: Column, runs: str) -> Column:
    """How many characters the runs of a pattern cover."""
    return F.length(text) - F.length(F.regexp_replace(text, runs, ""))


def clean(text: Column) -> Column:
    """Control characters become spaces, spaces collapse, lines are stripped and blank ones go."""
    spaced = F.regexp_replace(F.regexp_replace(text, CONTROL, " "), r"[ \t]+", " ")
    return strip(F.regexp_replace(spaced, f"{WS}*{BREAK}{WS}*", "\n"))


def truncate(text: Column, n: int) -> Column:
    return F.when(F.length(text) > n, F.regexp_replace(F.substring(text, 1, n), rf"{WS}+\z", "")).otherwise(text)


def visible(text: Column) -> Column:
    """Characters that aren't white space."""
    return F.length(F.regexp_replace(text, f"{WS}+", ""))


def letters(text: Column) -> Column:
    return matched(text, f"{LETTER}+")


def alpha_ratio(text: Column) -> Column:
    return F.when(visible(text) == 0, 0.0).otherwise(letters(text) / visible(text))


def lines(text: Column) -> Column:
    """Lines of cleaned text."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n"))


def repeated_line_ratio(text: Column) -> Column:
    n = F.size(lines(text))
    return F.when(n == 0, 0.0).otherwise((n - F.size(F.array_distinct(lines(text)))) / n)


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def dedup_text(text: Column) -> Column:
    return F.lower(strip(F.regexp_replace(text, f"{WS}+", " ")))


def training_text(text: Column) -> Column:
    return strip(F.regexp_replace(text, f"{WS}+", " "))


def exact_hash(text: Column) -> Column:
    return F.sha2(dedup_text(text), 256)


def token_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.octet_length(text) / 4)).cast("bigint")


def cjk_ratio(text: Column) -> Column:
    return F.when(F.length(text) == 0, 0.0).otherwise(matched(text, f"{CJK}+") / F.length(text))


def quality_signals(text: Column, domain: Column, repeated: Column) -> Column:
    """Struct of the five parts, each from 0 to 1, of the heuristic score of cleaned text."""
    n = F.size(lines(text))
    chars = F.greatest(F.lit(1), F.length(text))
    code = F.coalesce(domain == "code", F.lit(False))
    line = F.least(F.lit(1.0), ((F.length(text) - F.greatest(n - 1, F.lit(0))) / F.greatest(F.lit(1), n)) / 80.0)
    symbol = 1.0 - F.least(F.lit(1.0), F.greatest(F.lit(0.0), (visible(text) - letters(text)) / chars - 0.35) / 0.65)
    return F.struct(
        F.least(F.lit(1.0), F.log(chars + 1) / F.log(F.lit(2000.0))).alias("length"),
        F.when(code, 1.0).otherwise(line).alias("avg_line"),
        F.when(code, F.greatest(symbol, F.lit(0.6))).otherwise(symbol).alias("symbol"),
        (1.0 - F.least(F.lit(1.0), repeated)).alias("repetition"),
        (1.0 - F.least(F.lit(1.0), count_matches(text, URL) / 10.0)).alias("url"),
    )


def quality_score(signals: Column) -> Column:
    """Fixed weights of the parts."""
    total = 0.30 * signals["length"] + 0.20 * signals["avg_line"] + 0.20 * signals["symbol"] + 0.20 * signals["repetition"] + 0.10 * signals["url"]
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), total))


def wiki_clean(text: Column) -> Column:
    """Wiki markup removed, by ordered patterns."""
    for pattern, by in WIKI:
        text = F.regexp_replace(text, pattern, by)
    return text


#: Patterns of wiki markup, and what stands for them.
WIKI = [
    (r"(?s)<!--.*?-->", " "), (r"(?is)<ref[^>]*>.*?</ref>", " "), (r"<[^>]+>", " "), (r"\{\{[^{}]*\}\}", " "),
    (r"(?i)\[\[File:[^\]]+\]\]", " "), (r"\[\[(?:[^|\]]*\|)?([^\]]+)\]\]", "$1"), (r"\[https?://[^\s\]]+\s*([^\]]*)\]", "$1"), (r"'{2,}", ""),
]


def safe_name(text: Column, dots: bool = False) -> Column:
    """What isn't a letter, a digit, _ or - (or, with dots, a full stop) becomes _."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}_.-]" if dots else r"[^\p{L}\p{N}_-]", "_")


def human_bytes(n: Column) -> Column:
    out, units = None, ["B", "KiB", "MiB", "GiB", "TiB"]
    for i in reversed(range(len(units))):
        one = F.concat(F.format_string("%.1f", n / float(1 << (10 * i))), F.lit(units[i]))
        out = one if out is None else F.when(n < float(1 << (10 * (i + 1))), one).otherwise(out)
    return out


def format_of(path: Column) -> Column:
    """Format by extension, whatever compression follows it."""
    found = F.lower(F.regexp_extract(path, r"(?i)\.(jsonl|ndjson|json|parquet|csv|txt|xml|html?)(?:\.(?:gz|zst))?$", 1))
    return F.when(found.isin("jsonl", "ndjson", "json"), "jsonl").when(found == "", None).otherwise(found)


def join_paragraphs(paragraphs: Column, drop_repeated: bool) -> Column:
    """Text of a JSON list of paragraphs; text that isn't such a list stays as it is."""
    kind = "array<struct<`内容`:string,`是否重复`:boolean,`是否跨文件重复`:boolean>>"
    parsed = F.from_json(paragraphs, kind)
    if drop_repeated:
        parsed = F.filter(parsed, lambda p: ~(F.coalesce(p["是否重复"], F.lit(False)) | F.coalesce(p["是否跨文件重复"], F.lit(False))))
    texts = F.filter(F.transform(parsed, lambda p: strip(p["内容"])), lambda x: x.isNotNull() & (x != ""))
    return F.when(F.ltrim(paragraphs).startswith("["), F.coalesce(F.array_join(texts, "\n"), paragraphs)).otherwise(paragraphs)


#: Latin letters whose case folding is several letters.
FOLDS = {"ß": "ss", "ŉ": "ʼn", "ǰ": "ǰ", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}


def folded(text: Column) -> Column:
    """Without regard to case: small letters, one small sigma and one long s, and several letters for the Latin ones that fold to several."""
    out = F.translate(F.lower(F.upper(text)), "ςſ", "σs")
    for one, several in FOLDS.items():
        out = F.replace(out, F.lit(one), F.lit(several))
    return out


def cloze(masked: Column, word: Column) -> Column:
    """(context, target, error): the text before the first mask, and the word; error says what a row lacks."""
    lacks = F.when(masked.isNull(), "missing masked_text").when(word.isNull(), "missing correct_word").when(~F.contains(masked, F.lit("<mask>")), "no <mask>").when(word == "", "empty correct_word")
    return F.struct(F.when(lacks.isNull(), F.substring_index(masked, "<mask>", 1)).alias("context"), F.when(lacks.isNull(), word).alias("target"), lacks.alias("error"))
