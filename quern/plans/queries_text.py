"""Cleaning, filters, scores and text functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import text as T
from quern.functions.arrow import html_text, nfkc
from quern.operators import cleaning as C
from quern.operators import metrics as M
from quern.plans.base import SQL_CLEANED, SQL_DEDUP, query, sql_clean, sql_covered, sql_reasons, sql_strip, table


def _counts(rules, quality_first=False):
    return lambda spark, at: C.with_reasons(table(spark, at, "documents"), rules, quality_first=quality_first, columns=[F.length("clean").alias("len")]).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.sum("len").cast("bigint").alias("chars"))


def _counts_sql(**x):
    return f"WITH {sql_reasons(**x)} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n, CAST(sum(length(clean)) AS BIGINT) AS chars FROM r GROUP BY ALL"


query("clean_reject_counts", _counts_sql())(_counts(C.Cleaning()))
query("clean_reject_counts_strict", _counts_sql(alpha=0.75, rep=0.10, quality=0.95))(_counts(C.STRICT))
query("clean_reject_counts_quality_first", _counts_sql(alpha=0.75, rep=0.10, quality=0.95, quality_first=True))(_counts(C.STRICT, True))


@query("clean_reasons", f"WITH {sql_reasons(alpha=0.75, rep=0.10, quality=0.95)} SELECT doc_id, coalesce(reason, '') AS reason FROM r")
def clean_reasons(spark, at):
    return C.with_reasons(table(spark, at, "documents"), C.STRICT, columns=[]).select("doc_id", F.coalesce("reason", F.lit("")).alias("reason"))


@query("reject_counters", f"WITH {sql_reasons(alpha=0.75, rep=0.10, quality=0.95)} SELECT coalesce(source, 'TOTAL') AS source, count(*) AS seen, count(*) FILTER (reason IS NULL) AS written, count(reason) AS rejected FROM r GROUP BY ROLLUP (source)")
def reject_counters(spark, at):
    return M.counters(C.with_reasons(table(spark, at, "documents"), C.STRICT, columns=["source"]), "source", "reason")


@query("clean_metrics", f"WITH {SQL_CLEANED} SELECT doc_id, CAST(length(clean) AS BIGINT) AS chars, round(alpha, 6) AS alpha_or_cjk_ratio, round(rep, 6) AS repeated_line_ratio, round(ctl, 6) AS control_char_ratio FROM m")
def clean_metrics(spark, at):
    d = C.cleaned(table(spark, at, "documents"), C.Cleaning())
    return d.select("doc_id", F.length("clean").cast("bigint").alias("chars"), *(F.round(c, 6).alias(c) for c in ("alpha_or_cjk_ratio", "repeated_line_ratio", "control_char_ratio")))


@query("cleaned_text", f"SELECT doc_id, sha256({sql_clean("coalesce(text, '')")}) AS clean_sha256 FROM documents")
def cleaned_text(spark, at):
    return table(spark, at, "documents").select("doc_id", F.sha2(T.clean(F.coalesce("text", F.lit(""))), 256).alias("clean_sha256"))


@query("cleaned_text_nfkc", f"SELECT doc_id, sha256({sql_clean("coalesce(text, '')")}) AS clean_sha256 FROM documents")
def cleaned_text_nfkc(spark, at):
    return table(spark, at, "documents").select("doc_id", F.sha2(T.clean(nfkc(F.coalesce("text", F.lit("")))), 256).alias("clean_sha256"))


@query("cleaned_text_stats", f"WITH {SQL_CLEANED} SELECT lang, count(*) AS n, CAST(sum(length(clean)) AS BIGINT) AS chars, CAST(sum(len(lines)) AS BIGINT) AS lines FROM m GROUP BY ALL")
def cleaned_text_stats(spark, at):
    d = table(spark, at, "documents").withColumn("clean", T.clean(F.coalesce("text", F.lit(""))))
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("clean")).cast("bigint").alias("chars"), F.sum(F.size(T.lines(F.col("clean")))).cast("bigint").alias("lines"))


@query("truncated_text", f"WITH {SQL_CLEANED} SELECT doc_id, sha256(CASE WHEN length(whole) > 500 THEN regexp_replace(substr(whole, 1, 500), '{T.WS}+\\z', '') ELSE whole END) AS head FROM m")
def truncated_text(spark, at):
    return table(spark, at, "documents").select("doc_id", F.sha2(T.truncate(T.clean(F.coalesce("text", F.lit(""))), 500), 256).alias("head"))


@query("exclude_by_metadata", f"SELECT CASE WHEN lower({sql_strip('source')}) IN ('src0', 'src7') THEN 'excluded_metadata_source' WHEN lower({sql_strip('lang')}) IN ('de') THEN 'excluded_metadata_lang' ELSE 'kept' END AS reason, count(*) AS n FROM documents GROUP BY ALL")
def exclude_by_metadata(spark, at):
    rules = C.Cleaning(excluded={"source": [" SRC0", "src7 "], "lang": ["De"]})
    return table(spark, at, "documents").groupBy(F.coalesce(C.excluded_reason(rules), F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("heuristic_quality", f"WITH {SQL_CLEANED} SELECT doc_id, round(score, 6) AS score, round(s_length, 6) AS s_length, round(s_line, 6) AS s_line, round(s_symbol, 6) AS s_symbol, round(s_url, 6) AS s_url FROM m")
def heuristic_quality(spark, at):
    d = C.scored(C.cleaned(table(spark, at, "documents"), C.Cleaning()))
    part = lambda a, b: F.round(F.col("signals")[a], 6).alias(b)
    return d.select("doc_id", F.round("quality_score", 6).alias("score"), part("length", "s_length"), part("avg_line", "s_line"), part("symbol", "s_symbol"), part("url", "s_url"))


_RULES = f"""
own AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
k AS (SELECT doc_id, n, c, count(*) AS k FROM (SELECT doc_id, n, unnest(string_split(t, '')) AS c FROM own) WHERE c <> '' GROUP BY ALL),
e AS (SELECT doc_id, -sum(k / n * log2(k / n + 1e-10)) AS entropy, count(*) AS kinds FROM k GROUP BY ALL),
w AS (SELECT doc_id, list_filter(regexp_split_to_array({sql_strip('t')}, '{T.WS}+'), lambda x: x <> '') AS words FROM own),
p AS (SELECT own.doc_id, n, entropy, kinds, {sql_covered('t', T.PUNCTUATION + '+')} / n AS punct, {sql_covered('t', r'\p{Nd}+')} / n AS digit, {sql_covered('t', T.WS + '+')} / n AS space,
  CASE WHEN len(words) > 10 THEN 1 - len(list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))) / (len(words) - 2) ELSE 0.0 END AS dup
  FROM own JOIN w USING (doc_id) LEFT JOIN e USING (doc_id)),
s AS (SELECT doc_id, n, CASE WHEN n = 0 THEN 0.0 ELSE entropy END AS entropy, CASE WHEN n = 0 THEN 0.0 ELSE
  (CASE WHEN kinds > 1 AND entropy < 3 THEN 0.2::DOUBLE WHEN kinds > 1 AND entropy < 4 THEN 0.6 ELSE 1.0 END) * (CASE WHEN punct > 0.2 THEN 0.4::DOUBLE WHEN punct < 0.01 THEN 0.7 ELSE 1.0 END)
  * (CASE WHEN digit > 0.3 THEN 0.3::DOUBLE ELSE 1.0 END) * (CASE WHEN space > 0.4 OR space < 0.05 THEN 0.5::DOUBLE ELSE 1.0 END) * (CASE WHEN dup > 0.5 THEN 0.2::DOUBLE WHEN dup > 0.3 THEN 0.5 ELSE 1.0 END) END AS score FROM p)
"""


@query("rule_quality", f"WITH {_RULES} SELECT doc_id, round(entropy, 6) AS entropy, round(score, 6) AS score FROM s")
def rule_quality(spark, at):
    return C.rule_score(table(spark, at, "documents")).select("doc_id", F.round("entropy", 6).alias("entropy"), F.round("score", 6).alias("score"))


@query("rule_filter_reasons", f"WITH {_RULES} SELECT CASE WHEN n < 50 THEN 'too_short' WHEN n > 20000 THEN 'too_long' WHEN score < 0.75 THEN 'low_quality_' || printf('%.2f', score) ELSE 'ok' END AS reason, count(*) AS n FROM s GROUP BY ALL")
def rule_filter_reasons(spark, at):
    s = C.rule_score(table(spark, at, "documents"))
    return s.groupBy(C.decision(s, max_chars=20_000, min_score=0.75).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("training_filter", f"WITH x AS (SELECT doc_id, quality, {sql_strip(f'''regexp_replace(text, '{T.WS}+', ' ', 'g')''')} AS t FROM documents LEFT JOIN labels USING (doc_id)) SELECT doc_id, CAST(length(t) AS BIGINT) AS n FROM x WHERE length(t) BETWEEN 200 AND 8000 AND quality >= 1")
def training_filter(spark, at):
    d = table(spark, at, "documents").join(table(spark, at, "labels").select("doc_id", "quality"), "doc_id", "left")
    return C.training_filter(d, "text", F.col("quality"), 200, 8000, 1).select("doc_id", F.length("text").cast("bigint").alias("n"))


@query("dedup_text_hash", f"SELECT doc_id, sha256({SQL_DEDUP('text')}) AS hash FROM documents")
def dedup_text_hash(spark, at):
    return table(spark, at, "documents").select("doc_id", T.exact_hash(F.col("text")).alias("hash"))


@query("cjk_ratio", f"SELECT doc_id, round(CASE WHEN length(text) = 0 THEN 0.0 ELSE {sql_covered('text', T.CJK + '+')} / length(text) END, 6) AS ratio FROM documents")
def cjk_ratio(spark, at):
    return table(spark, at, "documents").select("doc_id", F.round(T.cjk_ratio(F.col("text")), 6).alias("ratio"))


@query("wiki_markup_clean", rf"""SELECT page_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '(?s)<!--.*?-->', ' ', 'g'), '(?is)<ref[^>]*>.*?</ref>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\{{\{{[^{{}}]*\}}\}}', ' ', 'g'), '(?i)\[\[File:[^\]]+\]\]', ' ', 'g'),
  '\[\[(?:[^|\]]*\|)?([^\]]+)\]\]', '\1', 'g'), '\[https?://[^\s\]]+\s*([^\]]*)\]', '\1', 'g'), '''{{2,}}', '', 'g')) AS clean FROM pages""")
def wiki_markup_clean(spark, at):
    return table(spark, at, "pages").select("page_id", F.sha2(T.wiki_clean(F.col("html")), 256).alias("clean"))


@query("html_extract")
def html_extract(spark, at):
    return table(spark, at, "pages").withColumn("page", html_text("html")).select("page_id", "page.title", F.sha2("page.text", 256).alias("text_sha256"), F.length("page.text").cast("bigint").alias("chars"))


@query("html_titles", r"SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title FROM pages")
def html_titles(spark, at):
    return table(spark, at, "pages").select("page_id", F.trim(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"))


@query("url_paths", r"SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path, regexp_replace(regexp_replace(url, '^https?://', ''), '[^\p{L}\p{N}_.-]', '_', 'g') AS name FROM pages")
def url_paths(spark, at):
    url = F.col("url")
    return table(spark, at, "pages").select("page_id", F.regexp_extract(url, r"^https?://([^/?#]+)", 1).alias("host"), F.regexp_extract(url, r"^https?://[^/?#]+([^?#]*)", 1).alias("path"), T.safe_name(F.regexp_replace(url, "^https?://", ""), dots=True).alias("name"))


@query("single_line_text", "SELECT doc_id, sha256(replace(text, chr(10), ' ')) AS line FROM documents")
def single_line_text(spark, at):
    return table(spark, at, "documents").select("doc_id", F.sha2(F.replace("text", F.lit("\n"), F.lit(" ")), 256).alias("line"))


@query("event_props", "SELECT event_type, count(*) AS n, count(DISTINCT json_extract_string(props, '$.k')) AS kinds, count(json_extract_string(props, '$.k')) AS present FROM events GROUP BY ALL")
def event_props(spark, at):
    e = table(spark, at, "events").withColumn("k", F.get_json_object("props", "$.k"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("k").alias("kinds"), F.count("k").alias("present"))


@query("cloze_split", "SELECT doc_id, sha256(split_part(x, '<mask>', 1)) AS context, CAST(length(x) - length(replace(x, '<mask>', '')) AS BIGINT) // 6 AS masks FROM (SELECT doc_id, replace(text, '. ', '<mask>') AS x FROM documents)")
def cloze_split(spark, at):
    d = table(spark, at, "documents").select("doc_id", F.replace("text", F.lit(". "), F.lit("<mask>")).alias("x"))
    return d.select("doc_id", F.sha2(F.substring_index("x", "<mask>", 1), 256).alias("context"), F.floor((F.length("x") - F.length(F.replace("x", F.lit("<mask>"), F.lit("")))) / 6).cast("bigint").alias("masks"))


@query("field_coalesce", f"SELECT page_id, coalesce(nullif({sql_strip("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")}, ''), nullif({sql_strip("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")}, ''), 'page/' || page_id) AS name FROM pages")
def field_coalesce(spark, at):
    part = lambda tag: F.nullif(T.strip(F.regexp_extract("html", rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1)), F.lit(""))
    return table(spark, at, "pages").select("page_id", F.coalesce(part("h1"), part("title"), F.concat(F.lit("page/"), F.col("page_id"))).alias("name"))


@query("paragraph_join", r"""WITH p AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS ps FROM documents)
SELECT doc_id, sha256(array_to_string(list_transform(list_filter(list_transform(range(1, len(ps) + 1), lambda i: {'i': i, 'x': ps[i]}), lambda s: NOT list_contains(ps[1:s.i - 1], s.x)), lambda s: s.x), chr(10))) AS joined FROM p""")
def paragraph_join(spark, at):
    docs = table(spark, at, "documents").select("doc_id", F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "").alias("kept"))
    kept = F.col("kept")
    rows = F.transform(kept, lambda x, i: F.struct(x.alias("内容"), (F.array_position(kept, x) <= i).alias("是否重复"), F.lit(False).alias("是否跨文件重复")))
    # a JSON list of paragraphs, as in the raw files, then read back; the first of equal paragraphs stays
    parsed = F.from_json(F.to_json(rows), "array<struct<`内容`:string,`是否重复`:boolean,`是否跨文件重复`:boolean>>")
    texts = F.transform(F.filter(parsed, lambda p: ~(p["是否重复"] | p["是否跨文件重复"])), lambda p: p["内容"])
    return docs.select("doc_id", F.sha2(F.array_join(texts, "\n"), 256).alias("joined"))



@query("cloze_rows", """WITH r AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN text ELSE replace(text, '. ', '<mask>') END AS m, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN '' ELSE source END AS w FROM documents),
e AS (SELECT *, CASE WHEN m IS NULL THEN 'missing masked_text' WHEN w IS NULL THEN 'missing correct_word' WHEN NOT contains(m, '<mask>') THEN 'no <mask>' WHEN w = '' THEN 'empty correct_word' END AS error FROM r)
SELECT doc_id, CASE WHEN error IS NULL THEN sha256(split_part(m, '<mask>', 1)) END AS context, CASE WHEN error IS NULL THEN w END AS target, error FROM e""")
def cloze_rows(spark, at):
    k = F.col("doc_id")
    masked = F.when(k % 5 == 0, None).when(k % 5 == 1, F.col("text")).otherwise(F.replace("text", F.lit(". "), F.lit("<mask>")))
    word = F.when(k % 7 == 0, None).when(k % 7 == 1, "").otherwise(F.col("source"))
    return table(spark, at, "documents").select("doc_id", T.cloze(masked, word).alias("c")).select("doc_id", F.sha2("c.context", 256).alias("context"), "c.target", "c.error")


@query("url_decoded", r"SELECT page_id, url_decode(regexp_replace(url, '^https?://[^/?#]+', '') || '%C3%A9%20' || page_id) AS path FROM pages")
def url_decoded(spark, at):
    path = F.concat(F.regexp_replace("url", r"^https?://[^/?#]+", ""), F.lit("%C3%A9%20"), F.col("page_id").cast("string"))
    # a plus sign stays one, as in a path
    return table(spark, at, "pages").select("page_id", F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))).alias("path"))
