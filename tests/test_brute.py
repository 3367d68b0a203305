"""The queries that SQL can't tell, against one pass in plain Python over the smallest tables."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.functions.arrow import html_text, nfkc
from quern.operators import cleaning as C
from quern.plans import queries_dedup, registry

AT = "/root/testdata/sf0.001"


def fingerprint(text, digest):
    low = text.lower()
    votes = [0] * 64
    for word in re.findall(r"[\w一-鿿]+", low) or [low]:
        n = int.from_bytes(digest(word.encode()), "big")
        for i in range(64):
            votes[i] += 1 if n >> i & 1 else -1
    return sum(1 << i for i, v in enumerate(votes) if v >= 0)


MD5 = lambda raw: hashlib.md5(raw).digest()[:8]
BLAKE = lambda raw: hashlib.blake2b(raw, digest_size=8).digest()


@pytest.fixture(scope="module")
def docs(spark):
    """Ids, cleaned texts, what cleaning says, digests and scores."""
    d = spark.read.parquet(f"{AT}/documents.parquet")
    rows = C.scored(C.cleaned(d, C.Cleaning())).select("doc_id", "clean", "reason", T.exact_hash(F.col("clean")).alias("hash"), "quality_score").collect()
    return sorted(rows)


def near(a, b):
    return (a ^ b).bit_count() <= 3


def test_simhash_blake2b(spark, docs):
    got = {r.doc_id: int(r.simhash) for r in registry.QUERIES["simhash_blake2b"](spark, AT).collect()}
    assert got == {r.doc_id: fingerprint(r.clean, BLAKE) for r in docs}


def test_near_dup_serial(spark, docs):
    hashes, prints, want = set(), [], {}
    for r in docs:
        if r.reason:
            want[r.doc_id] = r.reason
            continue
        if r.hash in hashes:
            want[r.doc_id] = "exact_duplicate"
            continue
        own = fingerprint(r.clean, MD5)
        if any(near(own, p) for p in prints):
            want[r.doc_id] = "near_duplicate"
            continue
        hashes.add(r.hash)
        prints.append(own)
        want[r.doc_id] = "low_quality" if r.quality_score < 0.45 else "kept"
    assert {"exact_duplicate", "near_duplicate", "kept"} <= set(want.values())
    assert {r.doc_id: r.reason for r in registry.QUERIES["near_dup_serial"](spark, AT).collect()} == want


@pytest.mark.parametrize(("query", "digest"), [("near_dup_partitioned", MD5), ("near_dup_partitioned_blake2b", BLAKE)])
def test_near_dup_partitioned(spark, docs, query, digest):
    want, first, prints = {}, {}, []
    for r in docs:
        reason = r.reason or ("low_quality" if r.quality_score < 0.45 else None)
        if reason is None:
            prints.append((r.doc_id, fingerprint(r.clean, digest)))
            if r.hash in first:
                reason = "exact_duplicate"
            first.setdefault(r.hash, r.doc_id)
        want[r.doc_id] = reason
    for band in range(4):
        groups = {}
        for i, p in prints:
            kept = groups.setdefault(p >> 16 * band & 0xFFFF, [])
            if any(near(p, q) for q in kept):
                want[i] = want[i] or "near_duplicate"
            else:
                kept.append(p)
    got = registry.QUERIES[query](spark, AT).collect()
    assert {r.doc_id: r.reason for r in got} == {i: w or "kept" for i, w in want.items()} and not any(r.capped for r in got)


def test_capped_rows_are_told(spark):
    words = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(3)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(words)], "doc_id bigint, text string")
    one = F.pandas_udf(lambda x: x.map(lambda t: str(0 if t.startswith("w0") else 0xFFFF if t.startswith("w1") else 0xFF0)), "string")
    got = {r.doc_id: (r.reason, r.capped) for r in queries_dedup.partitioned_reasons(d, C.Cleaning(min_quality=0.0), one, cap=1).collect()}
    assert got == {0: ("kept", False), 1: ("kept", True), 2: ("kept", True)}


def test_html(spark):
    cases = {
        "<p>a<form>b<p>c</form>d": "ad",
        "<div><nav>menu</div>after": "after",
        "<script>x<b></script>y</b>z": "yz",
        "<br><img src=x>a<input>b": "ab",
        "a</nav>b<footer>c</footer>&amp;&#233;": "ab&é",
        "<article><header>h</header>t<aside>s</aside></article>": "t",
    }
    rows = spark.createDataFrame(list(cases.items()), "page string, want string").withColumn("got", html_text("page")["text"]).collect()
    assert [(r.page, r.got) for r in rows] == [(r.page, r.want) for r in rows]
    pages = spark.read.parquet(f"{AT}/pages.parquet").select("html", html_text("html").alias("x")).collect()
    for r in pages:
        for tag in ("script", "style"):
            for inner in re.findall(rf"<{tag}[^>]*>([^<]{{12,}})</{tag}>", r.html):
                assert inner.strip() not in r.x["text"]


def test_nfkc_changes_texts(spark):
    import unicodedata

    texts = ["ﬁne Ａ１", "é", "①②", "ｶﾞ", "plain", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", nfkc(F.col("t")).alias("n")).collect()
    assert [r.n for r in rows] == [t and unicodedata.normalize("NFKC", t) for t in texts] and rows[0].n == "fine A1"
