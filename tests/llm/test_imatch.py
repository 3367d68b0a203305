import hashlib
import random

from pyspark.sql import functions as F

from quern.llm import imatch


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéf漢") for _ in range(rng.randint(2, 6))) for _ in range(3000)]
    docs = [(7 * i - 50, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 300)))) for i in range(80)]
    return [*docs, (5000, docs[3][1]), (5001, None), (5002, ""), (5003, "😀😀😀"), (5004, "one")]


def test_edits_and_order(spark, monkeypatch):
    for size in (2000, 7):
        monkeypatch.setattr(imatch, "BUCKET_DOCS", size)
        docs = corpus(1)
        table = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id bigint, text string, bucket string, copy int")
        got = {r.doc_id: r for r in imatch.report(table).collect()}
        order = sorted(((k, t or "") for k, t in docs), reverse=True)
        prints = {}
        for (k, t), (k2, t2) in zip(order, order[1:] + order[:1]):
            r, h = got[k], len(t) // 2
            assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256((t[: len(t) - h] + t2[:h]).encode()).hexdigest())
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            if r.fingerprint == got[k2].fingerprint:
                assert r.near_next == 1
            assert prints.setdefault(t, r.fingerprint) == r.fingerprint
        long = [k for k, t in docs if len((t or "").split()) > 50]
        assert sum(got[k].near_edited for k in long) > 2 * sum(got[k].near_next for k in long)


def test_the_band_decides(spark):
    docs = [(i, f"everywhere word{i % 5} only{i}") for i in range(20)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    held = imatch.lexicon(table)
    assert 8 <= sum(x.bit_count() for x in held) <= 10  # two bits for each of the five words of four documents
    one, two = table.where("doc_id in (0, 5)").select(imatch.fingerprint(F.col("text"), held)).collect()
    assert one == two


def test_likeness(spark):
    one, two, none = (F.array(*(F.lit(x).cast("bigint") for x in [*start, *[0] * 6])) for start in ((1, 2), (1, 3), (0, 0)))
    row = spark.range(1).select(imatch.likeness(one, two), imatch.likeness(one, one), imatch.likeness(none, none), imatch.likeness(one, none)).first()
    assert tuple(row) == (0.5, 1.0, 1.0, 0.0)


def test_odd_rows(spark):
    odd = spark.createDataFrame([(None, "a b"), (1, "x"), (1, "x"), (1, "y"), (2, None)], "doc_id bigint, text string")
    assert imatch.report(odd).count() == 5
    assert imatch.report(odd.limit(0)).collect() == [] and imatch.report(odd.where("text = 'y'")).first().near_next == 1


def test_ids_may_be_far_apart_or_null(spark, monkeypatch):
    monkeypatch.setattr(imatch, "BUCKET_DOCS", 3)
    texts = [f"text number {i} " * (i + 1) for i in range(40)]
    ids = [-(1 << 63), (1 << 63) - 1, *range(18), *[None] * 20]
    rows = imatch.report(spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id bigint, text string")).collect()
    assert len(rows) == 40
    # each text is the next of one other: the edits that begin with a text's half end with the first part of its next
    edits = {r.edited_sha256 for r in rows}
    after = {}
    for t in texts:
        h = len(t) // 2
        after[t] = [u for u in texts if hashlib.sha256((t[: len(t) - h] + u[:h]).encode()).hexdigest() in edits]
        assert after[t]
    known = {i: t for i, t in zip(ids, texts, strict=True) if i is not None}
    order = sorted(known, reverse=True)
    for i, j in zip(order, order[1:]):
        t, u = known[i], known[j]
        assert hashlib.sha256((t[: len(t) - len(t) // 2] + u[: len(t) // 2]).encode()).hexdigest() in edits


def test_the_fingerprint_is_what_it_says(spark):
    """Each subset's digits from the terms, dealt out and hashed one by one."""
    docs = [(k, t) for k, t in corpus(3)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("text", F.coalesce("text", F.lit("")))
    held = imatch.lexicon(table)
    seen = table.select("doc_id", F.explode(imatch.terms(F.col("text"))).alias("t"))
    n = seen.groupBy("t").count().collect()
    band = {r.t for r in n if 2 <= r["count"] <= max(2, 0.2 * len(docs))}
    places = spark.createDataFrame([(t.t,) for t in n], "t bigint").select("t", *(p.alias(f"p{i}") for i, p in enumerate(imatch._places(F.col("t"), (8 * len(held)).bit_length() - 1))), *(F.xxhash64("t", F.lit(8 + i)).alias(f"h{i}") for i in range(imatch.LEVELS))).collect()
    passes = {r.t: [r[f"h{i}"] for i in range(imatch.LEVELS)] for r in places if all(held[r[p]  >> 3] >> (r[p] & 7) & 1 for p in ("p0", "p1"))}
    assert band <= set(passes) and len(passes) <= len(band) + len(n) // 50
    hashed = {}
    for r in seen.collect():
        for level, h in enumerate(passes.get(r.t, [])):
            if h & ((1 << level * imatch.LEVEL_BITS) - 1) == 0:
                hashed.setdefault((r.doc_id, level * imatch.SUBSETS + ((h & (1 << 64) - 1) >> 59)), []).append(h)
    got = {r.doc_id: r.fp for r in table.select("doc_id", imatch.fingerprint(F.col("text"), held).alias("fp")).collect()}
    chains = [(k, s, sorted(hs)) for (k, s), hs in hashed.items()]
    step = F.aggregate(F.slice("h", 2, 100000), F.xxhash64(F.element_at("h", 1)), lambda a, x: F.xxhash64(a, x))
    want = {k: ["0" * 8] * imatch.LEVELS * imatch.SUBSETS for k, _ in docs}
    for r in spark.createDataFrame(chains, "k bigint, s int, h array<bigint>").select("k", "s", step.alias("x")).collect():
        want[r.k][r.s] = f"{r.x & 0xFFFFFFFF:08x}"
    assert got == {k: "".join(x) for k, x in want.items()}


def test_a_very_long_text(spark):
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(30000)}" for _ in range(200_000))
    rows = imatch.report(spark.createDataFrame([(1, long), (2, long), (3, "w1 w2")], "doc_id bigint, text string")).collect()
    assert len({r.fingerprint for r in rows if r.doc_id < 3}) == 1


def test_each_edit_is_nearer_than_the_next(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(20000)]
    docs = [(i, " ".join(rng.sample(vocab, n))) for n in (200, 400, 1000, 4000) for i in range(n * 10, n * 10 + 20)]
    rows = imatch.report(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert len(rows) == 80
    for size in (200, 400, 1000, 4000):
        nearer = sum(r.near_edited > r.near_next for r in rows if r.doc_id // 10 in range(size, size + 2))
        assert nearer >= 18, (size, nearer)
