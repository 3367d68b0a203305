"""The two near-duplicate modes against one pass in plain Python."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from quern.functions import hashing as H
from quern.operators import cleaning as C
from quern.operators import dedup as D
from quern.operators import manifest as N
from quern.operators import metrics as M
from quern.operators import tokens as K
from quern.plans import queries_corpus, queries_dedup
from quern.plans.base import keep


def prints(seed, n=250):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(30)]
    out = []
    for i in range(n):
        x = rng.choice(base)
        for _ in range(rng.randint(0, 3)):
            x ^= 1 << rng.randrange(64)
        out.append((i, x - (1 << 64) if x >> 63 else x))
    return out


def near(a, b, k=3):
    return ((a ^ b) & (1 << 64) - 1).bit_count() <= k


def test_greedy_is_one_pass(spark):
    rows = list({b: (i, b) for i, b in reversed(prints(1))}.values())
    kept, gone = [], {}
    for i, b in sorted(rows):
        by = next((j for j, c in kept if near(b, c)), None)
        if by is None:
            kept.append((i, b))
        else:
            gone[i] = by
    edges = D.pairs(spark.createDataFrame(rows, "doc_id bigint, bits bigint"), "doc_id")
    assert {r.id: r.kept_by for r in D.greedy(edges, keep).collect()} == gone
    assert D.greedy(edges.limit(0), keep).collect() == []


def test_banded_groups_and_cap(spark):
    rows = prints(2)
    want = set()
    for band in range(4):
        groups = {}
        for i, b in rows:
            groups.setdefault((b >> 16 * band) & 0xFFFF, []).append((i, b))
        for g in groups.values():
            kept = []
            for i, b in g:
                if any(near(b, c) for c in kept):
                    want.add(i)
                else:
                    kept.append(b)
    got = D.banded_groups(spark.createDataFrame(rows, "doc_id bigint, bits bigint"), "doc_id").where("first_id is not null")
    assert {r.id for r in got.collect()} == want
    capped = D.banded_groups(spark.createDataFrame([(0, 0), (1, 0), (2, 8)], "doc_id bigint, bits bigint"), "doc_id", threshold=0, cap=1)
    assert [(r.id, r.first_id, r.capped) for r in capped.orderBy("id").collect()] == [(1, 0, False)]


def test_serial_labels(spark):
    base = " ".join(f"word{i} about things" for i in range(80)) + "."
    docs = [(0, base), (1, base + " extra"), (2, base + " extra"), (3, base), (4, "Entirely other text for this test alone, long enough to stay. " * 2), (5, "x")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: r.reason for r in queries_dedup.serial_reasons(table, C.Cleaning(max_repeated_lines=1.0)).collect()}
    assert got[0] == got[4] == "kept" and got[3] == "exact_duplicate" and got[5] == "too_short"
    # the first changed one is near the base, and so is its copy
    assert got[1] == got[2] == "near_duplicate"
    strict = {r.doc_id: r.reason for r in queries_dedup.serial_reasons(table, C.Cleaning(max_repeated_lines=1.0, min_chars=1, min_quality=0.0)).collect()}
    assert strict[5] == "kept"


def test_split_runs(spark):
    # title 1 comes twice, and its runs are two; a null title is untitled; the last run is too short
    rows = [(1, i, "x" * 40) for i in range(7)] + [(2, 7, "y" * 60), (None, 8, "z" * 60)] + [(1, i, "x" * 40) for i in range(9, 13)] + [(2, 13, "short"), (2, 14, "")]
    got = queries_corpus.split_runs(spark.createDataFrame(rows, "t bigint, k bigint, s string"), "t", "k", "s", 100, 50).orderBy("first").collect()
    assert [(r.first, r.title, r.part, r.n) for r in got] == [(0, "1", 0, 3), (3, "1", 1, 3), (7, "2", 0, 1), (8, "untitled", 0, 1), (9, "1", 0, 3)]


def test_packs_and_mask(spark):
    docs = spark.createDataFrame([(i, [97 + i] * 4) for i in range(5)], "doc_id bigint, ids array<int>")
    packs = K.packed(docs, 5, 0)
    assert [r.input_ids for r in packs.orderBy("pack_id").collect()] == [[97 + i] * 4 + [0] for i in range(5)]
    assert K.unpacked(packs, 0).count() == 5 and K.block_mask(packs).count() == 5 * 15
    assert K.eval_packs(packs, 2).count() == 4


def test_slots_cover_each_shard_once(spark):
    m = spark.createDataFrame([(f"u{i}", 10, 5) for i in range(7)], "uri string, num_records bigint, estimated_tokens bigint").withColumn("sha256", F.sha2("uri", 256))
    s = N.with_slots(m, 2, 2).collect()
    assert sorted(r.uri for r in s) == [f"u{i}" for i in range(7)] and {(r.rank, r.worker) for r in s} <= {(a, b) for a in (0, 1) for b in (0, 1)}
    ppl = spark.range(1).select(M.perplexity(F.lit(60.0)).alias("p")).first().p
    assert ppl == float("inf")


def test_pairs_come_once(spark):
    rows = list({b: (i, b) for i, b in prints(3, 400)}.values())
    for k in (0, 1, 3, 5):
        got = sorted((r.a, r.b, r.distance) for r in D.pairs(spark.createDataFrame(rows, "doc_id bigint, bits bigint"), "doc_id", k).collect())
        assert got == sorted((min(i, j), max(i, j), ((a ^ b) & (1 << 64) - 1).bit_count()) for n, (i, a) in enumerate(rows) for j, b in rows[:n] if near(a, b, k))
    # those that share no two bands of five don't meet
    cut = spark.createDataFrame([(1, 5), (2, 5 | 1 << 20 | 1 << 33 | 1 << 46 | 1 << 60)], "doc_id bigint, bits bigint").select(H.band_pairs(F.col("bits")).alias("v"))
    a, b = (r.v for r in cut.collect())
    assert len(a) == 10 and not any(x == y for x, y in zip(a, b))


def test_grouped_copies_fare_as_their_first(spark):
    # 2 is near 1 and kept nowhere, 3 equals 2, 4 is full of others' groups alone and 5 equals it, 6 equals 1; of one id several rows
    far = 0x0FF1_0EE2_0DD3_0CC4
    rows = [(1, 0), (2, 8), (3, 8), (4, far), (5, far), (6, 0), (7, None)]
    table = spark.createDataFrame(rows, "doc_id bigint, bits bigint")
    assert {r.id: (r.first_id, r.capped) for r in D.banded_groups(table, "doc_id").collect()} == {2: (1, False), 3: (1, False), 5: (4, False), 6: (1, False)}
    full = spark.createDataFrame([(1, 0), (2, 0xFF), (3, 0xFF), (4, 0)], "doc_id bigint, bits bigint")
    # 2 is kept in its own last band's group, and is beyond the bound in the three others
    assert {r.id: (r.first_id, r.capped) for r in D.banded_groups(full, "doc_id", cap=1).collect()} == {2: (None, True), 3: (2, True), 4: (1, False)}


def test_words_vote_where_they_are_read(spark):
    def own(*texts):
        words = [w for t in texts for w in re.findall(r"[\w一-鿿]+", t.lower()) or [t.lower()]]
        digests = [int.from_bytes(hashlib.md5(w.encode()).digest()[:8], "big") for w in words]
        return str(sum(1 << i for i in range(64) if 2 * sum(d >> i & 1 for d in digests) >= len(words)))

    long = " ".join(f"w{i * i % 9973}" for i in range(150_000))  # more than two pieces
    texts = [(1, "One two, two."), (2, long), (3, ""), (4, " .,; "), (5, "第一 Été_2"), (6, None), (7, "a b c"), (7, "d e"), (8, long + " end"), (9, "...a")]
    found = H.simhash_md5(spark.createDataFrame(texts, "doc_id bigint, text string").coalesce(1), "doc_id", "text")
    want = {i: own(*(t for j, t in texts if j == i)) for i in range(1, 10) if i != 6}
    assert {r.doc_id: r.simhash for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    # no row a word
    assert "Generate" not in plan and "token" not in plan


def test_no_texts_are_kept(spark, monkeypatch):
    seen = []

    def recorded(df):
        seen.append(df.columns)
        return keep(df)

    monkeypatch.setattr(C, "kept_table", recorded)
    monkeypatch.setattr(queries_dedup, "keep", recorded)
    docs = spark.createDataFrame([(i, f"Some text with its number {i % 3}, of words enough to pass the filters.") for i in range(9)], "doc_id bigint, text string")
    for mode in (queries_dedup.serial_reasons, queries_dedup.partitioned_reasons):
        seen.clear()
        assert mode(docs, C.Cleaning()).count() == 9
        assert seen and not any({"clean", "text"} & set(columns) for columns in seen)


def test_classes_come_from_written_prints(spark, monkeypatch):
    seen = []

    def recorded(df):
        seen.append(df.columns)
        return keep(df)

    monkeypatch.setattr(queries_dedup, "keep", recorded)
    for query in (queries_dedup.near_dup_classes, queries_dedup.near_dup_pairs):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        # neither words nor texts are read again for the second side of the join
        assert "documents.parquet" not in plan and "Generate regexp" not in plan
    assert [sorted(c) for c in seen] == [["bits", "doc_id"]] * 2


def test_bands_deal_no_words(spark):
    plan = queries_dedup.simhash_bands(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    # one row a band, and none a word
    assert plan.count("Generate") == 1 and "posexplode" in plan
