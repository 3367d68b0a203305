import random
import re

import numpy as np

from quern.llm import minhash
from quern.llm.components import components
from quern.llm.store import Store


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    sets = [(k, shingles(t)) for k, t in docs]
    root = {k: k for k, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                a2, b2 = sorted((find(a), find(b)))
                root[b2] = a2
    return sorted((k, len(x), find(k), k == find(k)) for k, x in sets)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeÉfgß") for _ in range(rng.randint(1, 5)))
    docs = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 8, 11, 40, 150, 600]))]
        docs.append(base)
        for _ in range(rng.randint(0, 6)):  # some at the threshold's either side
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 45))):
                copy[rng.randrange(len(copy))] = word()
            docs.append(copy + [word() for _ in range(rng.randint(0, 2))])
    chain = [word() for _ in range(100)]
    for _ in range(12):
        docs.append(list(chain))
        chain[rng.randrange(100)] = word()
    rng.shuffle(docs)
    texts = [rng.choice([" ", "\n", " \t"]).join(d) for d in docs]
    return [(3 * i + 5, t.upper() if i % 5 == 0 else t) for i, t in enumerate(texts)] + [(1, None), (2, ""), (4, " \n")]


def test_groups_equal_brute_force(spark):
    docs = corpus(1)
    table = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id bigint, text string, n string, u int")
    assert sorted(map(tuple, minhash.groups(table, percent=85).collect())) == brute(docs)
    left = {r.doc_id for r in minhash.first_of_each(table, percent=85).collect()}
    assert left == {k for k, _, _, kept in brute(docs) if kept}


def test_a_crowd_without_a_centre_equals_brute_force(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(140)]
    docs = []
    for k in range(150):  # most pairs lie just under the threshold, and share some of their edits
        words = list(base)
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(140)] = rng.choice(["x", "y", f"own{k}"])
        docs.append((1000 - k, " ".join(words)))
    docs += [(k, " ".join([*base[:100], *(f"p{k}x{i}" for i in range(40))])) for k in range(60)]
    want = brute(docs)
    assert 40 < sum(kept for *_, kept in want) < 200
    assert sorted(map(tuple, minhash.groups(spark.createDataFrame(docs, "doc_id bigint, text string"), percent=85).collect())) == want


def test_very_long_texts(spark):
    rng = random.Random(4)
    words = [f"w{rng.randrange(50000)}" for _ in range(200_000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:190_000])), (3, " ".join(words[:150_000])), (4, "w1 " * 300_000)]
    assert sorted(map(tuple, minhash.groups(spark.createDataFrame(docs, "doc_id bigint, text string"), percent=85).collect())) == brute(docs)


def test_odd_rows(spark):
    docs = [(None, "a b c d e f"), (None, "a b c d e f"), (9, "a b c d e f"), (9, "a b c d e f"), (3, "x y z"), (3, "a b c d e f"), (8, "X Y Z")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = sorted(map(tuple, minhash.groups(table, percent=85).collect()), key=str)
    assert got == sorted([(None, 2, None, True)] * 2 + [(9, 2, 3, False)] * 2 + [(3, 1, 3, True), (3, 2, 3, True), (8, 1, 3, False)], key=str)
    assert minhash.groups(spark.createDataFrame([], table.schema)).collect() == []


def test_estimates_are_near_the_truth():
    rng = np.random.default_rng(1)
    for n, share in ((3000, 0.85), (1000, 0.5), (20000, 0.0)):
        both = rng.integers(0, 1 << 63, round(n * share), dtype=np.uint64)
        sets = [np.unique(np.concatenate([both, rng.integers(0, 1 << 63, (n - len(both)) // 2, dtype=np.uint64)])) for _ in range(2)]
        true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        full = minhash.filled(minhash.registers(sets))
        got = minhash.estimates(full[:1], full[1:], np.array([len(sets[0])]), np.array([len(sets[1])]))[0]
        assert abs(got - true) < 0.12


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(1900, 2100)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = {(x, find(x)) for x in root if find(x) != x}
    got = components(Store(spark, "test"), spark.createDataFrame(edges, "u bigint, v bigint"))
    assert {tuple(r) for r in got.collect()} == want
