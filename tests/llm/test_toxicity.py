import math
import random
import zlib

import numpy as np

from quern.llm import toxicity


def corpus(seed, n=600):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghé") for _ in range(rng.randint(2, 7))) for _ in range(800)]
    docs, labels = [], []
    for i in range(n):
        words, bad = [rng.choice(vocab) for _ in range(rng.randint(5, 120))], i % 5 == 0
        if bad:
            for _ in range(rng.randint(1, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(["scumbag", "vilest", "vilely"]))
        docs.append((i, " ".join(words), "src"))
        labels.append((i, int(bad)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus(1)
    d, l = spark.createDataFrame(docs, "doc_id bigint, text string, label string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in toxicity.report(d, l).collect()}
    truth = dict(labels)
    for k, r in got.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    out = [k for k, r in got.items() if r.held_out]
    assert sum(got[k].predicted == truth[k] for k in out) / len(out) > 0.95
    kept = {r.doc_id for r in toxicity.clean(d, l).collect()}
    assert kept == {k for k, r in got.items() if not r.predicted}


def test_fit_equals_a_plain_learner():
    """The published update, one coordinate at a time, with dictionaries."""
    rng = random.Random(4)
    rows = [(sorted(rng.sample(range(40), rng.randint(0, 9))), int(rng.random() < 0.4)) for _ in range(300)]
    rows = [(own, 1 if 3 in own or 7 in own and rng.random() < 0.8 else y) for own, y in rows]
    z, n, bias = {}, {}, 1 << toxicity.BITS

    def weight(i):
        l1 = 0.0 if i == bias else toxicity.L1
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        if abs(zi) <= l1:
            return 0.0
        return -(zi - math.copysign(l1, zi)) / ((toxicity.BETA + math.sqrt(ni)) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for own, y in rows:
            w = {i: weight(i) for i in [*own, bias]}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i, wi in w.items():
                ni = n.get(i, 0.0)
                sigma = (math.sqrt(ni + g * g) - math.sqrt(ni)) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * wi
                n[i] = ni + g * g
    at, w, b = toxicity.fit([(np.array(own, np.int64), y) for own, y in rows])
    want = {i: weight(i) for i in range(40) if weight(i)}
    assert 0 < len(want) < 40 and set(at.tolist()) == set(want)
    assert all(math.isclose(want[i], x, rel_tol=1e-9) for i, x in zip(at.tolist(), w.tolist(), strict=True)) and math.isclose(b, weight(bias), rel_tol=1e-9)


def test_held_out_rows_teach_nothing(spark):
    docs, labels = corpus(2, 200)
    flipped = [(k, 1 - y if zlib.crc32(str(k).encode()) % 4 == 2 else y) for k, y in labels]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, label string")
    one, two = (sorted(map(tuple, toxicity.report(d, spark.createDataFrame(x, "doc_id bigint, toxic int")).collect())) for x in (labels, flipped))
    assert one == two


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "word " * 5000)]
    d, none = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r.score for r in toxicity.report(d, none).collect()] == [0.0] * 5
    odd = spark.createDataFrame([(1, None), (None, 1), (3, 1), (3, 0)], none.schema)
    assert len(toxicity.report(d, odd).collect()) == 5 and toxicity.report(d.limit(0), odd).collect() == []
