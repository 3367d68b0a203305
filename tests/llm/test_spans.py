import hashlib
import random
import re
from collections import Counter

import pytest

from quern.llm import substring_dedup, suffix_dedup, vectors


def by_bytes(docs, length=100):
    seen, out = set(), {}
    for key, text in sorted(docs, key=lambda x: (x[0] is not None, x[0])):
        raw, hit = (text or "").encode(), bytearray(len((text or "").encode()))
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                hit[i : i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, h in zip(raw, hit) if not h)
        out[key] = (len(raw), sum(hit), len(re.findall(b"\1+", bytes(hit))), hashlib.sha256(kept).hexdigest())
    return out


def by_words(docs, length=35):
    split = {k: re.findall(r"[^\x20\x09-\x0D]+", t or "") for k, t in docs}
    n = Counter(tuple(w[i : i + length]) for w in split.values() for i in range(len(w) - length + 1))
    out = {}
    for k, w in split.items():
        hit = [False] * len(w)
        for i in range(len(w) - length + 1):
            if n[tuple(w[i : i + length])] > 1:
                hit[i : i + length] = [True] * length
        out[k] = (len(w), sum(hit), hashlib.sha256(" ".join(x for x, h in zip(w, hit) if not h).encode()).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß漢") for _ in range(rng.randint(1, 6))) for _ in range(40)]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", " ", "\n", "\t", " "]) for _ in range(n))
    base = [text(rng.randint(0, 400)) for _ in range(30)]
    docs = list(base)
    for _ in range(30):
        words = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = "x"
        docs.append(" ".join(words))
    hot = text(60)
    docs += [text(30) + hot + text(rng.randint(0, 30)) for _ in range(15)] + [hot] * 3
    docs += ["", None, " \n ", "a " * 300, "b" * 500, "b" * 99, "b" * 100, text(34).strip()]
    return [(i * 3 - 20, t) for i, t in enumerate(docs)] + [(None, text(100))]


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup_is_exact(spark, seed):
    docs = corpus(seed)
    table = spark.createDataFrame([(k, t, "x", "y") for k, t in docs], "doc_id bigint, text string, doc string, spans string")
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.digest(table).collect()}
    assert got == by_bytes(docs)


def test_other_lengths(spark):
    docs = corpus(5)
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {r[0]: tuple(r)[1:] for r in suffix_dedup.digest(table, length=37).collect()} == by_bytes(docs, 37)


@pytest.mark.parametrize("seed", [3, 4])
def test_substring_dedup_is_exact(spark, seed):
    docs = corpus(seed)
    table = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id bigint, text string, begin string, n int")
    got = {r[0]: tuple(r)[1:] for r in substring_dedup.digest(table).collect()}
    assert got == by_words(docs)


def test_remove_repeats_keeps_columns(spark):
    rows = [(1, "a", "w " * 10, 5), (2, "b", "first part é " * 30, 6), (3, "c", "first part é " * 30, None), (4, None, None, 7)]
    table = spark.createDataFrame(rows, "doc_id bigint, lang string, text string, spans int")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(table).collect()}
    assert got[3].text == "" and got[1].text == "w " * 10 and got[2].text.startswith("first part é ") and got[4].text == ""
    assert (got[2].lang, got[2].spans, got[3].spans) == ("b", 6, None)


def raw_rows(spark, docs):
    return [tuple(r)[:3] for r in suffix_dedup.digest(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()]


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    none, nb = lambda t: (len(t.split()), 0), len(b.encode())
    words = lambda docs: sorted(tuple(r)[:3] for r in substring_dedup.digest(spark.createDataFrame(docs, "doc_id bigint, text string")).collect())
    assert words([(1, a), (1, b), (2, a)]) == sorted([(1, 60, 60), (1, *none(b)), (2, 60, 60)])
    assert words([(1, a), (1, a)]) == [(1, 60, 60)] * 2
    raw = lambda docs: sorted(tuple(r)[:3] for r in suffix_dedup.digest(spark.createDataFrame(docs, "doc_id bigint, text string")).collect())
    assert raw([(1, a), (2, b), (2, a)]) == sorted([(1, nb, 0), (2, nb, 0), (2, nb, nb)])
    assert raw([(1, a), (1, a)]) == [(1, nb, 0), (1, nb, nb)]
    assert sorted(x[1:] for x in map(tuple, raw_rows(spark, [(None, a), (None, a), (1, a)]))) == [(nb, 0), (nb, nb), (nb, nb)]


def test_very_long_texts(spark):
    rng = random.Random(8)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(120_000))
    docs = [(1, long), (2, "x" * 3000 + long[5000:900_000]), (3, "y " * 200_000), (4, "ab" * 200 + " " + "ba" * 200 + " c")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {r[0]: tuple(r)[1:] for r in suffix_dedup.digest(table).collect()} == by_bytes(docs)
    assert {r[0]: tuple(r)[1:] for r in substring_dedup.digest(table).collect()} == by_words(docs)


def test_long_words_of_two_letters_have_names_of_their_own():
    one, two = "a", "b"
    for _ in range(11):
        one, two = one + two, two + one
    _, _, _, names, _ = vectors.words([f"{one} {two}".encode()], vectors.BLANK_WORDS)
    assert names[0] != names[1]


def test_empty_tables(spark):
    table = spark.createDataFrame([], "doc_id bigint, text string")
    assert suffix_dedup.digest(table).collect() == [] and substring_dedup.digest(table).collect() == []
