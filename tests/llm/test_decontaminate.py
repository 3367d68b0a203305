import hashlib
import random
import re

import pytest

from quern.llm import decontaminate

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items):
    out = []
    windows = []
    for key, text in items:
        w = SPLIT.findall(lower(text))
        n = min(10, len(w))
        windows += [(key, tuple(w[i : i + n])) for i in range(len(w) - n + 1) if n]
    for key, text in docs:
        w, hit, found = SPLIT.findall(lower(text)), set(), set()
        for item, win in windows:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    found.add(item)
        out.append((key, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def tables(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abÉé漢09Z") for _ in range(rng.randint(1, 4)))
    items = [(i * 7, " ".join(word() for _ in range(rng.choice([1, 2, 5, 9, 10, 11, 30])))) for i in range(25)] + [(900, None), (901, "..."), (902, "a " * 14)]
    items += [(903, items[-3 - 5][1])]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            w = (rng.choice(items)[1] or "x").split()
            a = rng.randrange(len(w)) if rng.random() < 0.5 else 0
            parts += [w[a:], [word() for _ in range(rng.randint(0, 12))]]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(x for p in parts for x in p).upper() if i % 3 else " ".join(x for p in parts for x in p)))
    return docs + [(70, None), (71, ""), (72, "A a a a a a a a a a a a a a b"), (73, items[0][1]), (73, items[0][1])], items


@pytest.mark.parametrize(("seed", "block"), [(1, 1 << 20), (2, 300)])
def test_report_equals_brute_force(spark, seed, block):
    docs, items = tables(seed)
    d = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id bigint, text string, items string, item_id int")
    i = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id bigint, text string, doc_id int")
    assert sorted(map(tuple, decontaminate.report(d, i, block_bytes=block).collect()), key=str) == brute(docs, items)


def test_empty_tables_and_clean(spark):
    docs, items = tables(3)
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert all(not r.contaminated for r in decontaminate.report(d, none).collect())
    assert decontaminate.report(spark.createDataFrame([], d.schema), i).collect() == []
    left = {r[0] for r in decontaminate.clean(d, i).collect()}
    assert left == {r[0] for r in brute(docs, items) if not r[-1]}


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_null_and_shared_ids_and_a_very_long_text(spark, block):
    _, items = tables(4)
    leak = max((t for _, t in items if t), key=len)
    docs = [(None, "nothing of that sort"), (None, leak), (1, leak), (1, "entirely clean words"), (2, "filler " * 300_000 + leak + " filler" * 300_000), (3, "漢" * 100_000)]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert sorted(map(tuple, decontaminate.report(d, i, block_bytes=block).collect()), key=str) == brute(docs, items)
    left = [(r.doc_id, r.text) for r in decontaminate.clean(d, i).collect()]
    assert sorted(left, key=str) == sorted(((k, t) for (k, t), r in zip(docs, [brute([x], items)[0] for x in docs], strict=True) if not r[-1]), key=str)
