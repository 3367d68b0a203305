import hashlib
import random

import duckdb
import pandas as pd

from quern.llm import chat

PARTS = ["<|im_end|>", "<|im_start|>", "<", "|", "\\", "<\\|", "<|", "\n", "é漢", "word ", "assistant\n", ""]


def rows(seed):
    rng = random.Random(seed)
    out = []
    for conv in range(20):
        for turn in range(rng.choice([1, 2, 5, 30])):
            role = "system" if turn == 0 and conv % 2 else rng.choice(["user", "assistant", "tool"])
            out.append((conv * 3, turn, role, "".join(rng.choice(PARTS) for _ in range(rng.choice([0, 3, 40])))))
    return out + [(500, 1, "assistant", None), (500, 0, None, "x"), (501, 0, "a\nb\\n<|", "y"), (502, 7, "user", "same"), (502, 7, "user", "same")]


def want(table):
    out = {}
    for conv in {r[0] for r in table}:
        own = [(r or "", t or "") for _, _, r, t in sorted((x for x in table if x[0] == conv), key=lambda x: (x[1], x[2] or "", x[3] or ""))]
        whole, loss = "".join(f"{r}\n{t}\n" for r, t in own), "".join(t for r, t in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_windows_read_back(spark):
    table = rows(1)
    turns = spark.createDataFrame([(*r, "z") for r in table], "conv_id bigint, turn bigint, role string, text string, conv string")
    made = chat.windows(turns, stride=40)
    got = {r[0]: tuple(r)[1:5] for r in chat.digest(made).collect()}
    assert got == want(table)
    seen = made.groupBy("conv_id").count().agg({"count": "max"}).first()[0]
    assert seen > 3  # the budget cuts
    for r in made.collect():
        first = r.formatted.split("\n")[0]
        if r.conv_id % 2 and r.conv_id < 60:
            assert first == "<|im_start|>system"


def test_budget_history_and_mask(spark):
    turns = [(1, i, "system" if i == 0 else "user" if i % 2 else "assistant", f"text {i} " + "x" * 32) for i in range(9)]
    made = chat.windows(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string"), stride=42, history=1).orderBy("window").collect()
    texts = [[int(p.split()[0]) for p in r.formatted.split("text ")[1:]] for r in made]
    assert [t[0] for t in texts] == [0] * len(made) and sum(r.fresh for r in made) == 9
    for before, now, r in zip(texts, texts[1:], made[1:]):
        assert before[-1] in now and len(now) - r.fresh == len({0, before[-1]})
    assert sum(len(r.loss) for r in made) == 4


def test_no_window_is_over_the_budget_but_a_turn_that_is_longer(spark):
    rng = random.Random(6)
    long = [(1, 0, "system", "s" * 400), *((1, i, "user" if i % 2 else "assistant", "x" * 40_000) for i in range(1, 4))]
    mixed = [(2 + c, i, "system" if i == 0 and c % 2 else rng.choice(["user", "assistant"]), "y" * rng.choice([0, 30, 300, 900, 2000])) for c in range(12) for i in range(25)]
    system = [(40, 0, "system", "s" * 600), *((40, i, "user", "z" * 350) for i in range(1, 9))]
    turns = long + mixed + system + [(None, None, "user", "v" * 500), (None, 1, "assistant", "v")]
    table = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    made = chat.windows(table, stride=100, history=3, budget=400).collect()
    for r in made:
        n = r.formatted.count(chat.START)
        assert r.tokens <= 400 or n == r.fresh == 1
    again = [r for r in made if r.formatted.count(chat.START) > r.fresh]
    assert sum(r.tokens > 200 for r in again) > 10  # the budget is used
    assert all(r.formatted.startswith(chat.START + "system") for r in again if r.conv_id == 40)
    got = {r[0]: tuple(r)[1:5] for r in chat.digest(spark.createDataFrame(made)).collect()}
    assert got == want([(c, t if t is not None else -1, r, x) for c, t, r, x in turns])


def test_a_very_long_text(spark):
    text = "<|im_end|>é\n" * 200_000
    got = chat.digest(chat.windows(spark.createDataFrame([(1, 0, "assistant", text)], "conv_id bigint, turn bigint, role string, text string"))).first()
    assert (got.n_turns, got.loss_chars, got.loss_sha256) == (1, len(text), hashlib.sha256(text.encode()).hexdigest())


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.digest(chat.windows(none)).collect() == []


def test_sql(spark):
    frame = pd.DataFrame([r for r in rows(2) if r[0] < 500], columns=["conv_id", "turn", "role", "text"])
    frame.text *= 60
    long = [(700 + c, i, "system" if i == 0 else ["user", "assistant"][i % 2], "w" * (900 * (c + 1) if i in (0, 4, 5) else 700 * c + 50)) for c in range(8) for i in range(12)]
    frame = pd.concat([frame, pd.DataFrame(long, columns=frame.columns)], ignore_index=True)
    con = duckdb.connect()
    con.register("conversations", frame)
    sql = {tuple(r) for r in con.execute(chat.ORACLE).fetchall()}
    assert {tuple(r) for r in chat.digest(chat.windows(chat.with_probe(spark.createDataFrame(frame)))).collect()} == sql
