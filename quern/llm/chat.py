"""Chat formatting into budgeted windows, by DataFrame functions alone.

A conversation's turns are laid end to end by prefix sums of their tokens, and a
window takes the turns that end in the same stretch of `stride` tokens, so it is
aligned to turns.  A turn of more than a stride is a window of its own, and starts
the sums anew, so the others hold less than two strides.  A window that doesn't
begin the conversation repeats the system turn (where the first turn is one) and
then up to `history` turns before it, the nearest first, as far as the budget
allows: all tokens of a window, what it repeats included, are within the budget,
but for a single turn that is longer than that; this stands alone and whole, for
no text is cut.  Each turn becomes

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

and inside texts every `<`, backslashes, `|` gets one more backslash, so neither
mark can appear there; unescaping takes it away.  The loss mask is a list of
stretches of the window's text, in code points: the assistant's texts, but not
those that a window repeats.

A turn's tokens are estimated, as no tokenizer is a DataFrame function; another
estimate may be given.  No group is gathered but a window's own turns, and they
are bounded by the budget or are one turn and no more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
STRIDE, HISTORY, BUDGET = 1024, 2, 4096


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escaped_role(role: Column) -> Column:
    """As a text, and on one line."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def tokens(text: Column) -> Column:
    """Tokens that a turn counts for: a quarter of its bytes, rounded up, and four for the marks."""
    return F.ceil(F.octet_length(text) / 4).cast("bigint") + 4


def windows(turns: DataFrame, stride: int = STRIDE, history: int = HISTORY, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", budget: int = BUDGET, count: Callable[[Column], Column] = tokens) -> DataFrame:
    """(conv, window, formatted, loss, fresh, tokens) of turns(conv, turn, role, text).

    loss: begin and length of each stretch under the loss mask; fresh: how many
    turns at the window's end aren't repeated; tokens: of all its turns.  budget
    ought to be two strides at least.  A null text or role counts as empty.  Turns
    go by number, then role, then text; a null number comes first; repeated rows
    are turns of their own.  Rows with a null conv are one conversation.  An empty
    table has no windows.
    """
    if budget < 2 * stride:
        raise ValueError("a window takes up to two strides of new turns, so the budget must be two strides at least")
    own = turns.select(turns[conv].alias("conv"), turns[turn].alias("turn"), F.coalesce(turns[role], F.lit("")).alias("role"), F.coalesce(turns[text], F.lit("")).alias("text"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumn("i", F.row_number().over(order)).withColumn("n", count(F.col("text")))
    own = own.withColumn("long", F.col("n") > stride).withColumn("end", F.sum("n").over(so_far))
    # long turns are islands, and the sums between them start anew
    longs = F.sum(F.col("long").cast("int")).over(so_far)
    last = F.coalesce(F.max(F.when(F.col("long"), F.col("end"))).over(so_far), F.lit(0))
    own = own.withColumn("island", 2 * longs - F.col("long").cast("int")).withColumn("slot", F.when(F.col("long"), 0).otherwise(F.floor((F.col("end") - last - 1) / stride)))
    place = F.struct("island", "slot")
    own = own.withColumn("opens", ~place.eqNullSafe(F.lag(place).over(order)))
    own = own.withColumn("w", (F.sum(F.col("opens").cast("int")).over(so_far) - 1).cast("bigint"))
    own = own.withColumn("f", F.sum("n").over(Window.partitionBy("conv", "w")))
    own = own.withColumn("first", (F.col("i") == 1) & (F.col("role") == "system")).withColumn("sys", F.coalesce(F.max(F.when(F.col("first"), F.col("n"))).over(so_far), F.lit(0)))
    # each of the last `history` turns also goes to the windows that open soon after it, if it and those between fit there
    after = []
    for k in range(1, history + 1):
        f, between = F.lead("f", k).over(order), F.lead("end", k - 1).over(order) if k > 1 else F.col("end")
        whole = f + F.when(f + F.col("sys") <= budget, F.col("sys")).otherwise(0) + between - F.col("end") + F.col("n")
        after.append(F.when(F.lead("opens", k).over(order) & ~F.col("first") & (whole <= budget), F.lead("w", k).over(order)))
    own = own.withColumn("later", F.array_compact(F.array(*after)) if after else F.array().cast("array<bigint>"))
    fresh = own.select("conv", "w", "i", "role", "text", "n", F.lit(False).alias("again"))
    repeat = own.select("conv", F.explode("later").alias("w"), "i", "role", "text", "n", F.lit(True).alias("again"))
    system = own.where("first").select(F.col("conv").alias("c"), "i", "role", "text", "n")
    opened = own.where(F.col("opens") & (F.col("w") > 0)).select("conv", "w", "f")
    system = opened.join(system, F.col("conv").eqNullSafe(F.col("c")) & (F.col("f") + F.col("n") <= budget)).select("conv", "w", "i", "role", "text", "n", F.lit(True).alias("again"))
    rows = fresh.unionByName(repeat).unionByName(system)
    shown = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    rows = rows.select("conv", "w", "i", "again", F.char_length(shown).alias("at"), F.char_length(escaped(F.col("text"))).alias("n"), F.col("n").alias("tokens"), F.concat(shown, escaped(F.col("text")), F.lit(f"{END}\n")).alias("shown"), ((F.col("role") == "assistant") & ~F.col("again")).alias("target"))
    packed = rows.groupBy("conv", "w").agg(F.array_sort(F.collect_list(F.struct("i", "again", "at", "n", "target", "shown"))).alias("turns"), F.sum("tokens").alias("tokens"))
    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<struct<begin:int,length:int>>").alias("loss"))
    step = lambda s, x: F.struct((s["pos"] + F.char_length(x["shown"])).alias("pos"), F.when(x["target"] & (x["n"] > 0), F.concat(s["loss"], F.array(F.struct((s["pos"] + x["at"]).alias("begin"), x["n"].alias("length"))))).otherwise(s["loss"]).alias("loss"))
    return packed.select(
        F.col("conv").alias(conv),
        F.col("w").alias("window"),
        F.array_join(F.col("turns.shown"), "").alias("formatted"),
        F.aggregate("turns", start, step)["loss"].alias("loss"),
        F.size(F.filter("turns", lambda x: ~x["again"])).alias("fresh"),
        "tokens",
    )


def turns_of(formatted: Column) -> Column:
    """Role and text of each turn of a window's text."""
    parts = F.slice(F.split(formatted, r"<\|im_end\|>\n"), F.lit(1), F.size(F.split(formatted, r"<\|im_end\|>\n")) - 1)
    head = F.char_length(F.lit(START))
    # the role is what stands before the first line feed
    return F.transform(parts, lambda p: F.struct(unescaped_role(F.substring_index(F.substr(p, head + 1), "\n", 1)).alias("role"), unescaped(F.substr(p, F.locate("\n", p) + 1)).alias("text")))


def learnt(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, in order."""
    return F.transform(loss, lambda x: unescaped(F.substr(formatted, x["begin"] + 1, x["length"])))


def digest(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the windows."""
    turns = turns_of(F.col("formatted"))
    fresh = F.slice(turns, F.size(turns) - F.col("fresh") + 1, F.col("fresh"))
    text = F.array_join(F.transform(fresh, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    read = formatted.select(F.col(conv).alias("conv"), "window", "fresh", text.alias("turns"), F.array_join(learnt(F.col("formatted"), F.col("loss")), "").alias("learnt"), F.char_length("formatted").cast("bigint").alias("chars"))
    whole = read.groupBy("conv").agg(F.sum("fresh").alias("n"), F.array_sort(F.collect_list(F.struct("window", "turns", "learnt"))).alias("parts"), F.sum("chars").alias("chars"))
    joined = lambda name: F.array_join(F.col(f"parts.{name}"), "")
    return whole.select(
        F.col("conv").alias("conv_id"), F.col("n").alias("n_turns"), F.sha2(joined("turns"), 256).alias("turns_sha256"),
        F.char_length(joined("learnt")).cast("bigint").alias("loss_chars"), F.sha2(joined("learnt"), 256).alias("loss_sha256"), F.col("chars").alias("formatted_chars"),
    )


def with_probe(turns: DataFrame) -> DataFrame:
    """The table and conversation -1, whose texts hold the template's own marks."""
    marks = f"{END}{START}assistant ok"
    probe = turns.sparkSession.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(marks).alias("text"))
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)


#: The same rows in DuckDB: digests of the turns, and the windows' length from the same prefix sums.
ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{END}{START}assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '{END}{START}assistant ok'
), a AS (
  SELECT *, row_number() OVER c AS i, CAST(ceil(strlen(text) / 4) AS BIGINT) + 4 AS k, sum(CAST(ceil(strlen(text) / 4) AS BIGINT) + 4) OVER c AS e,
    length(role) + length(regexp_replace(text, '<(\\\\*)\\|', '<\\1\\\\|', 'g')) + {len(START) + len(END) + 2} AS n
  FROM t WINDOW c AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
), b AS (
  SELECT *, sum(CASE WHEN k > {STRIDE} THEN 1 ELSE 0 END) OVER c AS longs, max(CASE WHEN k > {STRIDE} THEN e END) OVER c AS last
  FROM a WINDOW c AS (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING)
), g AS (SELECT *, CASE WHEN k > {STRIDE} THEN 2 * longs - 1 ELSE 2 * longs END AS island, CASE WHEN k > {STRIDE} THEN 0 ELSE (e - coalesce(last, 0) - 1) // {STRIDE} END AS slot FROM b
), o AS (SELECT *, min(i) OVER (PARTITION BY conv_id, island, slot) AS first, sum(k) OVER (PARTITION BY conv_id, island, slot) AS f FROM g
), s AS (
  SELECT DISTINCT o.conv_id, o.first, o.f, p.e AS before, coalesce(y.k, 0) AS sys FROM o JOIN o p ON p.conv_id = o.conv_id AND p.i = o.first - 1
  LEFT JOIN o y ON y.conv_id = o.conv_id AND y.i = 1 AND y.role = 'system'
), r AS (
  SELECT s.conv_id, sum(o.n) AS n FROM s JOIN o ON o.conv_id = s.conv_id AND o.i < s.first
  WHERE CASE WHEN o.i = 1 AND o.role = 'system' THEN s.f + s.sys <= {BUDGET} ELSE o.i >= s.first - {HISTORY} AND s.f + CASE WHEN s.f + s.sys <= {BUDGET} THEN s.sys ELSE 0 END + s.before - o.e + o.k <= {BUDGET} END GROUP BY ALL
)
SELECT o.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(o.n) + coalesce(any_value(r.n), 0) AS BIGINT) AS formatted_chars
FROM o LEFT JOIN r USING (conv_id) GROUP BY o.conv_id
"""
