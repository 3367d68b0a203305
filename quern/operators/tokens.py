"""Tokens, packs and their way back, budgets, samples and mixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.prefix import running_total


def packed(tokens: DataFrame, seq_len: int, end: int, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(pack_id, input_ids, document_ids): all texts in id order, each closed by `end`, cut every seq_len ids; the partial tail goes.

    A text's place comes from a running total over buckets of ids; it is then cut
    where packs begin, so only a pack's own pieces ever meet.
    """
    closed = tokens.select(F.col(id).alias("doc"), F.concat(F.col(ids), F.array(F.lit(end))).alias("ids")).withColumn("n", F.size("ids").cast("bigint"))
    placed = running_total(closed, "doc", "n", "at")
    first, last = F.floor(F.col("at") / seq_len), F.floor((F.col("at") + F.col("n") - 1) / seq_len)
    pieces = placed.select("doc", "at", "n", "ids", F.explode(F.sequence(first, last)).alias("pack_id"))
    begin = F.greatest(F.col("at"), F.col("pack_id") * seq_len)
    stop = F.least(F.col("at") + F.col("n"), (F.col("pack_id") + 1) * seq_len)
    pieces = pieces.select("pack_id", "doc", begin.alias("begin"), F.slice("ids", (begin - F.col("at") + 1).cast("int"), (stop - begin).cast("int")).alias("part"))
    whole = pieces.groupBy("pack_id").agg(F.array_sort(F.collect_list(F.struct("begin", "doc", "part"))).alias("parts"))
    docs = F.flatten(F.transform("parts", lambda p: F.array_repeat(p["doc"], F.size(p["part"]))))
    return whole.select("pack_id", F.flatten(F.col("parts.part")).alias("input_ids"), docs.alias("document_ids")).where(F.size("input_ids") == seq_len)


def eval_packs(packs: DataFrame, batch: int) -> DataFrame:
    """Packs of whole batches; the partial last batch goes."""
    n = packs.agg(F.count(F.lit(1)).alias("n"))
    return packs.join(F.broadcast(n)).where(F.col("pack_id") < F.floor(F.col("n") / batch) * batch).drop("n")


def unpacked(packs: DataFrame, end: int) -> DataFrame:
    """(pack_id, doc, ids): each document's ids within a pack, without the end id; a document that has no others there is left out."""
    pairs = F.arrays_zip("document_ids", "input_ids")
    kept = F.filter(pairs, lambda p: p["input_ids"] != end)
    docs = packs.select("pack_id", kept.alias("kept"), F.explode(F.array_distinct("document_ids")).alias("doc"))
    own = docs.select("pack_id", "doc", F.transform(F.filter("kept", lambda p: p["document_ids"] == F.col("doc")), lambda p: p["input_ids"]).alias("ids"))
    return own.where(F.size("ids") > 0)


def block_mask(packs: DataFrame) -> DataFrame:
    """(pack_id, i, j): places that see each other: j no later than i, in the same document."""
    at = packs.select("pack_id", F.posexplode("document_ids").alias("i", "doc"))
    return at.join(at.withColumnRenamed("i", "j"), ["pack_id", "doc"]).where("j <= i").select("pack_id", "i", "j")


def floor_quantile(table: DataFrame, value: str, shares: list[float], by: list[str] | None = None) -> DataFrame:
    """Values at place min(n - 1, floor(share * n)) of the sorted, as p10 and so on.

    Places come from the counts of distinct values, so equal values are one row
    and only distinct values are ordered.
    """
    by = by or []
    counts = table.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy(*by)
    counts = counts.withColumn("n", F.sum("k").over(w)).withColumn("upto", F.sum("k").over(w.orderBy(value)))
    place = lambda q: F.least(F.col("n") - 1, F.floor(F.lit(q) * F.col("n")))
    return counts.groupBy(*by).agg(*(F.min(F.when(F.col("upto") > place(q), F.col(value))).alias(f"p{round(q * 100)}") for q in shares))


def within_budget(docs: DataFrame, key: Column, size: str, budgets: dict[str, int], total: int, domain: str) -> DataFrame:
    """docs that fit: in the order of key, while the running sum of their domain stays within its budget and that of all within the total."""
    ordered = docs.withColumn("__key", key)
    each = F.sum(size).over(Window.partitionBy(domain).orderBy("__key").rowsBetween(Window.unboundedPreceding, 0))
    limit = F.coalesce(*(F.when(F.col(domain) == d, F.lit(b)) for d, b in budgets.items()), F.lit(0))
    fits = ordered.withColumn("__sum", each).where(F.col("__sum") <= limit)
    # at most the sum of all domains' budgets is ever kept
    if sum(budgets.values()) > total:
        fits = fits.withColumn("__all", F.sum(size).over(Window.orderBy("__key").rowsBetween(Window.unboundedPreceding, 0))).where(F.col("__all") <= total).drop("__all")
    return fits.drop("__key", "__sum")


def first_of_each(docs: DataFrame, by: str, order: str, n: int) -> DataFrame:
    return docs.withColumn("__n", F.row_number().over(Window.partitionBy(by).orderBy(order))).where(F.col("__n") <= n).drop("__n")


def interleaved(docs: DataFrame, source: str, order: str, probabilities: dict[str, float]) -> DataFrame:
    """docs with turn: the time at which a source of probability p yields its k-th record, k / p; sources of no weight are left out."""
    p = F.coalesce(*(F.when(F.col(source) == s, F.lit(float(x))) for s, x in probabilities.items() if x > 0), F.lit(None).cast("double"))
    return docs.withColumn("__p", p).where("__p is not null").withColumn("turn", F.row_number().over(Window.partitionBy(source).orderBy(order)) / F.col("__p")).drop("__p")
