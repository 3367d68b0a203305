"""Document fingerprints by I-Match, by DataFrame functions alone.

A term is a lower-case word.  Terms stay whose inverse document frequency lies in
a band: words in nearly every document tell nothing, and a word of few documents
is hardly ever shared.  Both edges are shares of the documents, so the terms of
the band, the lexicon, are at most as many as a document has terms on average,
divided by the lower share, however large the corpus is; it goes to every task as
a bitmap that a term's two hashes must both be in.  A term outside of the band
passes that by chance once in 200, or less, and then in every text alike.

Of the lexicon, randomised subsets are drawn at several sizes: at each of LEVELS
levels a hash of its own deals the terms into SUBSETS of them, a level's
LEVEL_BITS halvings smaller than those before, so that long texts have few terms
in some; subsets of different levels overlap at random.  The distinct terms of a
document that fall into a subset are sorted and hashed, and the fingerprint is
these hashes in order.  A document whose terms change a little keeps most of them,
one that loses half of them keeps some of the small ones; the likeness of two
fingerprints is the share of the subsets that either has terms in, where they
agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.prefix import bucket, cuts

SUBSET_BITS = 5
SUBSETS = 1 << SUBSET_BITS
#: A subset of level i holds one of 2^(SUBSET_BITS + i * LEVEL_BITS) terms: 32, 256, 2048, 16384.
LEVELS, LEVEL_BITS = 4, 3
#: The band: a term's documents, at least, and its share of all documents, at least and at most.
LEAST_DOCS, LEAST_SHARE, MOST_SHARE = 2, 0.0002, 0.2
#: Bits of the lexicon's bitmap for each term, and the least and the most of them (as powers of two; the most are 2 MB).
BITS_EACH, LEAST_BITS, MOST_BITS = 32, 13, 24
#: Buckets of neighbouring ids, at most: as many rows of them are copied.
MOST_BUCKETS, BUCKET_DOCS = 4096, 2000


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-case words."""
    words = F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def _places(term: Column, bits: int) -> list[Column]:
    """A term's two places in a bitmap of 2^bits."""
    return [F.shiftrightunsigned(x, 64 - bits) for x in (term, F.xxhash64(term, F.lit(3)))]


def lexicon(docs: DataFrame, text: str = "text", least_docs: int = LEAST_DOCS, least_share: float = LEAST_SHARE, most_share: float = MOST_SHARE) -> bytes:
    """A bitmap of the terms whose inverse document frequency lies within the band, lowest bit first."""
    counted = docs.select(F.explode(terms(F.col(text))).alias("term")).groupBy("term").count()
    total = docs.count()
    least = max(min(least_docs, max(1, total)), least_share * total)
    held = counted.where((F.col("count") >= least) & (F.col("count") <= max(least_docs, most_share * total))).select("term")
    # no more than 1 / least_share times the mean number of a document's terms
    found = [x for (x,) in held.collect()]
    bits = min(MOST_BITS, max(LEAST_BITS, (BITS_EACH * len(found) - 1).bit_length()))
    out = bytearray(1 << bits - 3)
    places = docs.sparkSession.createDataFrame([(x,) for x in found], "term bigint").select(*(p.alias(f"p{i}") for i, p in enumerate(_places(F.col("term"), bits)))) if found else None
    for row in places.collect() if places is not None else []:
        for at in row:
            out[at >> 3] |= 1 << (at & 7)
    return bytes(out)


def _within(term: Column, held: Column, bits: int) -> Column:
    tests = []
    for at in _places(term, bits):
        byte = F.conv(F.hex(F.substring(held, F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        tests.append(F.getbit(byte, at.bitwiseAND(F.lit(7).cast("bigint")).cast("int")) == 1)
    return tests[0] & tests[1]


def subsets(text: Column, held: bytes) -> Column:
    """A map from the number of each subset that the text has terms in to their hash; a level's subsets follow the last one's."""
    bitmap, bits = F.lit(held), (8 * len(held)).bit_length() - 1
    within = F.filter(terms(text), lambda t: _within(t, bitmap, bits))
    # a transform over one element names the terms, so that they are found once
    return F.map_from_entries(F.flatten(F.element_at(F.transform(F.array(within), lambda t: F.array(*(_dealt(t, i) for i in range(LEVELS)))), 1)))


def _dealt(within: Column, level: int) -> Column:
    """(s, h) of each subset of the level that has some of the terms."""
    # each level has its own hash of a term, whose low bits say whether the level has the term; the top bits deal it into a
    # subset, so the sorted hashes hold each subset's terms side by side
    hashes = F.transform(within, lambda t: F.xxhash64(t, F.lit(8 + level)))
    number = lambda x: F.shiftrightunsigned(x, 64 - SUBSET_BITS).cast("int") + F.lit(level * SUBSETS)
    ordered = F.sort_array(F.filter(hashes, lambda x: x.bitwiseAND(F.lit((1 << level * LEVEL_BITS) - 1)) == 0))
    ordered = F.transform(ordered, lambda x: F.struct(number(x).alias("s"), x.alias("x")))
    zero = F.struct(F.lit(-1).alias("s"), F.lit(0).cast("bigint").alias("h"), F.array().cast("array<struct<s:int,h:bigint>>").alias("done"))
    done = lambda a: F.when(a["s"] >= 0, F.concat(a["done"], F.array(F.struct(a["s"].alias("s"), a["h"].alias("h"))))).otherwise(a["done"])
    same = lambda a, x: F.struct(a["s"].alias("s"), F.xxhash64(a["h"], x["x"]).alias("h"), a["done"].alias("done"))
    other = lambda a, x: F.struct(x["s"].alias("s"), F.xxhash64(x["x"]).alias("h"), done(a).alias("done"))
    step = lambda a, x: F.when(a["s"] == x["s"], same(a, x)).otherwise(other(a, x))
    return F.aggregate(ordered, zero, step, done)


def codes(text: Column, held: bytes) -> Column:
    """A number of 32 bits for each subset, 0 where the text has no term in it."""
    found = subsets(text, held)
    every = F.sequence(F.lit(0), F.lit(LEVELS * SUBSETS - 1))
    # a transform over one element names the map, so that it is made once
    return F.element_at(F.transform(F.array(found), lambda m: F.transform(every, lambda i: F.coalesce(F.pmod(F.element_at(m, i), F.lit(1 << 32)), F.lit(0)))), 1)


def digits(codes: Column) -> Column:
    """Eight hexadecimal digits for each subset."""
    return F.array_join(F.transform(codes, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def fingerprint(text: Column, held: bytes) -> Column:
    return digits(codes(text, held))


def likeness(a: Column, b: Column) -> Column:
    """The share of the subsets, of those where either has terms, in which two lists of codes agree; 1 where neither has any."""
    # 1 for a subset that either has terms in, and 2^16 more where they agree
    marks = F.zip_with(a, b, lambda x, y: F.when(x == y, F.when(x == 0, 0).otherwise((1 << 16) + 1)).otherwise(1))
    total = F.aggregate(marks, F.lit(0), lambda n, m: n + m)
    # a transform over one element names the sum, so that it is made once
    return F.element_at(F.transform(F.array(total), lambda n: F.when(n == 0, F.lit(1.0)).otherwise(F.shiftright(n, 16).cast("double") / (n.bitwiseAND(F.lit((1 << 16) - 1))))), 1)


def with_next(docs: DataFrame, id: str, text: str, name: str, made: Column) -> DataFrame:
    """docs(id, text) with `made` as the column `name`, and next_TEXT and next_NAME of the next document in descending id order (after the last: the first).

    Ids are cut into buckets of neighbours of about equal size, and each bucket is
    ordered by itself; where it ends, it sees a copy of the next bucket's first
    document: as many copies as there are buckets, and so bounded.  Rows that share
    an id go by a hash of the text; a null id comes last, and such rows are cut into
    buckets by that hash.
    """
    at = cuts(docs, id, BUCKET_DOCS, MOST_BUCKETS)
    nulls = max(1, min(MOST_BUCKETS, docs.where(F.col(id).isNull()).count() // BUCKET_DOCS))
    docs = docs.withColumn("hash", F.shiftrightunsigned(F.xxhash64(text), 1))
    # buckets of null ids have negative numbers, and descend as all others do
    by_hash = -1 - F.shiftright(F.shiftright("hash", 51) * nulls, 12).cast("int")
    docs = docs.withColumn("bucket", F.when(F.col(id).isNull(), by_hash).otherwise(bucket(F.col(id), at)))
    rank = F.struct(id, (-F.col("hash")).alias("h"))
    firsts = docs.groupBy("bucket").agg(F.max(rank).alias("top"))
    order = Window.orderBy(F.col("bucket").desc())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select(F.col("bucket").alias("b"), "top", F.coalesce(F.lag("bucket").over(order), F.min("bucket").over(whole)).alias("to"))  # a row a bucket
    copies = docs.join(F.broadcast(firsts), (F.col("bucket") == F.col("b")) & rank.eqNullSafe(F.col("top"))).select(id, "hash", text, F.col("to").alias("bucket"), F.lit(True).alias("copy"))
    every = docs.select(id, "hash", text, "bucket", F.lit(False).alias("copy")).unionByName(copies).withColumn(name, made)
    order = Window.partitionBy("bucket").orderBy("copy", F.col(id).desc_nulls_last(), "hash", text)
    return every.select(id, text, name, "copy", *(F.lead(c).over(order).alias(f"next_{c}") for c in (text, name))).where("not copy").drop("copy")


def report(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each document.

    A null text counts as empty; a text without terms has a fingerprint of zeros.
    """
    own = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    held = lexicon(own)
    both = with_next(own, "doc_id", "text", "codes", codes(F.col("text"), held))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    both = both.withColumn("edited", F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half)))
    both = both.select("doc_id", n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "codes", codes(F.col("edited"), held).alias("edited_codes"), "next_codes")
    return both.select(
        "doc_id", "n_chars", "edited_sha256", digits(F.col("codes")).alias("fingerprint"), digits(F.col("edited_codes")).alias("edited_fingerprint"),
        likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"), likeness(F.col("codes"), F.col("next_codes")).alias("near_next"),
    )
