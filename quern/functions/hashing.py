"""Fingerprints, bands, slots and orders by hash, from built-in functions."""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import arrow
from quern.functions.text import WORD


def word_tokens(text: Column) -> Column:
    """Words of the lower-case text; the whole of it if it has none."""
    # one pattern, as a choice between two arrays would search the text again for each
    return F.regexp_extract_all(F.lower(text), F.lit(rf"{WORD}|\A[^{WORD[1:-2]}]*+\z"), F.lit(0))


def md5_votes(text: Column) -> Column:
    """What the text's words vote, in packed counters; nothing for a null text."""
    return arrow.md5_votes(F.when(text.isNotNull(), word_tokens(text)))


def simhash_md5(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, simhash, bits): 64-bit fingerprints by the votes of each word's md5, as decimal strings and as whole numbers.

    A text is counted where it is read, so counters are dealt out and neither
    words nor texts.
    """
    return simhash_of(docs.where(F.col(text).isNotNull()).select(id, md5_votes(F.col(text)).alias("votes")), id)


def simhash_of(votes: DataFrame, id: str) -> DataFrame:
    """(id, simhash, bits) of votes(id, votes): rows that share an id vote together; a tied vote sets the bit."""
    summed = votes.groupBy(id).agg(*(F.sum(F.col("votes")[i]).alias(f"v{i}") for i in range(33)))
    count = {"hi": lambda i: F.shiftright(F.col(f"v{32 - i}"), 32), "lo": lambda i: F.col(f"v{32 - i}").bitwiseAND((1 << 32) - 1)}
    word = lambda c: sum((F.when(count[c](i) * 2 >= F.col("v0"), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i in range(32)), F.lit(0).cast("bigint"))
    return summed.select(id, (word("hi").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(20,0)") + word("lo")).cast("decimal(20,0)").cast("string").alias("simhash"), F.shiftleft(word("hi"), 32).bitwiseOR(word("lo")).alias("bits"))


def unsigned(bits: Column) -> Column:
    """A fingerprint's 64 bits as a decimal string."""
    whole = bits.cast("decimal(20,0)")
    return F.when(bits < 0, whole + F.lit(str(1 << 64)).cast("decimal(20,0)")).otherwise(whole).cast("decimal(20,0)").cast("string")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def band_widths(bits: int, threshold: int) -> list[tuple[int, int]]:
    """Offset and width of threshold + 1 bands, of which two fingerprints within the threshold share one; the first bands take the remainder."""
    n = threshold + 1
    out, at = [], 0
    for i in range(n):
        width = bits // n + (i < bits % n)
        out.append((at, width))
        at += width
    return out


def bands(bits: Column, threshold: int = 3) -> Column:
    """Array of each band's value, of a fingerprint of 64 bits."""
    # a band of all 64 bits needs no mask
    return F.array(*(bits if width == 64 else F.shiftrightunsigned(bits, at).bitwiseAND((1 << width) - 1) for at, width in band_widths(64, threshold)))


def band_pairs(bits: Column, threshold: int = 3) -> Column:
    """Array of the values of each two of threshold + 2 bands, in the order of combinations(); fingerprints within the threshold share one at least."""
    cut = bands(bits, threshold + 1)
    # a band has 32 bits at most here
    return F.array(*(F.shiftleft(cut[i], width).bitwiseOR(cut[j]) for (i, _), (j, (_, width)) in combinations(enumerate(band_widths(64, threshold + 1)), 2)))


def first_shared(difference: Column, key: Column, threshold: int = 3) -> Column:
    """Whether the two bands of band_pairs()[key] are the first two without a difference, which is so for one key of a pair alone."""
    masks = [F.lit(((1 << width) - 1) << at if at + width < 64 else (((1 << width) - 1) << at) - (1 << 64)) for at, width in band_widths(64, threshold + 1)]
    out = F.lit(False)
    for n, (i, j) in enumerate(combinations(range(threshold + 2), 2)):
        others = [difference.bitwiseAND(masks[k]) != 0 for k in range(j) if k != i]
        out = F.when(key == n, reduce(and_, others, F.lit(True))).otherwise(out)
    return out


def slot(digest: Column, n: int) -> Column:
    """A hexadecimal digest, taken as one number, modulo n."""
    digits = F.filter(F.split(digest, ""), lambda c: c != "")
    return F.aggregate(digits, F.lit(0).cast("bigint"), lambda a, c: F.pmod(a * 16 + F.conv(c, 16, 10).cast("bigint"), F.lit(n)))


def shuffled(seed: int, key: Column) -> Column:
    """A fixed order by hash, in place of a seeded shuffle."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def byte_ids(text: Column, vocabulary: int = 259) -> Column:
    """Ids 1 + byte modulo (vocabulary - 2); vocabulary - 1 ends a text."""
    # cut once, outside of the function of a byte, which would read the text again for each
    pairs = F.regexp_extract_all(F.hex(F.encode(text, "utf-8")), F.lit("(..)"), F.lit(1))
    return F.transform(pairs, lambda p: (F.conv(p, 16, 10).cast("int") % (vocabulary - 2) + 1).cast("int"))


def byte_text(ids: Column, vocabulary: int = 259) -> Column:
    """The text of byte_ids(); 0 and the id that ends a text are passed over, and bytes that make no character become its replacement."""
    own = F.filter(ids, lambda i: (i > 0) & (i < vocabulary - 1))
    pairs = F.transform(own, lambda i: F.lpad(F.hex((i - 1).cast("bigint")), 2, "0"))
    return F.decode(F.unhex(F.array_join(pairs, "")), "utf-8")
