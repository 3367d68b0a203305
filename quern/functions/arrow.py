"""What Spark has no built-in function for, or none without a row a word, over Arrow batches: NFKC, votes of fingerprints, HTML text."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf, pandas_udf
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

#: Elements whose text doesn't count, elements without an end, and words of a fingerprint.
DROPPED = {"script", "style", "noscript", "nav", "footer", "header", "aside", "form"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
WORDS = re.compile(r"[\w一-鿿]+")
#: Words that are counted at once: a text may be one batch of many times as many.
PIECE = 1 << 16


@pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: x if x is None else unicodedata.normalize("NFKC", x))


def nfkc(text: Column) -> Column:
    """Compatibility composition; texts of ASCII alone are left to the JVM."""
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(_nfkc(text))


@arrow_udf(ArrayType(LongType()))
def md5_votes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Of each array of words: their number, and 32 counters of how many words' md5 sets a bit.

    Counter 1 + k has bit 31 - k of the second four bytes in its low half and of
    the first four in its high half, so counters can be added up.
    """
    import numpy as np

    seen: dict[str, bytes] = {}

    def digest(word: str) -> bytes:
        if (raw := seen.get(word)) is None:
            if len(seen) > 100_000:
                seen.clear()
            raw = seen[word] = hashlib.md5(word.encode()).digest()[:8]
        return raw

    for words in batches:
        lengths, flat = words.value_lengths().fill_null(0).to_numpy().astype(np.int64), words.flatten()
        ends = np.cumsum(lengths)
        starts = ends - lengths
        counts = np.zeros((len(words), 64), np.int64)
        for at in range(0, len(flat), PIECE):
            piece = flat.slice(at, PIECE).dictionary_encode()
            digests = np.frombuffer(b"".join(map(digest, piece.dictionary.to_pylist())), np.uint8).reshape(-1, 8)
            bits = np.unpackbits(digests[piece.indices.to_numpy()], axis=1)
            for row in range(np.searchsorted(ends, at, "right"), np.searchsorted(starts, at + len(piece), "left")):
                counts[row] += bits[max(0, starts[row] - at) : ends[row] - at].sum(axis=0, dtype=np.int32)
        packed = np.column_stack([lengths, (counts[:, :32] << 32) + counts[:, 32:]])
        yield pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1, dtype=np.int32) * 33), pa.array(packed.ravel()))


@pandas_udf(StringType())
def simhash_blake2b(texts: pd.Series) -> pd.Series:
    """64-bit fingerprints by the votes of each word's blake2b, with multiplicity, as decimal strings; a tied vote sets the bit."""
    import numpy as np

    seen: dict[str, np.ndarray] = {}

    def votes(word: str) -> np.ndarray:
        if word not in seen:
            if len(seen) > 100_000:
                seen.clear()
            raw = np.frombuffer(hashlib.blake2b(word.encode(), digest_size=8).digest(), np.uint8)
            seen[word] = np.unpackbits(raw).astype(np.int32) * 2 - 1  # highest bit first
        return seen[word]

    def one(text: str | None) -> str:
        low = (text or "").lower()
        total = np.sum([votes(w) for w in WORDS.findall(low) or [low]], axis=0)
        return str(int("".join("1" if v >= 0 else "0" for v in total), 2))

    return texts.map(one)


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open, self.in_title, self.title, self.parts = [], False, [], []

    def handle_starttag(self, tag, attrs):
        if tag not in VOID:
            self.open.append(tag)
        self.in_title |= tag == "title"

    def handle_endtag(self, tag):
        # an end closes what was left open within; one that closes nothing is passed over
        if tag in self.open:
            while self.open.pop() != tag:
                pass
        if tag == "title":
            self.in_title = False

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        if DROPPED.isdisjoint(self.open):
            self.parts.append(data)


@pandas_udf(StructType([StructField("title", StringType()), StructField("text", StringType())]))
def html_text(pages: pd.Series) -> pd.DataFrame:
    """Title, and all text outside scripts, styles, navigation, headers, footers, asides and forms; null: both empty."""
    out = []
    for page in pages:
        parser = _Text()
        parser.feed(page or "")
        parser.close()
        out.append(("".join(parser.title).strip(), "".join(parser.parts).strip()))
    return pd.DataFrame(out, columns=["title", "text"])
