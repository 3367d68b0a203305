"""Flat numpy views of many texts at once: symbols, words, rolling names, sliding minima.

Every function works on the UTF-8 bytes of a block of documents laid end to
end, so a Python worker does a fixed number of array passes per block and
never a loop per word.  A name is a 64-bit hash of a span; equal spans always
have equal names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text handled at once; longer documents come alone.
BLOCK = 1 << 18
#: Words of more bytes are named by a cryptographic hash.
LONG = 64

_rng = np.random.Generator(np.random.PCG64(20240117))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_STEP = 0x9E3779B97F4A7C15 & ~7 | 3  # odd, and 3 modulo 8: few powers agree in their low bits
_STEP_INV = pow(_STEP, -1, 1 << 64)
_powers = {_STEP: np.ones(1, U), _STEP_INV: np.ones(1, U)}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words of `[^\x20\x09-\x0D]+`.
BLANK_WORDS = np.ones(256, bool)
BLANK_WORDS[[0x20, *range(0x09, 0x0E)]] = False
#: Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`: digits, lower-case letters, all beyond ASCII.
ALNUM_WORDS = np.zeros(256, bool)
ALNUM_WORDS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def powers(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        _powers[base] = np.concatenate([np.ones(1, U), np.multiply.accumulate(np.full(max(n, BLOCK + 4096), base, U))])
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about `limit` bytes of text each (null: empty), and those texts in UTF-8."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        texts = [x or b"" for x in column.cast(pa.binary()).to_pylist()]
        begin, size = 0, 0
        for i, x in enumerate(texts):
            if size and size + len(x) > limit:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, size = i, 0
            size += len(x) + 1
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, a line feed before each text and after the last, and where each text begins."""
    buf = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    return buf, np.cumsum([1] + [len(x) + 1 for x in texts])


def prefix(symbols: np.ndarray) -> np.ndarray:
    """Weighted prefix sums from which spans() names any span."""
    out = np.zeros(len(symbols) + 1, U)
    np.cumsum(symbols * powers(_STEP, len(symbols)), out=out[1:])
    return out


def spans(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Names of the spans [begin, end)."""
    return (sums[end] - sums[begin]) * powers(_STEP_INV, len(sums))[begin]


def grams(sums: np.ndarray, k: int) -> np.ndarray:
    """Names of all spans of k symbols, by their begin."""
    n = max(0, len(sums) - k)
    out = sums[k : k + n] - sums[:n]
    out *= powers(_STEP_INV, len(sums))[:n]
    out ^= out >> U(32)
    out *= U(0xD6E8FEB86659FD93)
    return out


def words(texts: list[bytes], kind: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, word begins, word ends, word names, and for each text the number of words before it (one more at the end)."""
    buf, at = joined(texts)
    if lower:
        buf = LOWER[buf]
    inside = kind[buf]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begin, end = edge[::2], edge[1::2]
    names = mix(spans(prefix(_BYTE[buf]), begin, end))
    # sums modulo 2^64 tell long words of few letters apart badly, so those are hashed by themselves
    for i in np.flatnonzero(end - begin > LONG).tolist():
        names[i] = int.from_bytes(hashlib.blake2b(buf[begin[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return buf, begin, end, names, np.searchsorted(begin, at)


def byte_symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A symbol for each byte, and where each text begins (one more at the end); texts follow each other without a gap."""
    return _BYTE[np.frombuffer(b"".join(texts), np.uint8)], np.cumsum([0] + [len(x) for x in texts])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours, by the first of them."""
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    if rest := w - span:
        x = np.minimum(x[:-rest], x[rest:])
    return x


def minimizers(names: np.ndarray, w: int) -> np.ndarray:
    """For each w neighbouring names, by the first of them, the position of the least, the leftmost of equals.

    Equal runs of names choose the same place.  Positions take the low 28 bits
    of the compared number, the name's high bits the rest.
    """
    if len(names) < w:
        return np.zeros(0, np.int64)
    low = U((1 << 28) - 1)
    keyed = names & ~low
    keyed |= np.arange(len(names), dtype=U)
    out = sliding_min(keyed, w)
    out &= low
    return out.view(np.int64)
