"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

No piece of such a model continues past a word's end, so a text is a row of
independent words, each with the spaces before it.  The distinct words of a block
lie in one flat symbol array.  Each round finds every word's least pair rank (the
leftmost of equals) with one segmented minimum, merges all these pairs at once,
and compacts the array; words without a pair leave it.  Merging one pair a word
and round keeps the library's order even where a new piece outranks an old one.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.store import prepare
from quern.llm.vectors import blocks

SPACE = "▁"
WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Symbols from here on are characters that the vocabulary lacks.
FOREIGN = 1 << 20
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
#: Words longer than this are merged one by one, with a heap; distinct words remembered by a worker.
LONG, REMEMBERED = 256, 200_000
NONE = np.int64(1) << 40


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    i = 0

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            byte = data[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while i < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[i : i + size]
            i += size


class Model:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            whole = list(fields(f.read()))
        own = [dict(fields(v)) for k, v in whole if k == 1]
        trainer, norm = (dict(fields(next(v for k, v in whole if k == n))) for n in (2, 3))
        self.pieces = [x[1].decode() for x in own]
        score = [struct.unpack("<f", x[2])[0] if 2 in x else 0.0 for x in own]
        self.kind = np.array([x.get(3, NORMAL) for x in own])
        if norm.get(2) or norm.get(4, 1) or not norm.get(5, 1) or not norm.get(3, 1) or trainer.get(3) != 2 or not trainer.get(35) or USER in self.kind:
            raise ValueError("only BPE models with byte fallback, a dummy prefix and plain normalisation are handled")
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p, k in zip(self.pieces, self.kind, strict=True) if k == NORMAL):
            raise ValueError("a piece continues past a word's end")
        self.bos, self.eos, self.unk = trainer.get(41, 1), trainer.get(42, 2), trainer.get(40, 0)
        id_of = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kind, strict=True)) if k == NORMAL}
        self.char = np.arange(0x110000, dtype=np.int64) + FOREIGN
        for p, i in id_of.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        order = {s: r for r, s in enumerate(sorted({score[i] for i in id_of.values()}, reverse=True))}
        symbol = lambda p: id_of[p] if p in id_of else FOREIGN + ord(p) if len(p) == 1 else None
        merges = {}
        for p, i in id_of.items():
            for cut in range(1, len(p)):
                a, b = symbol(p[:cut]), symbol(p[cut:])
                if a is not None and b is not None:
                    merges[a << 22 | b] = order[score[i]] << 20 | i
        self.merges = merges
        self.keys = np.array(sorted(merges), np.int64)
        self.values = np.array([merges[k] for k in self.keys.tolist()], np.int64)
        self.bytes_of = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kind[i] == BYTE}
        text = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else p.replace(SPACE, " ").encode() for p, k in zip(self.pieces, self.kind, strict=True)]
        self.size = np.array([len(x) for x in text])
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(text), np.uint8)
        self.known: dict[str, bytes] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and piece (in the low 20 bits) of each pair; NONE where there is no such piece."""
        key = left << 22 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def final(self, symbols: np.ndarray) -> bytes:
        """Ids of one word's symbols as little-endian unsigned 32-bit integers."""
        if symbols.max(initial=0) < FOREIGN:
            return symbols.astype("<u4").tobytes()
        out: list[int] = []
        for s in symbols.tolist():
            out.extend([s] if s < FOREIGN else [self.bytes_of.get(b, self.unk) for b in chr(s - FOREIGN).encode()])
        return np.array(out, "<u4").tobytes()

    def merge_one(self, symbols: list[int]) -> np.ndarray:
        """The same merges for one long word, with a heap over linked symbols."""
        n, merges = len(symbols), self.merges
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int, int, int]] = []

        def push(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (m := merges.get(symbols[a] << 22 | symbols[b])) is not None:
                heapq.heappush(heap, (m >> 20, a, m & 0xFFFFF, symbols[a], symbols[b]))

        for i in range(n - 1):
            push(i, i + 1)
        while heap:
            _, a, piece, x, y = heapq.heappop(heap)
            b = right[a]
            if b < 0 or symbols[a] != x or symbols[b] != y:
                continue
            symbols[a], symbols[b] = piece, -1
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            push(left[a], a)
            push(a, right[a])
        return np.array([s for s in symbols if s >= 0], np.int64)

    def merge_all(self, words: list[str]) -> list[np.ndarray]:
        """The symbols that each word ends as."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        short = []
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self.merge_one(self.char[np.frombuffer(w.encode("utf-32-le"), np.uint32)].tolist())
            else:
                short.append(i)
        if not short:
            return out
        symbols = self.char[np.frombuffer("".join(words[i] for i in short).encode("utf-32-le"), np.uint32)]
        size, owner = np.array([len(words[i]) for i in short]), np.array(short)
        last = np.cumsum(size) - 1
        rank = np.append(self.ranks(symbols[:-1], symbols[1:]), NONE)
        rank[last] = NONE
        while len(size):
            first = np.cumsum(size) - size
            least = np.minimum.reduceat(rank >> 20 << 20 | np.arange(len(rank)) - np.repeat(first, size), first)
            active = least < NONE
            if not active.all():
                for a, n, i in zip(first[~active].tolist(), size[~active].tolist(), owner[~active].tolist(), strict=True):
                    out[i] = symbols[a : a + n].copy()
                stay = np.repeat(active, size)
                symbols, rank, size, owner, least = symbols[stay], rank[stay], size[active], owner[active], least[active]
                if not len(size):
                    break
                first = np.cumsum(size) - size
            at = first + (least & 0xFFFFF)
            symbols[at] = rank[at] & 0xFFFFF
            gone = np.ones(len(symbols), bool)
            gone[at + 1] = False
            symbols, rank, size = symbols[gone], rank[gone], size - 1
            at -= np.arange(len(at))  # one symbol went from each word before
            end = np.cumsum(size) - 1
            begin = end - size + 1
            inner = at < end
            rank[at[~inner]] = NONE
            rank[at[inner]] = self.ranks(symbols[at[inner]], symbols[at[inner] + 1])
            inner = at > begin
            rank[at[inner] - 1] = self.ranks(symbols[at[inner] - 1], symbols[at[inner]])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, begin and end included, as little-endian unsigned 32-bit integers."""
        split = [WORD.findall(SPACE + x.replace(" ", SPACE)) if x else [] for x in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        if new := list({w for words in split for w in words} - self.known.keys()):
            self.known |= zip(new, map(self.final, self.merge_all(new)), strict=True)
        bos, eos, known = self.bos.to_bytes(4, "little"), self.eos.to_bytes(4, "little"), self.known
        return [bos + b"".join([known[w] for w in words]) + eos for words in split]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """The text of each row of ids."""
        flat = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)
        size = self.size[flat]
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        data = self.flat[np.arange(total) + np.repeat(self.at[flat] - (end - size), size)].tobytes()
        edge = np.concatenate([[0], end])[np.cumsum([0] + [len(x) for x in ids])]
        out = []
        for row, a, b in zip(ids, edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            try:
                # control ids between bytes part them, and show as nothing
                text = self._repaired(row) if (self.kind[row[1:-1]] == CONTROL).any() else data[a:b].decode()
            except UnicodeDecodeError:
                text = self._repaired(row)
            start = next((i for i in row.tolist() if self.kind[i] != CONTROL), self.bos)
            out.append(text[1:] if self.kind[start] == NORMAL and self.pieces[start].startswith(SPACE) else text)
        return out

    def _repaired(self, row: np.ndarray) -> str:
        """Byte pieces next to each other that aren't UTF-8 become U+FFFD, each byte one."""
        out, run = [], b""
        for i in [*row.tolist(), -1]:
            if i >= 0 and self.kind[i] == BYTE:
                run += self.flat[self.at[i] : self.at[i] + 1].tobytes()
                continue
            while run:
                n = next((n for n in (1, 2, 3, 4) if _valid(run[:n])), 0)
                out.append(run[:n].decode() if n else "�")
                run = run[n or 1 :]
            if i >= 0:
                out.append(self.flat[self.at[i] : self.at[i] + self.size[i]].tobytes().decode())
        return "".join(out)


def _valid(x: bytes) -> bool:
    try:
        return len(x.decode()) == 1
    except UnicodeDecodeError:
        return False


@cache
def model(path: str) -> Model:
    return Model(path)


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids array<int>) of each text, with begin and end ids.  A null text counts as empty: two ids."""
    prepare(docs.sparkSession)
    key = docs.select(id).schema[0]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for rows, texts in blocks(batches, "__text"):
            ids = own.encode([x.decode() for x in texts])
            offsets = np.cumsum([0] + [len(x) // 4 for x in ids])
            flat = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)], [id, "ids"])

    return docs.select(docs[id], docs[text].alias("__text")).mapInArrow(run, f"`{id}` {key.dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, text) of each array of ids.  A null array counts as empty."""
    prepare(encoded.sparkSession)
    key = encoded.select(id).schema[0]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for whole in batches:
            for begin in range(0, whole.num_rows, 64):
                rows = whole.slice(begin, 64)
                own_ids = [np.zeros(0, np.int64) if x.values is None else x.values.to_numpy(zero_copy_only=False) for x in rows.column(1)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(own.decode(own_ids), pa.string())], [id, "text"])

    return encoded.select(encoded[id], encoded[ids].alias("__ids")).mapInArrow(run, f"`{id}` {key.dataType.simpleString()}, text string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded, then decoded from the ids, within one pass over the texts.

    A null or empty text has the begin and the end id, and decodes to nothing.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for rows, texts in blocks(batches):
            ids = own.encode([x.decode() for x in texts])
            back = own.decode([np.frombuffer(x, "<u4") for x in ids])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def coded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids array<int> and whether the ids decode to the text again, from one pass over the texts.

    A null text counts as empty.  A text that holds the space mark itself, or a
    character that decoding shows otherwise, does not come back.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for rows, texts in blocks(batches):
            plain = [x.decode() for x in texts]
            ids = own.encode(plain)
            back = own.decode([np.frombuffer(x, "<u4") for x in ids])
            n = np.array([len(x) // 4 for x in ids], np.int64)
            flat = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n), pa.ListArray.from_arrays(offsets, flat), pa.array([a == b for a, b in zip(plain, back, strict=True)])], ["doc_id", "n_tokens", "ids", "round_trip"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids array<int>, round_trip boolean")
