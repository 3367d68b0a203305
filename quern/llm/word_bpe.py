"""Ids of whole texts from a tokenizers file whose words never cross ASCII white space, with the words seen remembered."""

from __future__ import annotations

import os
from functools import cache

import numpy as np

#: Bytes that a worker remembers words in, twice: those of late, and those before; and what a word costs beside its letters.
REMEMBERED, COST = 96 << 20, 160
#: Punctuation that parts from a word before it.
TAIL = b".,;:!?"


class WordEncoder:
    """encode() gives each text's ids as little-endian integers of `kind`; special_as_text: the special tokens' strings in a text are ordinary text.

    A word that wasn't seen is first brought to a form that has the same ids: in
    lower case, if it is ASCII, and without the punctuation behind an ASCII letter
    or digit, which the tokenizer parts from it anyway.  Words of letters alone go
    to the library many at a time, and are told apart by the mark of a word's last
    piece; those of ASCII letters go to the merges alone.  A tokenizer for which
    this doesn't hold is refused, by many probes.
    """

    def __init__(self, path: str, special_as_text: bool, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # small ASCII letters need neither the normalizer nor the pattern that parts words
        self.light = Tokenizer(self.tokenizer.model)
        self.light.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.tokenizer.encode_special_tokens = special_as_text
        self.kind, self.known, self.before, self.size = kind, {}, {}, 0
        size = self.tokenizer.get_vocab_size()
        if size > np.iinfo(kind).max + 1:
            raise ValueError(f"ids don't fit {kind}")
        self.last = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        # the marks, cases and parts that the short ways rest on, and the vocabulary's own words
        ends = [f"{x}{t}{u}" for x in ("word", "WORD", "x9", "É", "it's", "don'T", "99", "ab-c", "_") for t in TAIL.decode() for u in ("", *TAIL.decode())]
        known = [w for i in range(0, size, 7) if (w := (self.tokenizer.id_to_token(i) or "").removesuffix("</w>")).isascii() and w.isalpha()]
        probe = ["a.b 'c\td\n9é", "Word., WORD x9! é. it's.", " ".join(ends), " ".join(known), " ".join(known).title(), "".join(map(chr, range(33, 127)))]
        for text in probe:
            if self._ids([text]) != [b"".join(self._ids(text.split()))] or self.encode([text.encode()]) != self._ids([text]):
                raise ValueError("this tokenizer's words aren't parted by white space, or depend on case")
        self.known, self.size = {}, 0

    def _ids(self, words: list[str]) -> list[bytes]:
        return [np.array(x.ids, self.kind).tobytes() for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, plain: list[bytes], letters: list[bytes], other: list[bytes]) -> None:
        """Remembers the ids of words; plain: those of small ASCII letters alone; letters: those of any letters."""
        for words, tokenizer in ((plain, self.light), (letters, self.tokenizer)):
            for at in range(0, len(words), 1024):
                some = words[at : at + 1024]
                ids = np.array(tokenizer.encode_batch_fast([b"\n".join(some).decode()], add_special_tokens=False)[0].ids, self.kind)
                cut = (np.flatnonzero(self.last[ids]) + 1) * ids.itemsize
                if len(cut) != len(some):
                    other.extend(some)
                    continue
                raw, ends = ids.tobytes(), cut.tolist()
                self.known.update(zip(some, map(raw.__getitem__, map(slice, [0, *ends], ends)), strict=False))
        for at in range(0, len(other), 1024):
            some = other[at : at + 1024]
            self.known.update(zip(some, self._ids([w.decode() for w in some]), strict=True))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = [x.split() for x in texts]  # bytes split at ASCII white space alone
        if self.size > REMEMBERED:
            self.before, self.known, self.size = self.known, {}, 0
        known, before = self.known, self.before
        new = set().union(*split).difference(known)
        if before and new:
            again = [w for w in new if w in before]
            known.update(zip(again, map(before.__getitem__, again), strict=True))
            new.difference_update(again)
            self.size += sum(map(len, again)) + COST * len(again)
        if new:
            self.size += sum(map(len, new)) + COST * len(new)
            same, ended, plain, letters, other = [], [], set(), set(), set()
            for w in new:
                if w.isalpha():  # ASCII letters
                    form = w.lower()
                    if form != w:
                        same.append((w, form))
                    plain.add(form)
                    continue
                form = w.lower() if w.isascii() and b"<|" not in w else w
                core = form.rstrip(TAIL)
                if len(core) < len(form) and core[-1:].isalnum():
                    tail = form[len(core) :]
                    ended.append((w, core, tail))
                    other.add(tail)
                else:
                    core = form
                    if form != w:
                        same.append((w, form))
                (plain if core.isalpha() else letters if core.decode().isalpha() else other).add(core)
            self._learn(*(list(x.difference(known)) for x in (plain, letters, other)))
            for w, form in same:
                known[w] = known[form]
            for w, core, tail in ended:
                known[w] = known[core] + known[tail]
        get = known.__getitem__
        return [b"".join(map(get, words)) for words in split]


@cache
def word_encoder(path: str, special_as_text: bool, kind: str = "<u2") -> WordEncoder:
    return WordEncoder(path, special_as_text, kind)
