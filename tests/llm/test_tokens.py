import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quern.llm import sentencepiece_bpe, token_counts, token_files, word_bpe
from quern.llm.perfect_hash import PerfectHash

PIECES, WORDS = P.path("piece_bpe_32k.model"), P.path("word_bpe_49k.json")


def texts(seed, n=60):
    rng = random.Random(seed)
    kinds = ["abc the of ing tion", "éèüß ñ", "漢字かな", "\U0001f600́​", " \n\t\r", "▁ ", "0123", "aAbB", "<s>", "<|endoftext|>", "'s't", "\x00\x01\x1c\x85\xa0", "İﬁ"]
    out = ["", " ", "  ", "a", " a", "▁", "▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁", "a" * 700, "ab" * 400, " " * 300, "<0x41>", "�", "the<|endoftext|>cat <|startoftext|>", "xyz" * 200 + " the"]
    for _ in range(n):
        out.append("".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(1, 200))))
    return out


def test_pieces_equal_the_library():
    ours, library = sentencepiece_bpe.Model(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for seed in (1, 2):
        some = texts(seed, 300)
        for text, ids in zip(some, ours.encode(some), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True), repr(text)
            assert ours.decode([np.frombuffer(ids, "<u4")])[0] == library.decode(np.frombuffer(ids, "<u4").tolist())
    rng = random.Random(3)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), 1, 0, 259]) for _ in range(rng.randint(0, 12))]
        assert ours.decode([np.array(ids, np.int64)])[0] == library.decode(ids), ids


def test_pieces_query(spark):
    docs = [*enumerate(texts(4)), (1000, None), (1000, None), (None, "x y")]
    table = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id bigint, text string, ids int")
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = []
    for key, text in docs:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((str(key), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:]) for r in sentencepiece_bpe.digest(table, PIECES).collect()) == sorted(want)
    back = sentencepiece_bpe.decode(sentencepiece_bpe.encode(table, PIECES), PIECES)
    assert sorted((str(r[0]), r[1]) for r in back.collect()) == sorted((str(k), library.decode(library.encode(t or ""))) for k, t in docs)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 62, n, dtype=np.uint64))
    found = PerfectHash.build(keys).find(keys)
    assert sorted(found.tolist()) == list(range(len(keys)))


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_IDS", 500)
    docs = [(5 * i - 100, t) for i, t in enumerate([*texts(5), 'a "quoted" word', '"'])] + [(7, None), (None, "no key"), (None, None), (12, "twice"), (12, "twice"), (12, 'twice "')]
    table = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id bigint, text string, part string")
    library, total, want = Tokenizer.from_file(WORDS), 0, []
    for key, text in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode())):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((key, total, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        total += len(ids)
    written = token_files.write(spark, table, WORDS)
    assert sorted(map(tuple, token_files.listing(written).collect()), key=lambda r: r[1]) == want
    some = {r[0]: r[1] for r in token_files.lookup(written, [docs[3][0], docs[20][0], 999_999]).collect()}
    assert some == {k: [*library.encode(t, add_special_tokens=False).ids, 1] for k, t in (docs[3], docs[20])}


def test_words_equal_the_library_while_it_forgets(monkeypatch):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgéßÉXYZ漢0'") for _ in range(rng.randint(1, 8))) + rng.choice(["", "", ".", "!?", ",", "'s", "-"])
    some = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(400)] + texts(10)
    library = Tokenizer.from_file(WORDS)
    for held in (2000, 96 << 20):
        monkeypatch.setattr(word_bpe, "REMEMBERED", held)
        ours = word_bpe.WordEncoder(WORDS, False, "<u2")
        got = [x for at in range(0, len(some), 20) for x in ours.encode([t.encode() for t in some[at : at + 20]])]
        for text, ids in zip(some, got, strict=True):
            assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_very_long_texts(spark):
    long = "Wörd " * 150_000 + "a" * 40_000
    table = spark.createDataFrame([(1, long), (2, "x")], "doc_id bigint, text string")
    ids = [*Tokenizer.from_file(WORDS).encode(long, add_special_tokens=False).ids, 1]
    got = sorted(map(tuple, token_files.listing(token_files.write(spark, table, WORDS)).collect()))
    assert got[0] == (1, 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) and got[1][1] == len(ids)
    assert sorted(map(tuple, token_counts.counts(table, WORDS, 49407).collect())) == [(1, len(ids) - 1), (2, 1)]
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert {r.doc_id: r.n_tokens for r in sentencepiece_bpe.digest(table, PIECES).collect()}[1] == len(pieces.encode(long, add_bos=True, add_eos=True))


def test_lookup_reads_the_shards_that_can_have_the_key(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_IDS", 50)
    docs = [(i, f"text number {i} " * 5) for i in range(200)]
    written = token_files.write(spark, spark.createDataFrame(docs, "doc_id bigint, text string"), WORDS)
    assert written.count() > 20
    assert {r.doc_id for r in token_files.lookup(written, [17, 120, 5000]).collect()} == {17, 120} and token_files.lookup(written, []).collect() == []
    assert len(token_files.lookup(written, list(range(-10, 190))).collect()) == 190
    plan = token_files.lookup(written, [17])._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(low,17)" in plan and "GreaterThanOrEqual(high,17)" in plan


@pytest.mark.parametrize("block_ids", [7, 100_000])
def test_counts(spark, block_ids):
    docs = [*enumerate(texts(6)), (500, None), (501, "x"), (501, "x")]
    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    table = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id bigint, text string, n int").repartition(3)
    got = token_counts.counts(table, WORDS, 49407, block_ids=block_ids).collect()
    assert sorted(map(tuple, got)) == sorted((k, len(library.encode(t or "", add_special_tokens=False).ids)) for k, t in docs)


def test_empty_tables(spark):
    table = spark.createDataFrame([], "doc_id bigint, text string")
    assert sentencepiece_bpe.digest(table, PIECES).collect() == [] and token_counts.counts(table, WORDS, 49407).collect() == []
    assert token_files.listing(token_files.write(spark, table, WORDS)).collect() == []
