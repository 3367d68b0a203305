"""Tokenizers as columns: bytes from built-in functions, model files over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from quern.functions.hashing import byte_ids

#: Special tokens that a tokenizer is inspected for.
SPECIAL = ["<bos>", "<eos>", "<pad>", "<unk>", "<eot>", "<|endoftext|>", "<s>", "</s>"]


@cache
def loaded(path: str):
    """(encode, decode, vocabulary size, id of a token) of a model file, once a worker."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return sp.encode, sp.decode, sp.get_piece_size(), lambda t: sp.piece_to_id(t) if sp.id_to_piece(sp.piece_to_id(t)) == t else None
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return lambda x: t.encode(x, add_special_tokens=False).ids, t.decode, t.get_vocab_size(), t.token_to_id


def ids(path: str | None, fallback: bool = False) -> Callable[[Column], Column]:
    """A function from texts to ids.  No path, or with `fallback` a missing file, gives bytes; otherwise a missing file is an error."""
    if path is None or (fallback and not Path(path).exists()):
        return byte_ids
    if not Path(path).exists():
        raise FileNotFoundError(path)

    @F.pandas_udf(ArrayType(IntegerType()))
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = loaded(path)[0]
        for part in parts:
            yield part.map(lambda x: None if x is None else run(x))

    return encode


def text(path: str) -> Callable[[Column], Column]:
    @F.pandas_udf(StringType())
    def decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = loaded(path)[1]
        for part in parts:
            yield part.map(lambda x: None if x is None else run([int(i) for i in x]))

    return decode


def special_ids(path: str) -> dict[str, int | None]:
    return {t: loaded(path)[3](t) for t in SPECIAL}


def inspected(docs: DataFrame, text: str, by: str, encode: Callable[[Column], Column], most_per_group: int | None = None, order: str = "doc_id") -> DataFrame:
    """Records, characters, tokens, their ratios and abnormal texts (no ids, or more than max(32, 4 a character)) per group."""
    if most_per_group is not None:
        from quern.operators.tokens import first_of_each

        docs = first_of_each(docs, by, order, most_per_group)
    t = docs.select(by, F.length(text).alias("c"), F.size(encode(F.col(text))).alias("n"))
    odd = (F.col("n") <= 0) | (F.col("n") > F.greatest(F.lit(32), 4 * F.col("c")))
    return t.groupBy(by).agg(F.count(F.lit(1)).alias("records"), F.sum("c").cast("bigint").alias("chars"), F.sum("n").cast("bigint").alias("tokens"), F.round(F.sum("n") / F.greatest(F.lit(1), F.sum("c")), 6).alias("tokens_per_char"), F.count_if(odd).alias("abnormal"))
