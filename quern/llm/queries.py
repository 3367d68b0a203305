"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quern.llm import chat, decontaminate, imatch, minhash, oracle, sentencepiece_bpe, substring_dedup, suffix_dedup, token_counts, token_files, toxicity
from quern.sources.tables import spread

#: Files of public tokenizers; the end-of-document id of the flat files.
PIECES, WORDS, END = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json"), 49407


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    read = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(read) if name in ("documents", "conversations") else read


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": lambda spark, at: minhash.groups(_table(spark, at, "documents"), percent=85),
    "op2_decontaminate": lambda spark, at: decontaminate.report(_table(spark, at, "documents"), _table(spark, at, "benchmark")),
    "op3_sentencepiece": lambda spark, at: sentencepiece_bpe.digest(_table(spark, at, "documents"), PIECES),
    "op4_toxicity": lambda spark, at: toxicity.report(_table(spark, at, "documents"), _table(spark, at, "labels")),
    "op5_substring_dedup": lambda spark, at: substring_dedup.digest(_table(spark, at, "documents")),
    "op6_chat": lambda spark, at: chat.digest(chat.windows(chat.with_probe(_table(spark, at, "conversations")))),
    "op7_token_files": lambda spark, at: token_files.listing(token_files.write(spark, _table(spark, at, "documents"), WORDS)),
    "op8_imatch": lambda spark, at: imatch.report(_table(spark, at, "documents")),
    "op9_token_counts": lambda spark, at: token_counts.counts(_table(spark, at, "documents"), WORDS, END),
    "op10_suffix_dedup": lambda spark, at: suffix_dedup.digest(_table(spark, at, "documents")),
}

ORACLE: dict[str, str] = {
    "op1_minhash": oracle.MINHASH,
    "op2_decontaminate": oracle.DECONTAMINATE,
    "op5_substring_dedup": oracle.SUBSTRING,
    "op6_chat": chat.ORACLE,
    "op10_suffix_dedup": oracle.SUFFIX,
}
