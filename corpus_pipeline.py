"""The corpus pipeline: toxic documents go, then near duplicates, repeated passages and benchmark leaks; the rest is encoded.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame that
is written as Parquet and read again as the next stage's docs.  All but the last
return the columns of documents, whatever other columns those have.

In every stage an empty table has an empty result; rows that share an id, or have
none, are documents of their own unless said otherwise; nulls in other columns
stay; texts may be of any length up to 2^28 bytes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import decontaminate, minhash, sentencepiece_bpe, suffix_dedup, toxicity
from quern.llm.store import Store

#: Texts are near duplicates from this Jaccard similarity on; op1's own query has a contract of 85.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold.  A null text has the score of no words; without labels nothing is toxic."""
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least id of each group of near duplicates, and all others that are in none.

    Null, empty and blank texts are in none.  Of rows that share the least id, the
    first in the table stays; rows without an id come after all others.
    """
    return minhash.first_of_each(docs, percent=NEAR_PERCENT)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 100 bytes that an earlier document, or an earlier place, also has.

    Earlier is of lesser id (none: first), then by place in the table.  A null text
    becomes empty.
    """
    return suffix_dedup.remove_repeats(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item; a null text shares none."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and whether the ids decode to the text; a null text is encoded as an empty one."""
    return sentencepiece_bpe.coded(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("toxicity", drop_toxic), ("near duplicates", drop_near_duplicates), ("repeated passages", cut_repeats), ("benchmark leaks", drop_leaks), ("encoding", encode)]

#: Learning, links and merges can't be put in SQL; the stages' tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, docs = Store(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs, last = store.keep(stage(spark, docs, sf_dir)), docs
        store.drop(last)
    return docs
