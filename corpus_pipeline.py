"""A training corpus from raw documents: quality, near-duplicates, repeated passages, personal data, packed sequences.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from adlark.llm.neardup import keep_one
from adlark.llm.packing import pack
from adlark.llm.pii import pseudonymise
from adlark.llm.quality import resample
from adlark.llm.queries import PSEUDONYM_KEY
from adlark.llm.repeats import without_repeats
from adlark.llm.runtime import stored, table

#: Words of the shortest repeated passage that goes.
PASSAGE = 51


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return resample(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of over 50 words, or of 400 bytes, that occur elsewhere too."""
    return without_repeats(docs, words=PASSAGE)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal numbers, dates and addresses."""
    return pseudonymise(docs, PSEUDONYM_KEY, count=None)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats), ("personal_data", personal_data), ("packing", packing)]

#: Hashing, keyed permutations and merges of tokens have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")[0]
    return docs
