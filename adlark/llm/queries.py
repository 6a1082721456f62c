"""The registered queries of this subpackage: one for each operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import stored, table
from .sql import oracle_sql  # noqa: F401

#: For tests; a deployment passes a key of its own.
PSEUDONYM_KEY = "adlark demonstration key"


def op1_anisotropic_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_prefix_free_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import PASSAGE, removed

    return removed(table(spark, sf_dir, "documents"), PASSAGE)


def op3_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_bit_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bitpack import read_index, write_shards

    return read_index(write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op10_log_bilinear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm import score

    return score(table(spark, sf_dir, "documents"))


def op7_flac_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .flac import digests, store

    return digests(stored(store(table(spark, sf_dir, "documents")), "media", level=9)[0])


def op9_ranked_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op6_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import pseudonymise

    return pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op8_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score

    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()} | {"pipeline": corpus_pipeline.run}
