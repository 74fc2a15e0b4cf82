"""The registered queries of the operators over the driver's tables, each
over the whole ``documents`` table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.llm import (conversation_repair, fingerprints, jaccard_join, language_id, lexical_search, mixing, near_dedup,
                           oracles, outliers, packing, phrase_dedup, pitman_yor, secrets, sharding)

MIX_WEIGHTS = {"domain": {"d0": 5, "d1": 3, "d2": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def owner_columns():
    """A document's owner is its source; a repository is a language of it."""
    return F.col("source"), F.concat_ws("/", F.coalesce(F.col("source"), F.lit("~")), F.coalesce(F.col("lang"), F.lit("~")))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), weights=MIX_WEIGHTS)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op3_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup.remove_repeated_passages(documents(spark, sf_dir), with_text=False)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op6_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(documents(spark, sf_dir))


def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_texts(documents(spark, sf_dir))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir), *owner_columns())


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mixing, op2_language_id, op3_phrase_dedup, op4_fingerprints, op5_packing, op6_outliers,
                            op7_pitman_yor, op8_near_dedup, op9_secrets, op10_sharding, op11_conversation_repair, op12_lexical_search,
                            op13_jaccard_join)}

ORACLES: dict[str, str] = {
    "op3_phrase_dedup": oracles.phrase_dedup(), "op8_near_dedup": oracles.near_dedup(), "op9_secrets": oracles.secrets(),
    "op12_lexical_search": oracles.lexical_search(), "op13_jaccard_join": oracles.jaccard_join()}
