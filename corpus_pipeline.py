"""A training-data pipeline over ``documents``: language ID, near-dedup,
secret scans, mixing to target weights, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and reread as the next stage's ``docs``; all but the last
return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.llm import language_id, mixing, near_dedup, packing, secrets
from shoptrail.llm.queries import MIX_WEIGHTS, owner_columns
from shoptrail.llm.tables import WORD, narrow, stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that the language models reject or that have no letter."""
    predict = language_id.fit(docs)
    found = docs.withColumn("_found", predict(F.col("text").cast("string")))
    return found.where("not _found.rejected and _found.lang_pred <> 'und'").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near-duplicates."""
    gone = stage(near_dedup.near_duplicates(docs).where("not kept").select("doc_id").distinct(), "near-duplicates")
    return docs.join(narrow(gone), "doc_id", "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks values that few owners hold; widely copied examples stay."""
    owner, repository = owner_columns()
    return _recounted(secrets.redact(docs, owner, repository), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents to the target weights; a document taken in two epochs
    comes twice, the last one of a leaf is cut to its budget."""
    taken = mixing.mix(docs, weights=MIX_WEIGHTS, keep=docs.columns)
    words = F.regexp_extract_all(F.col("c_text"), F.lit(WORD), F.lit(0))
    cut = F.array_join(F.slice(words, F.lit(1), F.col("take_tokens").cast("int")), " ")
    text = F.when(F.col("take_tokens") < F.col("n_tokens"), cut).otherwise(F.col("c_text"))
    taken = taken.withColumn("c_text", text).select(*[F.col(f"c_{c}").alias(c) for c in docs.columns])
    return _recounted(taken, docs.columns)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


def _recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """n_chars follows the text."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*columns)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

# The first stage's models and the signatures of the second have no SQL form;
# tests/llm holds the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
