"""Distinct counts that are kept up to date (A1, V1): one HyperLogLog sketch of
customers and one of sessions by day and type. Sketches merge, so a load adds
to its days without reading the events of earlier loads again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.operators.validate import processed_filter
from shoptrail.session import table_exists

LG_K = 12  # 4096 registers: a standard error of 1.04 / sqrt(4096) = 1.6 %
STANDARD_ERROR = 1.04 / 64
_KEYS = ["event_date", "event_type"]
_SKETCHES = ["customers", "sessions"]


def day_sketches(raw: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """event_date, event_type, event_count and a sketch of the customers and
    of the sessions (NULLs are not counted)."""
    rows = processed_filter(raw, S.PROCESSED_TYPES).withColumn("event_date", F.to_date("timestamp"))
    return rows.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("event_count"), F.hll_sketch_agg("customer_id", lg_k).alias("customers"),
                                    F.hll_sketch_agg("session_id", lg_k).alias("sessions"))


def merged(sketches: DataFrame) -> DataFrame:
    """One row a day and type: counts added up, sketches united."""
    return sketches.groupBy(*_KEYS).agg(F.sum("event_count").alias("event_count"),
                                        *[F.hll_union_agg(c).alias(c) for c in _SKETCHES])


def estimates(sketches: DataFrame) -> DataFrame:
    """V1 from sketches. A united sketch is estimated from its registers
    alone, so the number does not depend on how many loads it came in."""
    one = {f"unique_{c}": F.hll_sketch_estimate(F.hll_union(c, c)) for c in _SKETCHES}
    return sketches.select(*_KEYS, "event_count", *[e.alias(n) for n, e in one.items()])


def add_load(spark: SparkSession, path: str, load_id: str, raw: DataFrame) -> None:
    """Keeps a load's sketches under its id; loading the same id again
    replaces them, so a repeated load counts once."""
    day_sketches(raw).write.mode("overwrite").parquet(f"{path}/load_id={load_id}")


def compact(spark: SparkSession, path: str, into: str) -> None:
    """Unites all loads of ``path`` into one row a day and type."""
    merged(spark.read.parquet(path)).write.mode("overwrite").parquet(f"{into}/load_id=compacted")


def read(spark: SparkSession, path: str) -> DataFrame:
    """V1 over all loads kept under ``path``."""
    if not table_exists(spark, path):
        raise FileNotFoundError(path)
    return estimates(merged(spark.read.parquet(path)))
