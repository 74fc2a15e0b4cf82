"""Landing: wire events -> RAW_EVENTS rows (R8, Q3-Q5, K3 store split)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.functions.events import issue_tags, parse_event_time


def to_raw_events(wire: DataFrame, as_of=None, source_file: str | None = None,
                  storage_split: bool = True) -> DataFrame:
    """Shape wire events as RAW_EVENTS.

    * ``timestamp``: parsed event time (UTC wall clock, NTZ);
    * ``event_data``: the payload JSON as received (kept as text so the
      table can be de-duplicated and unioned; parsed once at routing);
    * ``data_quality_issues``: JSON array of issue tags (``[]`` = none);
    * ``is_valid``: declared validity, NULL read as TRUE (Q3), and FALSE
      when any issue was tagged;
    * ``storage_type``: deterministic two-way store split on the event id
      (see ``store_of``), standing in for the random 50/50 fan-out.
    """
    cols = set(wire.columns)
    ts = (F.col("timestamp").cast("timestamp_ntz") if "timestamp" in cols
          else parse_event_time("event_timestamp"))
    payload = F.from_json(F.col("event_data"), S.PAYLOAD_SCHEMA)
    tags = issue_tags(customer_id="customer_id", session_id="session_id",
                      event_time=ts, amount="amount" if "amount" in cols else F.lit(None),
                      product_price=payload["product_price"], as_of=as_of)
    out = (wire
           .withColumn("_tags", tags)
           .select(
               "event_id", "event_type", "session_id", "customer_id",
               ts.alias("timestamp"),
               "event_data",
               F.to_json(F.col("_tags")).alias("data_quality_issues"),
               (F.coalesce(F.col("is_valid"), F.lit(True)) & (F.size("_tags") == 0)).alias("is_valid"),
               (F.col("partition").cast("int") if "partition" in cols else F.lit(None).cast("int")).alias("partition_id"),
               (F.col("offset").cast("long") if "offset" in cols else F.lit(None).cast("long")).alias("offset_id"),
               (F.col("ingestion_time").cast("timestamp_ntz") if "ingestion_time" in cols
                else F.current_timestamp().cast("timestamp_ntz")).alias("ingestion_time"),
               (F.lit(source_file) if source_file else
                (F.col("source") if "source" in cols else F.lit(None).cast("string"))).alias("source_file"),
               (store_of("event_id") if storage_split else F.lit(None).cast("string")).alias("storage_type"),
               F.lit(None).cast("string").alias("etl_run_id"),
               F.lit(None).cast("timestamp_ntz").alias("etl_timestamp"),
           ))
    return out


def store_of(event_id="event_id") -> "F.Column":
    """K3 split: 'parquet' or 'duckdb' by the parity of the last hex digit of
    md5(event_id) -- deterministic, balanced, and reproducible in any SQL
    engine that has md5 (so replays land in the same store)."""
    digit = F.conv(F.substring(F.md5(F.col(event_id).cast("string")), 32, 1), 16, 10).cast("int")
    return F.when(digit % 2 == 0, F.lit("parquet")).otherwise(F.lit("duckdb"))


def pack_event(df: DataFrame, exclude: tuple = (), keep_nulls: bool = False) -> DataFrame:
    """The whole row as one JSON document in ``event_data``.
    ``keep_nulls`` writes NULL fields as ``null`` instead of omitting them
    (the staged bulk copy keeps them)."""
    keep = [c for c in df.columns if c not in exclude]
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return df.withColumn("event_data", F.to_json(F.struct(*keep), opts))
