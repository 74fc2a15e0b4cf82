"""Batch and micro-batch writers (K2-K8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptrail.operators.land import store_of
from shoptrail.operators.validate import flatten


def write_routes(df: DataFrame, base: str, route_col: str = "category",
                 max_records_per_file: int = 1_000_000, mode: str = "append") -> None:
    """K2: Parquet files partitioned by route (raw / processed / failed),
    Snappy, at most ``max_records_per_file`` rows per file. Nested payloads
    are flattened to ``a_b`` columns (K4); arrays stay arrays."""
    (flatten(df).write.mode(mode).partitionBy(route_col)
        .option("maxRecordsPerFile", max_records_per_file)
        .option("compression", "snappy").parquet(base))


def fan_out(df: DataFrame, parquet_path: str, store_table: str, ingestion_time=None) -> None:
    """K3: each event goes to exactly one of two stores (deterministic split
    on the event id), stamped with ``storage_type`` and ``ingestion_time``.
    The batch is cached once so the two writes do not recompute it."""
    ts = F.current_timestamp().cast("timestamp_ntz") if ingestion_time is None else F.lit(ingestion_time)
    d = df.withColumn("storage_type", store_of("event_id")).withColumn("ingestion_time", ts).persist()
    try:
        flatten(d.filter(F.col("storage_type") == "parquet")).write.mode("append").parquet(parquet_path)
        d.filter(F.col("storage_type") == "duckdb").write.mode("append").saveAsTable(store_table)
    finally:
        d.unpersist()


def warehouse_ready(df: DataFrame) -> DataFrame:
    """K8: parse time text, JSON-encode nested values, upper-case names."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in ("timestamp", "start_time", "created_at") and isinstance(f.dataType, T.StringType):
            c = c.try_cast("timestamp").cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name.upper()))
    return df.select(*cols)


def silver_batch_writer(table_path: str, run_id: str | None = None):
    """K5: ``foreachBatch`` function appending the six-column silver shape.
    Each micro-batch is written under its batch id, so a retried batch
    replaces its own output instead of appending twice. Batch ids start anew
    with a new checkpoint: give each checkpoint its own ``run_id``, which keeps
    the earlier history in a folder of its own."""
    base = table_path if run_id is None else f"{table_path}/run_id={run_id}"
    from shoptrail.operators.validate import silver_projection

    def write(batch: DataFrame, batch_id: int) -> None:
        (silver_projection(batch).withColumn("BATCH_ID", F.lit(batch_id))
            .write.mode("overwrite").parquet(f"{base}/batch_id={batch_id}"))
    return write


def retention_filter(df: DataFrame, date_col: str, as_of, keep_days: int) -> DataFrame:
    """K7: rows older than ``keep_days`` before ``as_of`` (the ones to archive
    or drop); with a date-partitioned table this prunes to whole partitions."""
    cutoff = F.date_sub(F.lit(str(as_of)).cast("date"), keep_days)
    return df.filter(F.col(date_col) < cutoff)
