"""Registered queries of the repeatable loads: each runs its load over files
that Spark derives from the whole driver tables, most of them twice."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.operators import enrich, route
from shoptrail.plans import etl
from shoptrail.plans import oracles as O
from shoptrail.plans import pipeline as P
from shoptrail.plans.catalog import _stream_input, register
from shoptrail.session import scratch_path
from shoptrail.sinks import loads
from shoptrail.sources.fixtures import FIXTURE_NOW
from shoptrail.streaming import processor as X

ARRAY_ROWS = 5_000  # events in one JSON array file


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"loads/{name}-{uuid.uuid4().hex}")


@register("processing_metadata", O.q(f"""
SELECT event_id, {O.NOW} AS processed_timestamp, '{S.PROCESSOR_VERSION}' AS processor_version FROM raw
"""))
def processing_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processor's time and version on every event."""
    return enrich.enrich_events(P.wire_events(spark, sf_dir), FIXTURE_NOW).select("event_id", "processed_timestamp", "processor_version")


@register("two_store_fan_out", O.q(f"""
SELECT event_id, event_type, storage_type, {O.NOW} AS ingestion_time, storage_type AS found_in FROM raw
"""))
def two_store_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: a stream dealt to two stores, batch by batch; both read back."""
    stores = {"parquet": _folder(spark, "files"), "duckdb": _folder(spark, "store")}
    (X.file_events(spark, _stream_input(spark, sf_dir), max_files_per_trigger=2).writeStream
     .foreachBatch(loads.two_store_batches(stores["parquet"], stores["duckdb"], FIXTURE_NOW))
     .option("checkpointLocation", _folder(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination())
    sides = [spark.read.parquet(path).select("event_id", "event_type", "storage_type", "ingestion_time", F.lit(name).alias("found_in"))
             for name, path in stores.items()]
    return sides[0].unionByName(sides[1])


@register("bulk_append_report", O.q("""
SELECT event_type, COUNT(*) AS rows_loaded, TRUE AS success, COUNT(*) AS rows_in_table FROM rawv GROUP BY event_type
"""))
def bulk_append_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: files by event type loaded twice; the report of the first load
    beside what the table holds after both."""
    landed, table, manifest = (_folder(spark, x) for x in ("landed", "table", "manifest"))
    raw = P.raw_events(spark, sf_dir).select("event_id", "event_type", "timestamp", F.col("event_type").alias("folder"))
    raw.write.partitionBy("folder").parquet(landed)
    report = loads.bulk_append(spark, landed, table, manifest)
    loads.bulk_append(spark, landed, table, manifest)
    kind = F.regexp_extract("file", "folder=([^/]+)", 1)
    first = report.groupBy(kind.alias("event_type")).agg(F.sum("rows_loaded").alias("rows_loaded"), F.min("success").alias("success"))
    held = spark.read.parquet(table).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows_in_table"))
    return first.join(held, "event_type")


@register("staged_json_copy", O.q("""
SELECT event_id, event_type, customer_id, customer_id IS NULL AS null_kept, 1 AS copies FROM raw
"""))
def staged_json_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that each hold a JSON array, copied twice; an element's
    nulls stay in its text."""
    staged, table, manifest = (_folder(spark, x) for x in ("staged", "copied", "copied-files"))
    wire = P.wire_events(spark, sf_dir).select("event_id", "event_type", "session_id", "customer_id", F.col("event_timestamp").alias("timestamp"), "is_valid")
    n = max(1, -(-spark.read.parquet(f"{sf_dir}/events.parquet").count() // ARRAY_ROWS))
    element = F.to_json(F.struct(*wire.columns), {"ignoreNullFields": "false"})
    arrays = wire.groupBy(F.pmod(F.xxhash64("event_id"), F.lit(n)).alias("b")).agg(F.collect_list(element).alias("x"))
    arrays.select(F.concat(F.lit("["), F.array_join("x", ","), F.lit("]")).alias("value")).write.option("maxRecordsPerFile", 1).text(staged)
    for _ in range(2):
        loads.copy_json_files(spark, staged, table, manifest, ".txt")
    rows = spark.read.parquet(table).withColumn("null_kept", F.col("event_data").contains('"customer_id":null'))
    return rows.groupBy("event_id", "event_type", "customer_id", "null_kept").agg(F.count(F.lit(1)).cast("int").alias("copies"))


@register("scheduled_load_tables", O.q("""
SELECT 'page_views' AS table_name, event_id AS row_key, previous_page, is_bounce FROM pv
UNION ALL SELECT 'product_interactions', event_id, NULL, NULL FROM pi
UNION ALL SELECT 'purchases', event_id, NULL, NULL FROM pu
UNION ALL SELECT 'searches', event_id, NULL, NULL FROM se
UNION ALL SELECT 'user_engagement', event_id, NULL, NULL FROM ue
UNION ALL SELECT 'purchase_items', purchase_item_id, NULL, NULL FROM pit
"""))
def scheduled_load_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental load on a cadence. Half of the files are there
    when it first runs, the others, and a copy of every seventh event, when it
    runs again from its checkpoint."""
    raw_dir, out, checkpoint = (_folder(spark, x) for x in ("raw", "processed", "cadence"))
    raw = P.landed_raw_events(spark, sf_dir)
    late = F.col("offset_id") % 2 == 1
    for rows in (raw.where(~late), raw.where(late | (F.col("offset_id") % 7 == 0))):
        rows.write.mode("append").parquet(raw_dir)
        etl.start_scheduled_load(spark, raw_dir, out, checkpoint, P.product_dim(spark, sf_dir), available_now=True).awaitTermination()
    tables = None
    for name in etl.PROCESSED:
        t = spark.read.parquet(f"{out}/{name}")
        t = route.with_session_fields(t) if name == "page_views" else t.withColumns(
            {"previous_page": F.lit(None).cast("string"), "is_bounce": F.lit(None).cast("boolean")})
        key = "purchase_item_id" if name == "purchase_items" else "event_id"
        t = t.select(F.lit(name).alias("table_name"), F.col(key).alias("row_key"), "previous_page", "is_bounce")
        tables = t if tables is None else tables.unionByName(t)
    return tables
