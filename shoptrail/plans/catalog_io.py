"""Registered queries of the file sources, sinks and the ETL run: each writes
rows that Spark derives from the whole driver tables to the shared folder,
reads them back through the operator and is held against the same SQL."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.operators import enrich, land, route, validate, views
from shoptrail.plans import oracles as O
from shoptrail.plans import pipeline as P
from shoptrail.plans.catalog import MERGE_CUTOFF, _journey, _stream_input, register
from shoptrail.plans.etl import run_etl
from shoptrail.session import scratch_path
from shoptrail.sinks import writers
from shoptrail.sources import files
from shoptrail.sources.fixtures import FIXTURE_NOW, FIXTURE_TODAY


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"io/{name}-{uuid.uuid4().hex}")


def _landed_routes(spark: SparkSession, sf_dir: str) -> str:
    """RAW_EVENTS written by the routed writer (K2)."""
    base = _folder(spark, "routes")
    route_of = F.when(F.col("is_valid"), F.lit("processed")).otherwise(F.lit("failed"))
    writers.write_routes(P.raw_events(spark, sf_dir).withColumn("category", route_of), base)
    return base


@register("routed_files", O.q("""
SELECT event_id, event_type, CASE WHEN is_valid THEN 'processed' ELSE 'failed' END AS category FROM rawv
"""))
def routed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the routed Parquet files, read back with their route."""
    return spark.read.parquet(_landed_routes(spark, sf_dir)).select("event_id", "event_type", "category")


@register("landed_scan", O.q("""
SELECT event_id, event_type, storage_type, TRUE AS has_lineage FROM rawv
"""))
def landed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed file with its name and the time of the extract."""
    df = files.read_landed(spark, _landed_routes(spark, sf_dir))
    lineage = F.col("source_file").endswith(".parquet") & F.col("extraction_time").isNotNull()
    return df.select("event_id", "event_type", "storage_type", lineage.alias("has_lineage"))


@register("recent_files", O.q("SELECT event_id, event_type FROM rawv"))
def recent_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of the last day, here all that were just written."""
    return files.read_recent(spark, _landed_routes(spark, sf_dir), days_back=1).select("event_id", "event_type")


@register("store_extract", O.q("""
SELECT event_id, event_type, is_valid, ingestion_time, 'duckdb' AS source_file FROM rawv WHERE storage_type = 'duckdb'
"""))
def store_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store's half of the events, read by table name."""
    name = f"store_{uuid.uuid4().hex}"
    P.raw_events(spark, sf_dir).where("storage_type = 'duckdb'").createOrReplaceTempView(name)
    return files.read_store_table(spark, name).select("event_id", "event_type", "is_valid", "ingestion_time", "source_file")


@register("file_target_table", O.q(f"SELECT event_id, {O.TARGET_SQL} AS target_table FROM rawv"))
def file_target_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file's rows with the table each belongs to."""
    path = _folder(spark, "file")
    P.raw_events(spark, sf_dir).select("event_id", "event_type").write.parquet(path)
    return files.read_file_for_table(spark, path).select("event_id", "target_table")


@register("warehouse_rows", O.q("""
SELECT event_id AS EVENT_ID, timestamp AS TIMESTAMP,
       '["' || event_type || '","' || storage_type || '"]' AS TAGS FROM rawv
"""))
def warehouse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: time text parsed, nested values as JSON, upper-case names."""
    raw = P.raw_events(spark, sf_dir)
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return writers.warehouse_ready(raw.select("event_id", text.alias("timestamp"), F.array("event_type", "storage_type").alias("tags")))


@register("retention_rows", O.q(f"""
SELECT event_id, CAST(timestamp AS DATE) AS event_date FROM rawv
WHERE CAST(timestamp AS DATE) < DATE '{FIXTURE_TODAY}' - INTERVAL 7 DAY
"""))
def retention_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the rows that are due for the archive."""
    raw = P.raw_events(spark, sf_dir).select("event_id", F.to_date("timestamp").alias("event_date"))
    return writers.retention_filter(raw, "event_date", FIXTURE_TODAY, 7)


@register("silver_batches", O.q("""
SELECT event_id AS EVENT_ID, customer_id AS CUSTOMER_ID, event_type AS EVENT_TYPE, amount AS AMOUNT FROM raw
"""))
def silver_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: several micro-batches appended to the silver table."""
    from shoptrail.streaming import processor as X
    out, run = _folder(spark, "silver"), uuid.uuid4().hex
    (X.file_events(spark, _stream_input(spark, sf_dir), max_files_per_trigger=2).writeStream
     .foreachBatch(writers.silver_batch_writer(out, run))
     .option("checkpointLocation", _folder(spark, "silver-checkpoint")).trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out).select("EVENT_ID", "CUSTOMER_ID", "EVENT_TYPE", "AMOUNT")


@register("normalized_events", O.q(f"""
SELECT event_id, strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS event_timestamp,
       CAST(coalesce(total_amount, product_price * quantity) AS DOUBLE) AS amount FROM raw
"""))
def normalized_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the rich dialect (``timestamp`` text, amounts only in the
    payload) brought to the flat envelope."""
    rich = P.wire_events(spark, sf_dir).select("event_id", F.col("event_timestamp").alias("timestamp"), "event_data")
    return validate.normalize_dialects(rich).select("event_id", "event_timestamp", F.col("amount").cast("double").alias("amount"))


@register("corrupt_messages", O.q("""
SELECT offset_id, CASE WHEN offset_id % 19 <> 4 THEN event_id END AS event_id, offset_id % 19 = 4 AS is_corrupt FROM raw
"""))
def corrupt_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """topic messages, one in nineteen cut short; none fails the batch."""
    wire = P.wire_events(spark, sf_dir)
    message = F.to_json(F.struct(*[f.name for f in S.FLAT_EVENT_SCHEMA.fields]))
    broken = F.col("offset") % 19 == 4
    value = F.when(broken, F.expr("substring(value, 1, 9)")).otherwise(F.col("value"))
    sent = wire.select("offset", message.alias("value")).withColumn("value", value)
    return validate.parse_wire(sent).select(F.col("offset").alias("offset_id"), "event_id", F.col("_corrupt_record").isNotNull().alias("is_corrupt"))


@register("customer_journey_one", O.q(O.JOURNEY_CTE + " SELECT * FROM jr WHERE customer_id = 'CUST_1'"))
def customer_journey_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one customer's journey."""
    one = views.journey_of(_journey(spark, sf_dir), "CUST_1")
    return one.withColumn("purchase_amount", F.col("purchase_amount").cast("double"))


@register("etl_stamped", O.q("""
SELECT event_id, '20240201_060000' AS etl_run_id, TIMESTAMP '2024-02-01 06:00:00' AS etl_timestamp FROM rawv
"""))
def etl_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run id and time for all rows."""
    return enrich.etl_metadata(P.raw_events(spark, sf_dir).select("event_id"), datetime(2024, 2, 1, 6))


@register("default_validity", O.q("""
SELECT event_id, (declared_valid OR offset_id % 2 = 0) AND len(issues) = 0 AS is_valid FROM raw
"""))
def default_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: every second event declares nothing; it counts as valid unless an
    issue is found."""
    declared = F.when(F.col("offset") % 2 == 1, F.col("is_valid"))
    wire = P.wire_events(spark, sf_dir).withColumn("is_valid", declared)
    return land.to_raw_events(wire, as_of=FIXTURE_NOW).select("event_id", "is_valid")


@register("packed_events", O.q("""
SELECT event_id, '{"event_id":"' || event_id || '","customer_id":' || coalesce('"' || customer_id || '"', 'null')
       || ',"offset_id":' || CAST(offset_id AS VARCHAR) || '}' AS event_data FROM rawv
"""))
def packed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row as one JSON document, NULL fields kept."""
    raw = P.raw_events(spark, sf_dir).select("event_id", "customer_id", "offset_id")
    return land.pack_event(raw, keep_nulls=True).select("event_id", "event_data")


# --------------------------------------------------------------------------
# Two ETL runs over files. The first gets the events before the cut,
# every eleventh with a wrong type; the second the later events, every
# eleventh again with its right type, every seventh unchanged, and copies of
# every thirteenth without an id.
# --------------------------------------------------------------------------

_RUNS = (datetime(2024, 2, 1), datetime(2024, 2, 2))


def _two_runs(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    base = _folder(spark, "etl")
    raw = P.landed_raw_events(spark, sf_dir)
    early = F.col("timestamp") < F.lit(MERGE_CUTOFF).cast("timestamp_ntz")
    fixed, same = F.col("offset_id") % 11 == 0, F.col("offset_id") % 7 == 0
    first = raw.where(early).withColumn("event_type", F.when(fixed, F.lit("ERROR")).otherwise(F.col("event_type")))
    second = raw.where(~early | fixed | same)
    nameless = raw.where(F.col("offset_id") % 13 == 0).withColumn("event_id", F.lit(None).cast("string"))
    for day, rows in zip(_RUNS, (first, second.unionByName(nameless))):
        rows.drop("source_file").write.parquet(f"{base}/landed/{day:%Y%m%d}")
        written = run_etl(spark, f"{base}/landed", None, f"{base}/raw_events", f"{base}/processed", run_at=day,
                          buckets=16, products=P.product_dim(spark, sf_dir), manifest=f"{base}/loaded_files",
                          ledger=f"{base}/ledger", statistics=f"{base}/statistics")
    return written | {"statistics": f"{base}/statistics"}


@register("etl_two_runs", O.q(f"""
SELECT event_id, event_type, is_valid,
       CASE WHEN timestamp < TIMESTAMP '{MERGE_CUTOFF}' THEN '20240201_000000' ELSE '20240202_000000' END AS etl_run_id,
       CASE WHEN timestamp < TIMESTAMP '{MERGE_CUTOFF}' AND offset_id % 11 <> 0 AND offset_id % 7 <> 0
            THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-02-02 00:00:00' END AS etl_timestamp
FROM rawv
"""))
def etl_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW_EVENTS after both runs, equal to those of one run but for
    the run stamps. The files of the first run are not read again."""
    raw = spark.read.parquet(_two_runs(spark, sf_dir)["raw_events"])
    return raw.select("event_id", "event_type", "is_valid", "etl_run_id", "etl_timestamp")


@register("etl_two_run_tables", O.q("""
SELECT 'page_views' AS table_name, event_id AS row_key, previous_page, is_bounce FROM pv
UNION ALL SELECT 'product_interactions', event_id, NULL, NULL FROM pi
UNION ALL SELECT 'purchases', event_id, NULL, NULL FROM pu
UNION ALL SELECT 'searches', event_id, NULL, NULL FROM se
UNION ALL SELECT 'user_engagement', event_id, NULL, NULL FROM ue
UNION ALL SELECT 'purchase_items', purchase_item_id, NULL, NULL FROM pit
UNION ALL SELECT 'rejected', CAST(offset_id AS VARCHAR), NULL, NULL FROM rawv WHERE offset_id % 13 = 0
"""))
def etl_two_run_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed tables after both runs hold what one run gives; page
    views read through their session fields, rows without an id rejected."""
    written = _two_runs(spark, sf_dir)
    keys = {"purchase_items": "purchase_item_id", "rejected": "offset_id"}
    out = None
    for name, path in written.items():
        if name in ("raw_events", "statistics"):
            continue
        t = spark.read.parquet(path)
        views_of = route.with_session_fields(t) if name == "page_views" else t.withColumns(
            {"previous_page": F.lit(None).cast("string"), "is_bounce": F.lit(None).cast("boolean")})
        rows = views_of.select(F.lit(name).alias("table_name"), F.col(keys.get(name, "event_id")).cast("string").alias("row_key"),
                               "previous_page", "is_bounce")
        out = rows if out is None else out.unionByName(rows)
    return out


@register("etl_run_statistics", O.q(f"""
, r AS (SELECT *, timestamp < TIMESTAMP '{MERGE_CUTOFF}' AS early FROM rawv),
b AS (SELECT 1 AS run, offset_id, timestamp, event_id FROM r WHERE early
      UNION ALL SELECT 2, offset_id, timestamp, event_id FROM r WHERE NOT coalesce(early, FALSE) OR offset_id % 11 = 0 OR offset_id % 7 = 0
      UNION ALL SELECT 2, offset_id, timestamp, NULL FROM r WHERE offset_id % 13 = 0)
SELECT CASE run WHEN 1 THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-02-02' END AS run_at,
       COUNT(*) AS extracted_files, 0::BIGINT AS extracted_store, COUNT(*) AS total_extracted,
       COUNT(*) FILTER (WHERE event_id IS NULL) AS rejected, 0::BIGINT AS duplicates_removed,
       COUNT(*) FILTER (WHERE event_id IS NOT NULL AND timestamp > CASE run WHEN 1 THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-02-02' END)
       AS quality_issues, COUNT(*) FILTER (WHERE event_id IS NOT NULL) AS loaded, TRUE AS timed
FROM b GROUP BY run
"""))
def etl_run_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs observed of themselves while they loaded."""
    stats = spark.read.parquet(_two_runs(spark, sf_dir)["statistics"])
    return stats.select("run_at", "extracted_files", "extracted_store", "total_extracted", "rejected", "duplicates_removed", "quality_issues",
                        "loaded", (F.col("seconds") > 0).alias("timed"))


@register("warehouse_summary", O.q(f"""
, n AS (
SELECT 'tables' AS section, 'raw_events' AS name, COUNT(*) AS value FROM rawv
UNION ALL SELECT 'tables', 'page_views', COUNT(*) FROM pv
UNION ALL SELECT 'tables', 'product_interactions', COUNT(*) FROM pi
UNION ALL SELECT 'tables', 'purchases', COUNT(*) FROM pu
UNION ALL SELECT 'tables', 'searches', COUNT(*) FROM se
UNION ALL SELECT 'tables', 'user_engagement', COUNT(*) FROM ue
UNION ALL SELECT 'tables', 'sessions', COUNT(DISTINCT session_id) FROM rawv
UNION ALL SELECT 'tables', 'customers', COUNT(*) FROM customer
UNION ALL SELECT 'quality', 'total_events', COUNT(*) FROM rawv WHERE CAST(timestamp AS DATE) = DATE '{FIXTURE_TODAY}'
UNION ALL SELECT 'quality', 'valid_events', COUNT(*) FILTER (WHERE is_valid) FROM rawv WHERE CAST(timestamp AS DATE) = DATE '{FIXTURE_TODAY}'
UNION ALL SELECT 'quality', 'invalid_events', COUNT(*) FILTER (WHERE NOT is_valid) FROM rawv WHERE CAST(timestamp AS DATE) = DATE '{FIXTURE_TODAY}')
SELECT section, name, CAST(value AS DOUBLE) AS value FROM n
UNION ALL SELECT 'quality', 'quality_score_pct', {O.pct_sql("COUNT(*) FILTER (WHERE is_valid)", "COUNT(*)")}
FROM rawv WHERE CAST(timestamp AS DATE) = DATE '{FIXTURE_TODAY}'
"""))
def warehouse_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven tables and the day's quality."""
    from shoptrail.plans import etl
    raw = P.landed_raw_events(spark, sf_dir)
    sessions = raw.where("session_id is not null").select("session_id").distinct()
    return etl.warehouse_summary(raw, sessions, P.customer_dim(spark, sf_dir), FIXTURE_TODAY)
