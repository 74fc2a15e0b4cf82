"""Registered queries of the keyed-state streams: files that Spark derives
from the whole driver tables, read in several triggers, against batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shoptrail import schemas as S
from shoptrail.functions.events import pct
from shoptrail.plans import oracles as O
from shoptrail.plans import pipeline as P
from shoptrail.plans.catalog import WV, _run_stream, _stream_input, register
from shoptrail.session import scratch_path
from shoptrail.sources.fixtures import FIXTURE_NOW
from shoptrail.streaming import processor as X
from shoptrail.streaming import stateful

SESSION_GAP = 12 * 3600  # seconds; the adapter's sessions end after as much
SESSION_SHARDS, DAY_SHARDS = 1024, 64  # keys of state for all sessions, for the customers of a day
SESSION_EVENT = T.StructType([*S.FLAT_EVENT_SCHEMA.fields, T.StructField("session_id", T.StringType())])


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wire events as a stream whose files hold no time order: the
    triggers bring late rows, a closing one ends the last windows."""
    stateful.use_rocksdb(spark)
    path = _stream_input(spark, sf_dir, closing=True, shuffled=True)
    return X.with_event_time(X.file_events(spark, path, SESSION_EVENT, max_files_per_trigger=2))


@register("stream_session_state", O.q(f"""
, s0 AS (SELECT session_id, event_id, timestamp, event_type, page_url,
                lag(timestamp) OVER (PARTITION BY session_id ORDER BY timestamp, event_id) AS prev
         FROM raw WHERE session_id IS NOT NULL),
s1 AS (SELECT *, SUM(CASE WHEN prev IS NULL OR timestamp - prev >= INTERVAL {SESSION_GAP} SECOND THEN 1 ELSE 0 END)
                 OVER (PARTITION BY session_id ORDER BY timestamp, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS part
       FROM s0)
SELECT session_id, min(timestamp) AS session_start, max(timestamp) AS session_end, COUNT(*) AS events,
       COUNT(*) FILTER (WHERE event_type = 'PAGE_VIEW') AS page_views,
       max_by(page_url, (timestamp, event_id)) FILTER (WHERE event_type = 'PAGE_VIEW') AS last_page
FROM s1 GROUP BY session_id, part
"""))
def stream_session_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State by session id, given out on expiry; shuffled input."""
    events = _events(spark, sf_dir).withColumn("page_url", F.get_json_object("event_data", "$.page_url"))
    out = _run_stream(spark, stateful.session_state(events, SESSION_GAP, watermark="90 days", shards=SESSION_SHARDS))
    return out.where("session_id <> '~'").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@register("stream_recent", O.q("""
SELECT partition_id, event_id, ingestion_time, rank FROM (
  SELECT CAST(partition_id AS VARCHAR) AS partition_id, event_id, ingestion_time,
         ROW_NUMBER() OVER (PARTITION BY partition_id ORDER BY ingestion_time DESC NULLS LAST, event_id ASC) AS rank
  FROM rawv) WHERE rank <= 100
"""))
def stream_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 on a stream: the last 100 events of each topic partition, kept in
    state over several triggers."""
    stateful.use_rocksdb(spark)
    path = scratch_path(spark, f"streams/recent-{_name()}")
    rows = P.raw_events(spark, sf_dir).select("partition_id", "event_id", F.col("ingestion_time").cast("timestamp").alias("ingestion_time"))
    rows.repartition(6, F.xxhash64("event_id")).write.parquet(path)
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)
    out = _update_stream(spark, stateful.recent_rows(source, "partition_id", "ingestion_time", 100))
    newest = Window.partitionBy("key")
    return (out.withColumn("last", F.max("version").over(newest)).where("version = last")
            .select(F.col("key").alias("partition_id"), "event_id", F.timestamp_micros("micros").cast("timestamp_ntz").alias("ingestion_time"), "rank"))


@register("stream_quality_running", O.q(f"""
, fl AS (SELECT event_id, timestamp, coalesce(customer_id, '~') AS ck, {WV} AS ok FROM raw WHERE timestamp IS NOT NULL)
SELECT event_id,
  COUNT(*) OVER w AS running_processed,
  CAST(SUM(CASE WHEN ok THEN 1 ELSE 0 END) OVER w AS BIGINT) AS running_valid,
  {O.pct_sql("SUM(CASE WHEN ok THEN 1 ELSE 0 END) OVER w", "COUNT(*) OVER w", 1)} AS running_quality_pct
FROM fl
WINDOW w AS (PARTITION BY ck, CAST(timestamp AS DATE) ORDER BY timestamp, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""))
def stream_quality_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 on a stream of shuffled files, in event-time order."""
    flagged = X.validate_and_enrich(_events(spark, sf_dir), as_of=FIXTURE_NOW)
    out = _run_stream(spark, stateful.running_quality(flagged, watermark="90 days", shards=DAY_SHARDS)).where("event_id <> 'closing'")
    return out.withColumn("running_quality_pct", pct("running_valid", "running_processed", 1))


def _name() -> str:
    import uuid
    return uuid.uuid4().hex


def _update_stream(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A stream in update mode run to its end: each micro-batch writes its own
    folder in overwrite mode, so that a repeated one replaces itself."""
    run = _name()
    out = scratch_path(spark, f"streams/out-{run}")
    (df.writeStream.outputMode("update").option("checkpointLocation", scratch_path(spark, f"streams/ckpt-{run}"))
     .foreachBatch(lambda batch, i: batch.write.mode("overwrite").parquet(f"{out}/batch_id={i}"))
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out)


ARRIVAL_DELAY = "3 days"


@register("stream_late_events", O.q(f"""
, a AS (SELECT event_id, timestamp AS t, timestamp > {O.NOW} + INTERVAL 1 HOUR AS ahead,
               CASE WHEN substr(md5(event_id), 1, 1) < '5' THEN 0 WHEN substr(md5(event_id), 1, 1) < 'a' THEN 1 ELSE 2 END AS arrival
        FROM raw WHERE event_id IS NOT NULL),
marks AS (SELECT arrival, max(max(t) FILTER (WHERE NOT ahead)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest
          FROM a GROUP BY arrival)
SELECT a.event_id, CASE WHEN t IS NULL THEN 'undated' WHEN ahead THEN 'future'
                        WHEN t < latest - INTERVAL {ARRIVAL_DELAY} THEN 'late' ELSE 'on_time' END AS route
FROM a JOIN marks USING (arrival)
"""))
def stream_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events arrive in three parts; each is split by the watermark
    that the parts before it left."""
    from shoptrail.streaming import lateness
    run = _name()
    source, out = scratch_path(spark, f"streams/parts-{run}"), scratch_path(spark, f"streams/routes-{run}")
    events = X.with_event_time(P.wire_events(spark, sf_dir).where("event_id IS NOT NULL")).select("event_id", "event_time")
    first = F.substring(F.md5("event_id"), 1, 1)
    arrival = F.when(first < "5", 0).when(first < "a", 1).otherwise(2)
    for part in range(3):
        events.where(arrival == part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        lateness.start_routing(stream, out, scratch_path(spark, f"streams/ckpt-{run}"), ARRIVAL_DELAY, FIXTURE_NOW).awaitTermination()
    return lateness.read_routes(spark, out, events.schema).select("event_id", "route")
