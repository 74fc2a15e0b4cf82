"""Streaming operators.

The batch operators are reused unchanged on streaming DataFrames wherever
Spark allows it (projections, filters, validation, enrichment, routing);
stateful steps declare a watermark so their state is bounded.

Event times on the wire span several days and the mirrored pipeline has no
lateness rule (it only rejects times more than an hour ahead), so the
default watermark is 7 days: nothing in that spread is dropped as late.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptrail import schemas as S
from shoptrail.functions.events import counter_group, parse_event_time
from shoptrail.operators.enrich import enrich_events
from shoptrail.operators.validate import with_validity
from shoptrail.session import ensure_checkpoint_dir

DEFAULT_WATERMARK = "7 days"


def kafka_events(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """A topic of JSON events. Key and value are decoded as UTF-8 and
    the value parsed with the flat wire schema; ``partition``/``offset`` are
    kept for lineage. Requires the Kafka connector on the classpath."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    raw = reader.load()
    return parse_values(raw.select(F.col("key").cast("string").alias("key"),
                                   F.col("value").cast("string").alias("value"),
                                   "topic", "partition", "offset"))


def file_events(spark: SparkSession, path: str, schema: T.StructType = S.FLAT_EVENT_SCHEMA,
                max_files_per_trigger: int | None = None, archive_dir: str | None = None) -> DataFrame:
    """Topic substitute: a folder of JSON-lines files read as a stream.
    ``archive_dir`` moves finished files there (K7 ``cleanSource``)."""
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.json(path)


def parse_values(df: DataFrame, schema: T.StructType = S.FLAT_EVENT_SCHEMA) -> DataFrame:
    """F3 on a stream: undecodable values keep ``_corrupt_record`` and no
    fields, instead of failing the query."""
    ok = F.try_parse_json(F.col("value")).isNotNull()
    parsed = F.from_json(F.col("value"), schema)
    others = [c for c in df.columns if c != "value"]
    return df.select(*[F.when(ok, parsed[f.name]).alias(f.name) for f in schema.fields],
                     F.when(~ok, F.col("value")).alias("_corrupt_record"), *others)


def validate_and_enrich(events: DataFrame, as_of=None) -> DataFrame:
    """Stateless validate -> enrich; adds ``is_valid_event`` and the
    enrichment columns. Works on batch and stream DataFrames alike."""
    return enrich_events(with_validity(events, as_of=as_of))


def with_event_time(events: DataFrame, col: str = "event_timestamp", out: str = "event_time") -> DataFrame:
    """Event time as TIMESTAMP (not NTZ): watermarks require it."""
    dtype = events.schema[col].dataType
    ts = F.col(col) if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) else parse_event_time(col)
    return events.withColumn(out, ts.cast("timestamp"))


def not_future(events: DataFrame, as_of, hours: int = 1, time_col: str = "event_time") -> DataFrame:
    """Events at most ``hours`` ahead of ``as_of``. A stamp from the future
    would move the watermark past good events, so stateful operators take
    their input through this; what it holds back is invalid by rule and goes
    to the dead-letter route (``validate_and_enrich``)."""
    now = F.lit(str(as_of)).cast("timestamp") if as_of is not None else F.current_timestamp()
    return events.where(F.col(time_col) <= now + F.expr(f"INTERVAL {int(hours)} HOURS"))


def dedup_stream(events: DataFrame, watermark: str = DEFAULT_WATERMARK, key: str = "event_id",
                 time_col: str = "event_time") -> DataFrame:
    """Drop repeated event ids seen within the watermark (bounded state).
    Pass the events through ``not_future`` first."""
    return events.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark([key])


def rate_per_minute(events: DataFrame, watermark: str = DEFAULT_WATERMARK, time_col: str = "event_time") -> DataFrame:
    """Tumbling one-minute counts."""
    return (events.withWatermark(time_col, watermark)
                  .groupBy(F.window(time_col, "1 minute").alias("w"))
                  .agg(F.count(F.lit(1)).alias("events"))
                  .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events"))


def session_activity(events: DataFrame, gap: str = "30 minutes", watermark: str = DEFAULT_WATERMARK,
                     time_col: str = "event_time", key: str = "customer_id") -> DataFrame:
    """Per customer inactivity sessions (``session_window``): page views,
    events, and the last page seen. State is released when the watermark
    passes the session end."""
    pv = F.col("event_type") == "PAGE_VIEW"
    page = F.get_json_object("event_data", "$.page_url")
    return (events.filter(F.col(key).isNotNull()).withWatermark(time_col, watermark)
                  .groupBy(key, F.session_window(time_col, gap).alias("s"))
                  .agg(F.count(F.lit(1)).alias("events"), F.count_if(pv).alias("page_views"),
                       F.max_by(F.when(pv, page), F.when(pv, F.col(time_col))).alias("last_page"))
                  .select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                          "events", "page_views", "last_page"))


def running_counters(flagged: DataFrame) -> DataFrame:
    """Running totals per counter group plus raw / clean / invalid,
    for ``outputMode("complete")`` (one row per counter; state is a handful
    of rows)."""
    g = F.coalesce(counter_group("event_type"), F.lit("other"))
    return (flagged.groupBy(g.alias("counter_group"))
                   .agg(F.count(F.lit(1)).alias("raw_events"),
                        F.count_if(F.col("is_valid_event")).alias("clean_events"),
                        F.count_if(~F.col("is_valid_event")).alias("invalid_events")))


def to_topic_records(events: DataFrame, key: str = "customer_id") -> DataFrame:
    """K1: key/value records for a topic sink (same key, JSON value)."""
    cols = [c for c in events.columns if not c.startswith("_")]
    return events.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*cols)).alias("value"))


def route_batch(clean_path: str, dead_letter_path: str):
    """X1/X10 sink: ``foreachBatch`` writer splitting a micro-batch into the
    clean route and the dead-letter route. Each batch id writes its own
    folder in overwrite mode, so a replayed batch replaces itself
    (idempotent under at-least-once delivery)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        try:
            (b.filter(F.col("is_valid_event")).drop("is_valid_event")
              .write.mode("overwrite").parquet(f"{clean_path}/batch_id={batch_id}"))
            (b.filter(~F.col("is_valid_event")).drop("is_valid_event")
              .write.mode("overwrite").parquet(f"{dead_letter_path}/batch_id={batch_id}"))
        finally:
            b.unpersist()
    return write


def start_processor(spark: SparkSession, events: DataFrame, clean_path: str, dead_letter_path: str,
                    name: str = "stream_processor", checkpoint: str | None = None,
                    available_now: bool = False, every: str = "5 minutes", as_of=None):
    """The stream processor as one query: validate, enrich, split to
    clean / dead-letter routes. Progress lives in the checkpoint (under the
    shared ``spark.checkpoint.dir`` unless given), which replaces manual
    offset commits. ``available_now`` drains what is there and stops (the
    scheduled-task form); otherwise it triggers every ``every``."""
    checkpoint = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    w = (validate_and_enrich(events, as_of=as_of).writeStream
         .foreachBatch(route_batch(clean_path, dead_letter_path))
         .option("checkpointLocation", checkpoint).queryName(name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)
    return w.start()
