"""Stream = batch: the stream processor and stateful stream operators."""

import os

from pyspark.sql import functions as F

from shoptrail.plans import pipeline as P
from shoptrail.streaming import processor as X
from tests.conftest import SMALL

NOW = "2024-01-31 00:00:00"


def _land_json(spark, path):
    wire = P.wire_events(spark, SMALL).select(
        "event_id", "customer_id", "event_type", "amount", "currency", "event_timestamp", "event_data",
        "is_valid", "invalid_field", "source")
    wire.repartition(4).write.mode("overwrite").json(path)
    return wire


def test_processor_stream_equals_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    wire = _land_json(spark, src)
    clean, dead = os.path.join(tmpdir_path, "clean"), os.path.join(tmpdir_path, "dead")
    q = X.start_processor(spark, X.file_events(spark, src, max_files_per_trigger=2), clean, dead,
                          name="t_proc", checkpoint=os.path.join(tmpdir_path, "ckpt"),
                          available_now=True, as_of=NOW)
    q.awaitTermination(300)
    got_clean = {r.event_id for r in spark.read.parquet(clean).select("event_id").collect()}
    got_dead = {r.event_id for r in spark.read.parquet(dead).select("event_id").collect()}
    batch = X.validate_and_enrich(wire, as_of=NOW)
    want_clean = {r.event_id for r in batch.filter("is_valid_event").select("event_id").collect()}
    assert got_clean == want_clean
    assert len(got_clean) + len(got_dead) == wire.count() and not (got_clean & got_dead)


def test_stream_dedup_and_counters(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    wire = _land_json(spark, src)
    # replay the same events a second time: duplicates must be dropped
    wire.write.mode("append").json(src)
    s = X.with_event_time(X.file_events(spark, src))
    q = (X.dedup_stream(s).writeStream.format("memory").queryName("t_dedup")
         .option("checkpointLocation", os.path.join(tmpdir_path, "c1")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert spark.table("t_dedup").count() == wire.count()
    flagged = X.validate_and_enrich(X.file_events(spark, src), as_of=NOW)
    q2 = (X.running_counters(flagged).writeStream.format("memory").queryName("t_cnt").outputMode("complete")
          .option("checkpointLocation", os.path.join(tmpdir_path, "c2")).trigger(availableNow=True).start())
    q2.awaitTermination(300)
    tot = spark.table("t_cnt").agg(F.sum("raw_events")).first()[0]
    assert tot == 2 * wire.count()


def test_stream_windows(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    wire = _land_json(spark, src)
    s = X.with_event_time(X.file_events(spark, src))
    q = (X.rate_per_minute(s).writeStream.format("memory").queryName("t_rate").outputMode("append")
         .option("checkpointLocation", os.path.join(tmpdir_path, "c3")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    # append mode emits windows closed by the watermark; all emitted counts are exact
    emitted = spark.table("t_rate")
    batch = (X.with_event_time(wire).groupBy(F.window("event_time", "1 minute").alias("w"))
             .agg(F.count(F.lit(1)).alias("events"))
             .select(F.col("w.start").alias("window_start"), "events"))
    joined = emitted.join(batch, "window_start").filter(emitted["events"] != batch["events"])
    assert emitted.count() > 0 and joined.count() == 0
    q2 = (X.session_activity(s).writeStream.format("memory").queryName("t_sess").outputMode("append")
          .option("checkpointLocation", os.path.join(tmpdir_path, "c4")).trigger(availableNow=True).start())
    q2.awaitTermination(300)
    assert spark.table("t_sess").where("events < 1 or session_end <= session_start").count() == 0


def test_silver_writer_and_topic_records(spark, tmpdir_path):
    import json as _json

    from shoptrail.sinks.writers import silver_batch_writer
    src = os.path.join(tmpdir_path, "in")
    wire = _land_json(spark, src)
    out = os.path.join(tmpdir_path, "silver")
    q = (X.file_events(spark, src, max_files_per_trigger=2).writeStream
         .foreachBatch(silver_batch_writer(out))
         .option("checkpointLocation", os.path.join(tmpdir_path, "c5")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    silver = spark.read.parquet(out)
    assert silver.columns[:6] == ["EVENT_ID", "CUSTOMER_ID", "EVENT_TYPE", "AMOUNT", "CURRENCY", "EVENT_TIMESTAMP"]
    assert silver.count() == wire.count()
    # re-running a batch id replaces its folder instead of appending twice
    silver_batch_writer(out)(wire.limit(5), 0)
    assert spark.read.parquet(os.path.join(out, "batch_id=0")).count() == 5
    rec = X.to_topic_records(X.validate_and_enrich(wire, as_of=NOW).filter("customer_id IS NOT NULL")).first()
    assert _json.loads(rec.value)["customer_id"] == rec.key


def test_stream_dedup_keeps_its_state_on_disk(spark):
    import __spark_entry__ as E
    from tests.conftest import SMALL
    provider, changes = "spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    for conf in (provider, changes):
        spark.conf.unset(conf)
    got = E.queries()["stream_dedup"](spark, SMALL)
    assert got.count() == got.select("event_id").distinct().count() > 0
    assert spark.conf.get(provider).endswith("RocksDBStateStoreProvider") and spark.conf.get(changes) == "true"



def test_wire_payload_is_one_struct(spark):
    from shoptrail.plans import pipeline as P
    from tests.conftest import SMALL
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        wire = P.wire_events(spark, SMALL)
        assert "product_page_url" not in wire._jdf.queryExecution().analyzed().toString()  # no field is added and dropped again
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    row = wire.where("event_type = 'PRODUCT_VIEW'").selectExpr("get_json_object(event_data, '$.page_url') AS u").first()
    assert row["u"].startswith("/product/prod_")
