"""Late rows are kept and counted; a replayed batch changes nothing."""

import datetime as dt
import time

from pyspark.sql import functions as F

from shoptrail.streaming import lateness

T0 = dt.datetime(2024, 1, 10)
PARTS = [[("a", T0), ("b", T0 + dt.timedelta(hours=5)), ("c", T0 + dt.timedelta(days=900)), ("d", None)],
         [("e", T0 - dt.timedelta(days=1)), ("f", T0 + dt.timedelta(hours=3)), ("g", T0 + dt.timedelta(hours=2))],
         [("h", None)],
         [],  # a file without rows
         [("i", T0 + dt.timedelta(hours=4)), ("j", T0 + dt.timedelta(hours=1))]]
WANT = {"a": "on_time", "b": "on_time", "c": "future", "d": "undated", "e": "late", "f": "on_time", "g": "late", "h": "undated",
        "i": "on_time", "j": "late"}  # the mark is 03:00 from the second part on; at the mark is on time


def test_routes_are_all_rows_and_counted(spark, tmp_path):
    counts = lateness.ArrivalCounts()
    spark.streams.addListener(counts)
    source, out, schema = str(tmp_path / "in"), str(tmp_path / "out"), "event_id string, event_time timestamp"
    try:
        for part in PARTS:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
            stream = spark.readStream.schema(schema).parquet(source)
            lateness.start_routing(stream, out, str(tmp_path / "ckpt"), "2 hours", "2024-01-31").awaitTermination()
        late = time.monotonic() + 30
        while counts.arrived() < len(WANT) and time.monotonic() < late:
            time.sleep(0.2)  # the listener hears of a batch after it is done
    finally:
        spark.streams.removeListener(counts)
    schema = stream.schema
    routed = lateness.read_routes(spark, out, schema)
    assert {r["event_id"]: r["route"] for r in routed.collect()} == WANT and routed.count() == len(WANT) == counts.arrived()
    again = spark.createDataFrame(PARTS[1], schema)  # the second batch is delivered once more
    lateness.route_arrivals(out, "2 hours", "2024-01-31")(again, 1)
    assert {r["event_id"]: r["route"] for r in lateness.read_routes(spark, out, schema).collect()} == WANT


def test_on_time_route_loses_nothing_in_a_windowed_stream(spark, tmp_path):
    """A watermark of the same delay over the on-time route drops no row."""
    rows = [(f"e{i}", T0 + dt.timedelta(minutes=17 * (i * 7919 % 500))) for i in range(500)]
    source, out, schema = str(tmp_path / "in"), str(tmp_path / "out"), "event_id string, event_time timestamp"
    for k in range(4):
        spark.createDataFrame(rows[k::4], schema).write.mode("append").parquet(source)
        lateness.start_routing(spark.readStream.schema(schema).parquet(source), out, str(tmp_path / "ckpt"), "1 day", "2024-01-31").awaitTermination()
    routed = lateness.read_routes(spark, out, spark.read.parquet(source).schema).where("route = 'on_time'").cache()
    assert 0 < routed.count() < len(rows)
    seen = str(tmp_path / "seen")
    for k in range(4):
        routed.where(F.col("batch_id") == k).select("event_id", "event_time").write.mode("append").parquet(seen)
        counts = (spark.readStream.schema(schema).parquet(seen).withWatermark("event_time", "1 day").groupBy(F.window("event_time", "1 hour")).count())
        (counts.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "ckpt2"))
         .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(str(tmp_path / f"agg/batch={i}"))).trigger(availableNow=True).start().awaitTermination())
    newest = spark.read.parquet(str(tmp_path / "agg")).groupBy("window").agg(F.max_by("count", "batch").alias("n"))
    assert newest.agg(F.sum("n")).first()[0] == routed.count()
