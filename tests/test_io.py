"""Sources, sinks and the batch ETL run."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shoptrail.operators.land import to_raw_events
from shoptrail.operators.validate import flatten, normalize_dialects, parse_wire
from shoptrail.plans import pipeline as P
from shoptrail.plans.etl import run_etl
from shoptrail.sinks.writers import fan_out, retention_filter, warehouse_ready, write_routes
from shoptrail.sources.files import read_json_arrays, read_landed, read_newest_files, read_recent
from tests.conftest import SMALL


def test_landed_scan_lineage_and_merge_schema(spark, tmpdir_path):
    a = spark.createDataFrame([("e1", "PAGE_VIEW")], "event_id string, event_type string")
    b = spark.createDataFrame([("e2", "PURCHASE", 9.5)], "event_id string, event_type string, amount double")
    a.write.parquet(os.path.join(tmpdir_path, "f1"))
    b.write.parquet(os.path.join(tmpdir_path, "f2"))
    df = read_landed(spark, tmpdir_path)
    rows = {r.event_id: r for r in df.collect()}
    assert set(rows) == {"e1", "e2"} and rows["e1"].amount is None and rows["e2"].amount == 9.5
    assert rows["e1"].source_file.endswith(".parquet")
    assert read_recent(spark, tmpdir_path, days_back=7).count() == 2
    assert read_recent(spark, tmpdir_path, days_back=7, now=datetime(2000, 1, 1)).count() == 2
    assert read_newest_files(spark, tmpdir_path, files=1, limit=10).count() == 1
    from shoptrail.operators.metrics import load_report
    rep = load_report(df, loaded_at="2024-02-01 00:00:00").collect()
    assert sorted(r.rows_loaded for r in rep) == [1, 1] and all(r.success for r in rep)


def test_json_array_files(spark, tmpdir_path):
    events = [{"event_id": "e1", "event_type": "PAGE_VIEW", "customer_id": "C1", "page_url": "/"},
              {"event_id": "e2", "event_type": "SEARCH", "customer_id": "C2", "search_query": "x"}]
    with open(os.path.join(tmpdir_path, "batch1.json"), "w") as f:
        json.dump(events, f)
    df = read_json_arrays(spark, tmpdir_path)
    got = {r.event_id: r for r in df.collect()}
    assert set(got) == {"e1", "e2"}
    assert json.loads(got["e2"].event_data)["search_query"] == "x"
    assert got["e1"].source_file == "batch1.json"


def test_parse_wire_keeps_corrupt(spark):
    df = spark.createDataFrame([('{"event_id": "e1", "event_type": "PAGE_VIEW"}',), ("{not json",)], "value string")
    rows = parse_wire(df).collect()
    assert rows[0].event_id == "e1" and rows[0]._corrupt_record is None
    assert rows[1].event_id is None and rows[1]._corrupt_record == "{not json"


def test_normalize_rich_dialect(spark):
    rich = spark.createDataFrame(
        [("e1", "PURCHASE", "2024-01-05T10:00:00Z", json.dumps({"total_amount": 42.5})),
         ("e2", "ADD_TO_CART", "2024-01-05T10:00:00", json.dumps({"product_price": 10.0, "quantity": 3}))],
        "event_id string, event_type string, timestamp string, event_data string")
    out = {r.event_id: r for r in normalize_dialects(rich).collect()}
    assert out["e1"].amount == "42.50" and out["e1"].event_timestamp == "2024-01-05T10:00:00Z"
    assert float(out["e2"].amount) == 30.0


def test_flatten_and_warehouse_ready(spark):
    df = spark.createDataFrame([("e1", (1, "b"), ["x"])], "event_id string, f struct<a:int,b:string>, tags array<string>")
    assert flatten(df).columns == ["event_id", "f_a", "f_b", "tags"]
    w = warehouse_ready(df)
    assert w.columns == ["EVENT_ID", "F", "TAGS"] and w.first().TAGS == '["x"]'


def test_routes_fanout_retention(spark, tmpdir_path):
    raw = P.raw_events(spark, SMALL)
    routed = raw.withColumn("category", F.when(F.col("is_valid"), "processed").otherwise("failed"))
    write_routes(routed, os.path.join(tmpdir_path, "routes"), max_records_per_file=100)
    back = spark.read.parquet(os.path.join(tmpdir_path, "routes"))
    assert back.count() == raw.count()
    assert {r.category for r in back.select("category").distinct().collect()} == {"processed", "failed"}
    spark.sql("DROP TABLE IF EXISTS store_events_test")
    fan_out(raw.drop("storage_type", "ingestion_time"), os.path.join(tmpdir_path, "pq"), "store_events_test",
            ingestion_time=datetime(2024, 2, 1))
    n_pq = spark.read.parquet(os.path.join(tmpdir_path, "pq")).count()
    n_db = spark.table("store_events_test").count()
    assert n_pq + n_db == raw.count() and n_pq > 0 and n_db > 0
    spark.sql("DROP TABLE IF EXISTS store_events_test")
    old = retention_filter(raw.withColumn("d", F.to_date("timestamp")), "d", "2024-01-31", 7)
    assert old.filter(F.col("d") >= F.lit("2024-01-24").cast("date")).count() == 0


def test_run_etl_end_to_end_and_replay(spark, tmpdir_path):
    wire = P.wire_events(spark, SMALL)
    raw = to_raw_events(wire, as_of="2024-01-31 00:00:00")
    land = os.path.join(tmpdir_path, "landed")
    raw.drop("source_file").write.parquet(land)
    target, processed = os.path.join(tmpdir_path, "raw_events"), os.path.join(tmpdir_path, "processed")
    w1 = run_etl(spark, land, None, target, processed, run_at=datetime(2024, 2, 1, 0, 0, 0))
    n_raw = spark.read.parquet(w1["raw_events"]).count()
    assert n_raw == raw.count()
    n_pv = spark.read.parquet(w1["page_views"]).count()
    # second run over the same files: merge keeps one row per id, appends nothing new
    w2 = run_etl(spark, land, None, target, processed, run_at=datetime(2024, 2, 2, 0, 0, 0))
    r2 = spark.read.parquet(w2["raw_events"])
    assert r2.count() == n_raw and r2.select("event_id").distinct().count() == n_raw
    # matched rows keep the first run's id; their etl_timestamp is the second run's
    assert {r.etl_run_id for r in r2.select("etl_run_id").distinct().collect()} == {"20240201_000000"}
    assert {r.etl_timestamp for r in r2.select("etl_timestamp").distinct().collect()} == {datetime(2024, 2, 2)}
    assert spark.read.parquet(w2["page_views"]).count() == n_pv


def test_store_table_file_table_and_journey_lookup(spark, tmpdir_path):
    from shoptrail.operators import rollups, views
    from shoptrail.sources.files import read_file_for_table, read_store_table
    raw = P.raw_events(spark, SMALL)
    spark.sql("DROP TABLE IF EXISTS store_events_s6")
    raw.write.saveAsTable("store_events_s6")
    store = read_store_table(spark, "store_events_s6")
    assert store.count() == raw.count() and {r.source_file for r in store.select("source_file").distinct().collect()} == {"duckdb"}
    spark.sql("DROP TABLE IF EXISTS store_events_s6")
    path = os.path.join(tmpdir_path, "one")
    raw.select("event_id", "event_type").write.parquet(path)
    routed = read_file_for_table(spark, path)
    got = {r.event_type: r.target_table for r in routed.select("event_type", "target_table").distinct().collect()}
    assert got["PAGE_VIEW"] == "PAGE_VIEWS" and got["ERROR"] == "MIXED_EVENTS"
    assert got["NEWSLETTER_SIGNUP"] == "USER_ENGAGEMENT"
    t = P.processed(spark, SMALL)
    journey = views.customer_journey(rollups.sessions(raw), t["purchases"])
    one = journey.filter("customer_id IS NOT NULL").select("customer_id").first().customer_id
    seq = [r.session_sequence for r in views.journey_of(journey, one).collect()]
    assert seq == list(range(1, len(seq) + 1))


def test_run_etl_reads_only_new_files(spark, tmpdir_path):
    raw = P.raw_events(spark, SMALL).drop("source_file")
    land, target, done, manifest = (os.path.join(tmpdir_path, d) for d in ("landed", "raw_events", "processed", "loaded"))
    raw.write.parquet(os.path.join(land, "a"))

    def run(day):
        return run_etl(spark, land, None, target, done, run_at=datetime(2024, 2, day), manifest=manifest, buckets=4)
    run(1)
    assert spark.read.parquet(manifest).count() == spark.read.parquet(manifest).distinct().count() > 0
    w = run(2)  # nothing new: no row is stamped again
    first = spark.read.parquet(w["raw_events"])
    assert {r[0] for r in first.select("etl_timestamp").distinct().collect()} == {datetime(2024, 2, 1)}
    one = raw.limit(1).withColumn("event_id", F.lit("EVT_new"))
    one.write.parquet(os.path.join(land, "b"))
    w = run(3)
    after = spark.read.parquet(w["raw_events"])
    assert after.count() == raw.count() + 1
    assert [r.event_id for r in after.where(F.col("etl_timestamp") == F.lit(datetime(2024, 2, 3))).collect()] == ["EVT_new"]


def test_run_etl_does_not_mark_a_broken_file_as_loaded(spark, tmpdir_path):
    raw = P.raw_events(spark, SMALL).drop("source_file")
    src, land, target, done, manifest = (os.path.join(tmpdir_path, d) for d in ("src", "landed", "raw_events", "processed", "loaded"))
    raw.coalesce(1).write.parquet(src)
    with open(os.path.join(src, next(f for f in os.listdir(src) if f.endswith(".parquet"))), "rb") as f:
        whole = f.read()
    os.makedirs(land)

    def run(data):
        with open(os.path.join(land, "a.parquet"), "wb") as f:
            f.write(data)
        return run_etl(spark, land, None, target, done, run_at=datetime(2024, 2, 1), manifest=manifest, buckets=4)
    n = len(whole)
    with pytest.raises(Exception, match="a.parquet"):  # footer whole, data not
        run(whole[:4] + bytes(n // 2) + whole[4 + n // 2:])
    assert not any(os.path.exists(x) for x in (target, manifest, os.path.join(done, "rejected")))
    w = run(whole)
    assert spark.read.parquet(w["raw_events"]).count() == raw.count()
    assert spark.read.parquet(manifest).count() == 1


def test_silver_history_survives_a_new_checkpoint(spark, tmpdir_path):
    from shoptrail.sinks.writers import silver_batch_writer
    wire = P.wire_events(spark, SMALL)
    silver_batch_writer(tmpdir_path, "r1")(wire.limit(3), 0)
    silver_batch_writer(tmpdir_path, "r2")(wire.limit(2), 0)
    assert spark.read.parquet(tmpdir_path).count() == 5
