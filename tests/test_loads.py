"""Loads that are repeated, broken off, or meet files that cannot be read."""

import os

import pytest
from pyspark.sql import functions as F

from shoptrail.operators.land import store_of
from shoptrail.plans import etl
from shoptrail.plans import pipeline as P
from shoptrail.sinks import loads
from tests.conftest import SMALL


def test_two_stores_replace_a_batch_that_comes_again(spark, tmp_path):
    a, b = f"{tmp_path}/a", f"{tmp_path}/b"
    batch = spark.range(200).select(F.concat(F.lit("e"), "id").alias("event_id"), F.struct("id").alias("payload"))
    write = loads.two_store_batches(a, b)
    for n in (0, 1, 1):
        write(batch.where(F.col("payload.id") % 2 == n), n)
    files, store = spark.read.parquet(a), spark.read.parquet(b)
    assert "payload_id" in files.columns and files.count() + store.count() == 200
    assert files.where(store_of("event_id") != "parquet").count() == store.where(store_of("event_id") != "duckdb").count() == 0
    assert files.where("storage_type is null or ingestion_time is null").count() == 0


def test_bulk_append_reports_files_that_give_no_row(spark, tmp_path):
    src, table, manifest = (f"{tmp_path}/{x}" for x in ("src", "table", "manifest"))
    for n in (3, 5):
        spark.range(n).coalesce(1).write.parquet(f"{src}/n{n}")
    broken = f"{src}/broken.parquet"
    with open(broken, "wb") as f:
        f.write(b"PAR1 not a table PAR1")
    report = {r["rows_loaded"]: r for r in loads.bulk_append(spark, src, table, manifest).collect()}
    assert sorted(report) == [0, 3, 5] and report[3]["success"] and report[3]["error"] is None
    assert report[0]["file"].endswith("broken.parquet") and not report[0]["success"] and report[0]["error"]
    whole = spark.range(7).coalesce(1)  # the broken file comes again, whole
    whole.write.parquet(f"{tmp_path}/whole")
    part = next(x for x in os.listdir(f"{tmp_path}/whole") if x.endswith(".parquet"))
    os.replace(f"{tmp_path}/whole/{part}", broken)
    spark.catalog.clearCache()
    if os.path.exists(f"{src}/.broken.parquet.crc"):
        os.remove(f"{src}/.broken.parquet.crc")
    again = loads.bulk_append(spark, src, table, manifest).collect()
    assert [(r["rows_loaded"], r["success"]) for r in again] == [(7, True)]
    assert spark.read.parquet(table).count() == 15
    assert loads.bulk_append(spark, src, table, manifest) is None


def test_json_copy_repeats_without_its_manifest(spark, tmp_path):
    src, table = f"{tmp_path}/src", f"{tmp_path}/table"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as f:
        f.write('[\n {"event_id": "e1", "customer_id": null},\n {"event_id": "e2", "x": [1, {"y": 2}]}\n]')
    with open(f"{src}/b.json", "w") as f:
        f.write("[]")
    for run in range(2):  # the second as if the first had broken off before it noted its files
        assert loads.copy_json_files(spark, src, table, f"{tmp_path}/manifest{run}") == 2
    rows = {r["event_id"]: r["event_data"] for r in spark.read.parquet(table).collect()}
    assert spark.read.parquet(table).count() == 2 and '"customer_id":null' in rows["e1"].replace(" ", "") and '{"y":2}' in rows["e2"]
    assert loads.copy_json_files(spark, src, table, f"{tmp_path}/manifest1") == 0


def test_scheduled_load_goes_on_after_a_broken_trigger(spark, tmp_path, monkeypatch):
    raw_dir, out, checkpoint = (f"{tmp_path}/{x}" for x in ("raw", "out", "checkpoint"))
    raw = P.landed_raw_events(spark, SMALL)
    raw.write.parquet(raw_dir)
    build = etl._builders

    def broken(products):
        return {**build(products), "searches": lambda raw: 1 / 0}
    monkeypatch.setattr(etl, "_builders", broken)
    with pytest.raises(Exception):
        etl.start_scheduled_load(spark, raw_dir, out, checkpoint, available_now=True).awaitTermination()
    first = spark.read.parquet(f"{out}/page_views").count()
    assert first > 0 and not os.path.exists(f"{out}/searches")
    monkeypatch.setattr(etl, "_builders", build)
    etl.start_scheduled_load(spark, raw_dir, out, checkpoint, available_now=True).awaitTermination()
    assert spark.read.parquet(f"{out}/page_views").count() == first
    for name in ("page_views", "searches", "purchases"):
        assert spark.read.parquet(f"{out}/{name}").count() == build(None)[name](raw).count()
