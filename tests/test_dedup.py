"""De-duplication, merge and incremental-load properties."""

import pytest
from pyspark.sql import functions as F

from shoptrail.operators import dedup
from shoptrail.operators.dedup import incremental_append, keep_first, last_write_wins, merge_by_key, unseen

SCHEMA = ("event_id string, event_type string, source_rank int, ingestion_time timestamp_ntz, "
          "source_file string, offset_id long")


def test_keep_first_order_and_nulls(spark):
    rows = [("e1", "A", 1, "2024-01-02 00:00:00", "duckdb", 1), ("e1", "B", 0, "2024-01-01 00:00:00", "f1", 2),
            ("e2", "C", 1, "2024-01-01 00:00:00", "duckdb", 3), ("e2", "D", 1, "2024-01-03 00:00:00", "duckdb", 4),
            (None, "E", 0, "2024-01-01 00:00:00", "f1", 5), (None, "F", 0, "2024-01-01 00:00:00", "f1", 6)]
    df = spark.createDataFrame(rows, "event_id string, event_type string, source_rank int, ingestion_time string, "
                                     "source_file string, offset_id long").withColumn(
        "ingestion_time", F.col("ingestion_time").cast("timestamp_ntz"))
    got = {r.event_id: r.event_type for r in keep_first(df).collect()}
    assert got == {"e1": "B", "e2": "D", None: "E"}  # files first; then newest; NULL ids collapse
    assert keep_first(keep_first(df)).count() == keep_first(df).count() == 3  # idempotent
    lw = {r.event_id: r.event_type for r in last_write_wins(df).collect()}
    assert lw["e2"] == "D" and lw["e1"] == "A"


def test_merge_semantics_and_replay(spark):
    cols = ("event_id string, event_type string, is_valid boolean, source_file string, storage_type string, "
            "etl_run_id string, etl_timestamp string")
    target = spark.createDataFrame([("e1", "A", True, "old.parquet", "parquet", "r1", "t1"),
                                    ("e2", "B", True, "old.parquet", "duckdb", "r1", "t1")], cols)
    source = spark.createDataFrame([("e2", "B2", False, "new.parquet", "parquet", "r2", "t2"),
                                    ("e3", "C", True, "new.parquet", "parquet", "r2", "t2"),
                                    (None, "X", True, "new.parquet", "parquet", "r2", "t2")], cols)
    merged = merge_by_key(target, source, update_cols=["event_type", "is_valid", "etl_timestamp"])
    got = {r.event_id: r.asDict() for r in merged.collect()}
    assert set(got) == {"e1", "e2", "e3"}  # NULL key rejected
    assert got["e2"]["event_type"] == "B2" and got["e2"]["is_valid"] is False
    assert got["e2"]["source_file"] == "old.parquet" and got["e2"]["etl_run_id"] == "r1"  # kept from target
    assert got["e2"]["etl_timestamp"] == "t2"
    assert got["e3"]["etl_run_id"] == "r2"
    again = merge_by_key(merged, source, update_cols=["event_type", "is_valid", "etl_timestamp"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))  # replay-safe


def test_unseen_and_incremental(spark):
    tgt = spark.createDataFrame([("e1",), ("e2",)], "event_id string")
    src = spark.createDataFrame([("e1", 1), ("e3", 2), ("e3", 3), (None, 4)], "event_id string, offset_id long")
    assert sorted(r.event_id for r in unseen(src, tgt).collect()) == ["e3", "e3"]
    assert [r.event_id for r in incremental_append(src, tgt).collect()] == ["e3"]


def test_merge_keeps_columns_the_source_lacks(spark):
    target = spark.createDataFrame([("a", "s1", "x"), ("b", "s2", "y")], "event_id string, session_id string, event_type string")
    source = spark.createDataFrame([("a", "z"), ("c", "w")], "event_id string, event_type string")
    got = {r["event_id"]: (r["session_id"], r["event_type"]) for r in dedup.merge_by_key(target, source).collect()}
    assert got == {"a": ("s1", "z"), "b": ("s2", "y"), "c": (None, "w")}


def test_failing_target_read_leaves_the_table(spark, tmpdir_path):
    path, rows = f"{tmpdir_path}/t", spark.createDataFrame([("a", "x"), ("b", "y")], "event_id string, event_type string")
    dedup.merge_into_buckets(spark, path, rows, f"{tmpdir_path}/s1", buckets=4)

    class Failing:
        _jvm, _jsc = spark._jvm, spark._jsc

        @property
        def read(self):
            raise OSError("injected")
    with pytest.raises(OSError):
        dedup.merge_into_buckets(Failing(), path, rows.limit(1), f"{tmpdir_path}/s2", buckets=4)
    assert spark.read.parquet(path).count() == 2
