"""Bucketed copy-on-write MERGE rewrites only touched buckets."""

import os

from pyspark.sql import functions as F

from shoptrail.operators.dedup import BUCKET_COL, keep_first, merge_by_key, merge_into_buckets
from shoptrail.plans import pipeline as P
from tests.conftest import SMALL


def _mtimes(path):
    return {d: os.path.getmtime(os.path.join(path, d)) for d in os.listdir(path) if d.startswith(BUCKET_COL)}


def test_bucket_merge_equals_full_merge(spark, tmpdir_path):
    raw = keep_first(P.raw_events(spark, SMALL))
    first = raw.filter(F.col("timestamp") < F.lit("2024-01-20").cast("timestamp_ntz"))
    target = os.path.join(tmpdir_path, "raw_events")
    merge_into_buckets(spark, target, first, os.path.join(tmpdir_path, "stage1"), buckets=32)
    before = _mtimes(target)
    # a small batch: three updated events and two new ones
    upd = first.orderBy("event_id").limit(3).withColumn("event_type", F.lit("UPDATED"))
    new = raw.filter(F.col("timestamp") >= F.lit("2024-01-20").cast("timestamp_ntz")).orderBy("event_id").limit(2)
    batch = upd.unionByName(new)
    merge_into_buckets(spark, target, batch, os.path.join(tmpdir_path, "stage2"), buckets=32)
    after = _mtimes(target)
    changed = {b for b in after if after[b] != before.get(b)}
    assert 0 < len(changed) <= 5 and len(after) >= len(before)
    got = spark.read.parquet(target).drop(BUCKET_COL)
    want = merge_by_key(first, batch)
    cols = sorted(want.columns)
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == \
        sorted(map(tuple, want.select(*cols).collect()), key=repr)
    assert got.filter(F.col("event_type") == "UPDATED").count() == 3
