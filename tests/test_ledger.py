"""A run that breaks off after any step and is repeated leaves what one clean
run leaves."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shoptrail.plans import etl
from shoptrail.plans import pipeline as P
from tests.conftest import SMALL

TABLES = ["raw_events", "rejected", "page_views", "product_interactions", "purchases", "searches", "user_engagement", "purchase_items"]


class Broken(RuntimeError):
    pass


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Two drops of files: later events, changed ones, rows without an id."""
    base = str(tmp_path_factory.mktemp("landed"))
    raw = P.raw_events(spark, SMALL).drop("source_file")
    n = F.col("offset_id")
    raw.where(n % 3 > 0).coalesce(1).write.parquet(f"{base}/1")
    (raw.where((n % 3 == 0) | (n % 7 == 0)).withColumn("event_type", F.when(n % 7 == 0, F.lit("SEARCH")).otherwise(F.col("event_type")))
     .withColumn("event_id", F.when(n % 13 > 0, F.col("event_id"))).coalesce(1).write.parquet(f"{base}/2"))
    return base


def load(spark, landed, base, drop, day, stop=None):
    def after(step):
        if step == stop:
            raise Broken(step)
    return etl.run_etl(spark, f"{landed}/{drop}", None, f"{base}/raw", f"{base}/done", run_at=datetime(2024, 2, day), buckets=4,
                       manifest=f"{base}/manifest", ledger=f"{base}/ledger", statistics=f"{base}/stats", after_step=after)


def contents(spark, written):
    out = {}
    for name in TABLES:
        rows = spark.read.parquet(written[name])
        out[name] = sorted(str(sorted(r.asDict().items())) for r in rows.collect())
    return out


@pytest.fixture(scope="module")
def clean(spark, landed, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("clean"))
    load(spark, landed, base, 1, 1)
    return contents(spark, load(spark, landed, base, 2, 2))


@pytest.mark.parametrize("step", ["stage", "rejects", "merge", "purchases", "manifest"])
def test_broken_run_repeated_equals_one_clean_run(spark, landed, clean, tmp_path, step):
    base = str(tmp_path)
    load(spark, landed, base, 1, 1)
    with pytest.raises(Broken):
        load(spark, landed, base, 2, 2, stop=step)
    written = load(spark, landed, base, 2, 3)  # a later run ends the broken one under its own time
    assert contents(spark, written) == clean
    stats = spark.read.parquet(f"{base}/stats").orderBy("run_at").collect()
    assert [r["run_at"].day for r in stats][:2] == [1, 2] and sum(r["loaded"] for r in stats[2:]) == 0
    assert etl.last_run(spark, f"{base}/stats").first()["last_run"].day == stats[-1]["run_at"].day


def test_statistics_are_counted_once_and_right(spark, landed, tmp_path):
    load(spark, landed, str(tmp_path), 2, 2)
    row = spark.read.parquet(f"{tmp_path}/stats").first()
    rows = spark.read.parquet(f"{landed}/2")
    none = rows.where("event_id is null").count()
    assert (row["extracted_files"], row["rejected"], row["loaded"]) == (rows.count(), none, rows.where("event_id is not null").count())
    assert row["extracted_store"] == 0 and row["duplicates_removed"] == 0 and row["seconds"] > 0
