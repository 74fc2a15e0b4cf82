"""The views, functions and the script by SQL against the DataFrame form."""

import uuid

import pytest
from pyspark.sql import functions as F

from shoptrail.operators import views
from shoptrail.plans import catalog_tables, sql_api
from shoptrail.plans import pipeline as P
from shoptrail.sources.fixtures import FIXTURE_NOW, FIXTURE_TODAY
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def tables(spark):
    raw = P.landed_raw_events(spark, SMALL)
    made = P.processed(spark, SMALL, raw) | {"raw_events": raw, "sessions": catalog_tables._sessions(raw)}
    names = {}
    for name, rows in made.items():
        names[name] = f"{name}_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(names[name])
    sql_api.create_views(spark, names, FIXTURE_NOW)
    return made


def rows(df):
    return sorted(str(sorted(r.asDict().items())) for r in df.collect())


def test_daily_summary(spark, tables):
    want = views.daily_event_summary_of(tables["raw_events"])
    assert rows(spark.sql("SELECT * FROM daily_event_summary")) == rows(want)


def test_journey(spark, tables):
    got = spark.sql("SELECT session_id, order_id, converted, session_sequence FROM customer_journey WHERE customer_id IS NOT NULL")
    buys = tables["purchases"].select("session_id", "order_id")
    want = tables["sessions"].where("customer_id is not null").join(buys, "session_id", "left")
    assert got.count() == want.count()
    assert got.where("converted <> (order_id IS NOT NULL)").count() == 0
    assert got.agg(F.max("session_sequence")).first()[0] == tables["sessions"].join(buys, "session_id", "left").where("customer_id is not null").groupBy(
        "customer_id").count().agg(F.max("count")).first()[0]


def test_product_performance(spark, tables):
    want = tables["product_interactions"].groupBy("product_id").agg(F.count_if(F.col("event_type") == "PRODUCT_VIEW").alias("views"))
    got = spark.sql("SELECT product_id, sum(views) AS views FROM product_performance GROUP BY 1")
    assert rows(got) == rows(want)


def test_realtime_and_quality(spark, tables):
    day = FIXTURE_NOW[:10]
    valid = tables["raw_events"].where(F.col("is_valid") & (F.to_date("timestamp") == day))
    got = {r["metric"]: r["events"] for r in spark.sql("SELECT * FROM realtime_metrics").collect()}
    assert got["events_today"] == valid.count() and got["purchases_today"] == valid.where("event_type = 'PURCHASE'").count()
    quality = spark.sql(f"SELECT * FROM data_quality_summary WHERE event_date = DATE '{FIXTURE_TODAY}'").collect()
    whole = tables["raw_events"].where(F.to_date("timestamp") == FIXTURE_TODAY)
    assert sum(r["total_events"] for r in quality) == whole.count()


def test_script_is_repeatable(spark, tables, tmp_path):
    targets = sql_api.create_targets(spark, str(tmp_path), f"t_{uuid.uuid4().hex}")
    name = f"raw_{uuid.uuid4().hex}"
    tables["raw_events"].createOrReplaceTempView(name)
    for _ in range(2):
        assert spark.sql(sql_api.process_raw_events(name, targets)).first()["status"] == "Raw events processed into 3 tables"
    assert spark.table(targets["purchases"]).count() == tables["purchases"].count()
