"""Property tests: de-duplication, merge and routing invariants."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.operators import metrics, route, views
from shoptrail.operators.dedup import keep_first, merge_by_key
from shoptrail.operators.views import daily_event_summary
from shoptrail.plans import pipeline as P
from shoptrail.sources.fixtures import FIXTURE_TODAY
from tests.conftest import SMALL

ids = st.sampled_from(["e1", "e2", "e3", "e4", None])
rows = st.lists(st.tuples(ids, st.integers(0, 3), st.integers(0, 50)), min_size=0, max_size=25)
def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows)
def test_keep_first_is_idempotent_and_complete(spark, data):
    df = spark.createDataFrame(data, "event_id string, source_rank int, offset_id long")
    once = keep_first(df)
    assert _rows(keep_first(once)) == _rows(once)
    assert once.count() == len({r[0] for r in data})


@SETTINGS
@given(rows, rows)
def test_merge_replay_is_stable(spark, tgt, src):
    t = keep_first(spark.createDataFrame(tgt, "event_id string, source_rank int, offset_id long")
                   .filter(F.col("event_id").isNotNull()))
    s = keep_first(spark.createDataFrame(src, "event_id string, source_rank int, offset_id long"))
    once = merge_by_key(t, s, update_cols=["offset_id"])
    twice = merge_by_key(once, s, update_cols=["offset_id"])
    assert _rows(once) == _rows(twice)
    keys = {r[0] for r in tgt if r[0]} | {r[0] for r in src if r[0]}
    assert {r.event_id for r in once.collect()} == keys


def test_routing_partitions_valid_rows_once(spark):
    raw = P.raw_events(spark, SMALL)
    routed = (S.PAGE_VIEW_TYPES + S.PRODUCT_INTERACTION_TYPES + S.PURCHASE_TYPES + S.SEARCH_TYPES
              + S.USER_ENGAGEMENT_TYPES)
    expected = raw.filter(F.col("is_valid") & F.col("event_type").isin(*routed)).count()
    parts = [route.page_views(raw), route.product_interactions(raw), route.purchases(raw),
             route.searches(raw), route.user_engagement(raw)]
    ids = [r.event_id for p in parts for r in p.select("event_id").collect()]
    assert len(ids) == expected == len(set(ids))


def test_approx_daily_summary_close_to_exact(spark):
    t = P.processed(spark, SMALL)
    args = [t["page_views"], t["product_interactions"], t["purchases"], t["searches"], t["user_engagement"]]
    exact = {(r.event_date, r.event_type): r for r in daily_event_summary(*args).collect()}
    approx = {(r.event_date, r.event_type): r for r in daily_event_summary(*args, approx=True).collect()}
    assert exact.keys() == approx.keys()
    for k, r in exact.items():
        assert r.event_count == approx[k].event_count
        assert abs(r.unique_customers - approx[k].unique_customers) <= max(1, 0.05 * r.unique_customers)


def test_one_scan_views_equal_the_union_of_tables(spark):
    raw = P.landed_raw_events(spark, SMALL)
    t = P.processed(spark, SMALL, raw)
    args = [t["page_views"], t["product_interactions"], t["purchases"], t["searches"], t["user_engagement"]]
    assert _rows(views.daily_event_summary_of(raw)) == _rows(daily_event_summary(*args))
    assert _rows(views.realtime_metrics_of(raw, FIXTURE_TODAY)) == _rows(views.realtime_metrics(*args, FIXTURE_TODAY))
    counts = {"raw_events": raw, **t}
    assert _rows(metrics.processed_counts(raw)) == _rows(metrics.table_counts(counts))


def test_valid_plus_invalid_is_total(spark):
    from shoptrail.operators.validate import split_valid
    wire = P.wire_events(spark, SMALL)
    valid, invalid = split_valid(wire, as_of="2024-01-31 00:00:00")
    v = {r.event_id for r in valid.select("event_id").collect()}
    i = {r.event_id for r in invalid.select("event_id").collect()}
    assert len(v) + len(i) == wire.count() and not (v & i)
