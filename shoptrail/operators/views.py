"""The five analytics views (V1-V5) as DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.functions.events import pct
from shoptrail.operators.dedup import union_by_name
from shoptrail.operators.validate import on_day, processed_filter


def _daily(df: DataFrame, event_type=None, approx: bool = False) -> DataFrame:
    et = F.col("event_type") if event_type is None else F.lit(event_type)
    distinct = (lambda c: F.approx_count_distinct(c, 0.01)) if approx else F.countDistinct
    return (df.select(F.to_date("timestamp").alias("event_date"), et.alias("event_type"),
                      "customer_id", "session_id")
              .groupBy("event_date", "event_type")
              .agg(F.count(F.lit(1)).alias("event_count"),
                   distinct("customer_id").alias("unique_customers"),
                   distinct("session_id").alias("unique_sessions")))


def daily_event_summary(page_views: DataFrame, product_interactions: DataFrame,
                        purchases: DataFrame, searches: DataFrame,
                        user_engagement: DataFrame, approx: bool = False) -> DataFrame:
    """V1: per day and type, events, distinct customers, distinct sessions;
    UNION ALL of the five processed tables (page views, purchases and searches
    carry their literal type).

    Exact distinct counts expand each row once per distinct column before the
    shuffle; ``approx=True`` uses HyperLogLog sketches (1 % relative error),
    which merge map-side in fixed memory -- an opt-in for very large days."""
    return union_by_name([
        _daily(page_views, "PAGE_VIEW", approx),
        _daily(product_interactions, None, approx),
        _daily(purchases, "PURCHASE", approx),
        _daily(searches, "SEARCH", approx),
        _daily(user_engagement, None, approx),
    ])


def daily_event_summary_of(raw: DataFrame, approx: bool = False) -> DataFrame:
    """V1 straight from RAW_EVENTS in one scan: a type belongs to one processed
    table, so grouping the rows that any of them takes by day and type gives
    the union of the five."""
    return _daily(processed_filter(raw, S.PROCESSED_TYPES), None, approx)


def customer_journey(sessions: DataFrame, purchases: DataFrame, chunk: str = "hour") -> DataFrame:
    """V2: sessions LEFT JOIN purchases on session; ``converted``,
    ``purchase_amount``, and ``session_sequence`` numbering the joined rows per
    customer by start time (ties: session id, order id). Sessions without a
    customer are numbered as one key, so ``chunk`` bounds their tasks."""
    from shoptrail.operators.ordered import sequence_number
    p = purchases.select("session_id", "order_id", F.col("total_amount").alias("purchase_amount"))
    j = sessions.select("customer_id", "session_id", "start_time", "duration_seconds",
                        "page_views", "device_type", "traffic_source").join(p, "session_id", "left")
    j = j.withColumn("converted", F.col("order_id").isNotNull())
    j = j.withColumn("_ck", F.coalesce(F.col("customer_id"), F.lit("\u0000")))
    j = sequence_number(j, ["_ck"], "start_time", ["session_id", "order_id"], "session_sequence", chunk=chunk)
    return j.drop("_ck", "order_id")


def _product_sides(interactions: DataFrame, items: DataFrame):
    inter = (interactions.groupBy("product_id", "product_name", "product_category", "product_brand")
             .agg(F.count_if(F.col("event_type") == "PRODUCT_VIEW").alias("views"),
                  F.count_if(F.col("event_type") == "ADD_TO_CART").alias("cart_adds"),
                  F.count(F.lit(1)).alias("_n_inter")))
    it = (items.groupBy("product_id")
          .agg(F.countDistinct("order_id").alias("purchases"),
               F.sum("quantity").alias("units_sold"),
               F.sum("line_total").alias("revenue"),
               F.count(F.lit(1)).alias("_n_items")))
    return inter, it


def product_performance(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """V3 corrected: each side aggregated per product first, then joined, so
    views and cart adds are not multiplied by item rows (and vice versa)."""
    inter, it = _product_sides(interactions, items)
    j = inter.join(it, "product_id", "left")
    purchases = F.coalesce(F.col("purchases"), F.lit(0))
    return j.select(
        "product_id", "product_name", "product_category", "product_brand",
        "views", "cart_adds", purchases.alias("purchases"),
        F.col("units_sold").cast("long").alias("units_sold"),
        F.col("revenue").cast("double").alias("revenue"),
        pct("cart_adds", "views").alias("view_to_cart_rate"),
        pct(purchases, "cart_adds").alias("cart_to_purchase_rate"))


def product_performance_literal(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """V3 as written: interactions LEFT JOIN items on product, then grouped.

    The join repeats each interaction once per item row of its product, so
    views/cart adds are multiplied by the item count and units/revenue by the
    interaction count. The same numbers are computed here from per-product
    aggregates -- the many-to-many pairs are never materialised.
    Grouping is by the four product columns, as in the view."""
    inter_keys = ["product_id", "product_name", "product_category", "product_brand"]
    inter = (interactions.groupBy(*inter_keys)
             .agg(F.count_if(F.col("event_type") == "PRODUCT_VIEW").alias("_v"),
                  F.count_if(F.col("event_type") == "ADD_TO_CART").alias("_c"),
                  F.count(F.lit(1)).alias("_n")))
    it = (items.groupBy("product_id")
          .agg(F.countDistinct("order_id").alias("purchases"),
               F.sum("quantity").alias("_q"), F.sum("line_total").alias("_rev"),
               F.count(F.lit(1)).alias("_m")))
    j = inter.join(it, "product_id", "left")
    mult = F.coalesce(F.col("_m"), F.lit(1))
    views = F.col("_v") * mult
    carts = F.col("_c") * mult
    purchases = F.coalesce(F.col("purchases"), F.lit(0))
    return j.select(
        *inter_keys, views.alias("views"), carts.alias("cart_adds"), purchases.alias("purchases"),
        (F.col("_q") * F.col("_n")).cast("long").alias("units_sold"),
        (F.col("_rev") * F.col("_n")).cast("double").alias("revenue"),
        pct(carts, views).alias("view_to_cart_rate"),
        pct(purchases, carts).alias("cart_to_purchase_rate"))


def realtime_metrics(page_views: DataFrame, product_interactions: DataFrame, purchases: DataFrame,
                     searches: DataFrame, user_engagement: DataFrame, as_of) -> DataFrame:
    """V4: one row of today's totals (``as_of`` is the day). Counts are 0 on an
    empty day, revenue is NULL. Scalar subqueries become conditional
    aggregates over the same one-day union."""
    sel = ["event_type", "customer_id", "session_id"]
    day = [on_day(page_views, "timestamp", as_of).select(F.lit("PAGE_VIEW").alias("event_type"), *sel[1:], F.lit(None).cast("decimal(12,2)").alias("total_amount")),
           on_day(product_interactions, "timestamp", as_of).select(*sel, F.lit(None).cast("decimal(12,2)").alias("total_amount")),
           on_day(purchases, "timestamp", as_of).select(F.lit("PURCHASE").alias("event_type"), *sel[1:], "total_amount"),
           on_day(searches, "timestamp", as_of).select(F.lit("SEARCH").alias("event_type"), *sel[1:], F.lit(None).cast("decimal(12,2)").alias("total_amount")),
           on_day(user_engagement, "timestamp", as_of).select(*sel, F.lit(None).cast("decimal(12,2)").alias("total_amount"))]
    return _day_totals(union_by_name(day))


def realtime_metrics_of(raw: DataFrame, as_of) -> DataFrame:
    """V4 straight from RAW_EVENTS: one scan with the day as a range filter;
    the payload is parsed for purchases only."""
    paid = F.from_json(F.when(F.col("event_type").isin(*S.PURCHASE_TYPES), F.col("event_data")), S.PAYLOAD_SCHEMA)["total_amount"]
    day = on_day(processed_filter(raw, S.PROCESSED_TYPES), "timestamp", as_of)
    return _day_totals(day.select("event_type", "customer_id", "session_id", paid.alias("total_amount")))


def _day_totals(u: DataFrame) -> DataFrame:
    et = F.col("event_type")
    return u.agg(
        F.count(F.lit(1)).alias("total_events_today"),
        F.countDistinct("customer_id").alias("unique_customers_today"),
        F.countDistinct("session_id").alias("unique_sessions_today"),
        F.count_if(et == "PAGE_VIEW").alias("page_views_today"),
        F.count_if(et.isin(*S.REALTIME_PRODUCT_TYPES)).alias("product_interactions_today"),
        F.count_if(et == "PURCHASE").alias("purchases_today"),
        F.count_if(et == "SEARCH").alias("searches_today"),
        F.sum("total_amount").cast("double").alias("revenue_today"))


def data_quality_summary(raw: DataFrame, corrected: bool = True) -> DataFrame:
    """V5: per ingestion day: total, valid, invalid, score % (2 dp) and events
    with issues. ``corrected`` counts a row as having issues only when its
    issue list is non-empty; the literal form counts non-NULL lists (which
    includes ``[]``)."""
    issues = F.col("data_quality_issues")
    if corrected:
        has = issues.isNotNull() & (F.coalesce(F.json_array_length(issues), F.lit(0)) > 0)
    else:
        has = issues.isNotNull()
    return (raw.groupBy(F.to_date("ingestion_time").alias("date"))
               .agg(F.count(F.lit(1)).alias("total_events"),
                    F.count_if(F.col("is_valid") == F.lit(True)).alias("valid_events"),
                    F.count_if(F.col("is_valid") == F.lit(False)).alias("invalid_events"),
                    F.count_if(has).alias("events_with_issues"))
               .withColumn("quality_score_pct", pct("valid_events", "total_events"))
               .select("date", "total_events", "valid_events", "invalid_events",
                       "quality_score_pct", "events_with_issues"))


def journey_of(journey: DataFrame, customer_id: str) -> DataFrame:
    """one customer's journey in session order (a point filter that
    pushes down to the journey's inputs, then a sort of that customer's rows)."""
    return (journey.filter(F.col("customer_id") == F.lit(customer_id))
                   .orderBy(F.col("session_sequence").asc_nulls_last()))
