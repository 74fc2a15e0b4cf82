"""Rollups: sessions, customer 360, top customers (A8-A10, X7 batch form)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.functions.events import days_between, duration_seconds, money_avg
from shoptrail.operators.route import with_payload


def sessions(raw: DataFrame) -> DataFrame:
    """One row per session from valid routed events.

    start/end/duration, first device, traffic source and landing page of the
    first page view, exit page of the last, page views, unique pages, bounce
    rate (1 when one page view), conversion flag and purchase total (0 when
    none). A single grouped aggregate: partial aggregation runs before the
    shuffle, so a very long session is combined map-side."""
    routed = (S.PAGE_VIEW_TYPES + S.PRODUCT_INTERACTION_TYPES + S.PURCHASE_TYPES
              + S.SEARCH_TYPES + S.USER_ENGAGEMENT_TYPES)
    d = with_payload(raw.filter(F.col("event_type").isin(*routed) & (F.col("is_valid") == F.lit(True))
                                & F.col("session_id").isNotNull()))
    is_pv = F.col("event_type") == "PAGE_VIEW"
    is_buy = F.col("event_type") == "PURCHASE"
    order = F.struct(F.col("timestamp"), F.col("event_id"))
    pv_order = F.when(is_pv, order)
    agg = d.groupBy("session_id").agg(
        F.min("customer_id").alias("customer_id"),
        F.min("timestamp").alias("start_time"),
        F.max("timestamp").alias("end_time"),
        F.min_by(F.col("_p.device_type"), order).alias("device_type"),
        F.min_by(F.when(is_pv, F.col("_p.traffic_source")), pv_order).alias("traffic_source"),
        F.min_by(F.when(is_pv, F.col("_p.page_url")), pv_order).alias("landing_page"),
        F.max_by(F.when(is_pv, F.col("_p.page_url")), pv_order).alias("exit_page"),
        F.count_if(is_pv).alias("page_views"),
        F.countDistinct(F.when(is_pv, F.col("_p.page_url"))).alias("unique_pages"),
        F.max(is_buy).alias("conversion_flag"),
        F.sum(F.when(is_buy, F.col("_p.total_amount"))).alias("_total"))
    return agg.select(
        "session_id", "customer_id", "start_time", "end_time",
        duration_seconds("start_time", "end_time").alias("duration_seconds"),
        "device_type", "traffic_source", "landing_page", "exit_page",
        F.col("page_views").cast("int").alias("page_views"),
        F.col("unique_pages").cast("int").alias("unique_pages"),
        F.when(F.col("page_views") == 1, F.lit(1.0)).otherwise(F.lit(0.0)).alias("bounce_rate"),
        "conversion_flag",
        F.coalesce(F.col("_total"), F.lit(0).cast("decimal(12,2)")).cast("double").alias("total_purchase_amount"))


def customers_360(purchases: DataFrame, customers: DataFrame, as_of) -> DataFrame:
    """A10: per customer, orders, spend, average order value, last purchase
    date and days since it. Purchases are aggregated per customer first, then
    joined to the customer dimension; customers without orders get 0."""
    per = purchases.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total_amount").alias("_spent"),
        F.max(F.to_date("timestamp")).alias("last_purchase_date"))
    j = customers.join(per, "customer_id", "left")
    spent = F.coalesce(F.col("_spent"), F.lit(0).cast("decimal(12,2)"))
    orders = F.coalesce(F.col("total_orders"), F.lit(0))
    return j.select(
        *customers.columns,
        orders.cast("int").alias("total_orders"),
        spent.cast("double").alias("total_spent"),
        F.coalesce(money_avg(spent, orders), F.lit(0.0)).alias("avg_order_value"),
        "last_purchase_date",
        days_between("last_purchase_date", as_of).alias("days_since_last_purchase"))


def top_customers(journey: DataFrame, n: int = 10) -> DataFrame:
    """Sessions, converted sessions and revenue per customer; the top ``n``
    by revenue (ties by customer id)."""
    per = journey.groupBy("customer_id").agg(
        F.countDistinct("session_id").alias("total_sessions"),
        F.countDistinct(F.when(F.col("converted"), F.col("session_id"))).alias("converted_sessions"),
        F.coalesce(F.sum("purchase_amount"), F.lit(0).cast("decimal(12,2)")).cast("double").alias("total_revenue"))
    return per.orderBy(F.col("total_revenue").desc_nulls_last(), F.col("customer_id").asc_nulls_last()).limit(n)
