"""Registry of named queries: Spark plan + DuckDB oracle per name.

Every query reads the whole driver tables (through the adapter) and returns
a DataFrame; ``ORACLES`` holds the SQL twin where one exists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.operators import views
from shoptrail.plans import oracles as O
from shoptrail.plans import pipeline as P

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# --------------------------------------------------------------------------
# V1 daily event summary (flagship)
# --------------------------------------------------------------------------

@register("daily_event_summary", O.q("""
SELECT CAST(timestamp AS DATE) AS event_date, 'PAGE_VIEW' AS event_type, COUNT(*) AS event_count,
       COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT session_id) AS unique_sessions
FROM pv GROUP BY 1, 2
UNION ALL
SELECT CAST(timestamp AS DATE), event_type, COUNT(*), COUNT(DISTINCT customer_id), COUNT(DISTINCT session_id)
FROM pi GROUP BY 1, 2
UNION ALL
SELECT CAST(timestamp AS DATE), 'PURCHASE', COUNT(*), COUNT(DISTINCT customer_id), COUNT(DISTINCT session_id)
FROM pu GROUP BY 1, 2
UNION ALL
SELECT CAST(timestamp AS DATE), 'SEARCH', COUNT(*), COUNT(DISTINCT customer_id), COUNT(DISTINCT session_id)
FROM se GROUP BY 1, 2
UNION ALL
SELECT CAST(timestamp AS DATE), event_type, COUNT(*), COUNT(DISTINCT customer_id), COUNT(DISTINCT session_id)
FROM ue GROUP BY 1, 2
"""))
def daily_event_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.daily_event_summary_of(P.raw_events(spark, sf_dir))


# --------------------------------------------------------------------------
# Validation and enrichment
# --------------------------------------------------------------------------

from shoptrail.operators import dedup, enrich, metrics, quality, rollups, route, validate  # noqa: E402
from shoptrail.sources.fixtures import FIXTURE_NOW, FIXTURE_TODAY, ORDERS_TODAY  # noqa: E402

WV = O.VALID_SQL


def _flagged(spark, sf_dir):
    return validate.with_validity(P.wire_events(spark, sf_dir), as_of=FIXTURE_NOW)


@register("valid_events", O.q(f"""
SELECT event_id, event_type, customer_id, {O.CATEGORY_SQL} AS event_category,
       CAST({O.SCORE_SQL} AS INTEGER) AS business_value_score,
       '{S.PROCESSOR_VERSION}' AS processor_version
FROM raw WHERE {WV}
"""))
def valid_events(spark, sf_dir):
    valid, _ = validate.split_valid(P.wire_events(spark, sf_dir), as_of=FIXTURE_NOW)
    return enrich.enrich_events(valid).select(
        "event_id", "event_type", "customer_id", "event_category", "business_value_score", "processor_version")


@register("invalid_events", O.q(f"""
SELECT event_id, event_type, customer_id, invalid_field FROM raw WHERE NOT {WV}
"""))
def invalid_events(spark, sf_dir):
    _, invalid = validate.split_valid(P.wire_events(spark, sf_dir), as_of=FIXTURE_NOW)
    return invalid.select("event_id", "event_type", "customer_id", "invalid_field")


@register("category_value_rollup", O.q(f"""
SELECT {O.CATEGORY_SQL} AS event_category, COUNT(*) AS events,
       CAST(SUM({O.SCORE_SQL}) AS BIGINT) AS total_score
FROM raw WHERE {WV} GROUP BY 1
"""))
def category_value_rollup(spark, sf_dir):
    valid, _ = validate.split_valid(P.wire_events(spark, sf_dir), as_of=FIXTURE_NOW)
    return (enrich.enrich_events(valid).groupBy("event_category")
            .agg(F.count(F.lit(1)).alias("events"), F.sum("business_value_score").alias("total_score")))


@register("quality_running", O.q(f"""
, fl AS (SELECT event_id, timestamp, coalesce(customer_id, '~') AS ck, {WV} AS ok FROM raw)
SELECT event_id,
  COUNT(*) OVER w AS running_processed,
  CAST(SUM(CASE WHEN ok THEN 1 ELSE 0 END) OVER w AS BIGINT) AS running_valid,
  {O.pct_sql("SUM(CASE WHEN ok THEN 1 ELSE 0 END) OVER w", "COUNT(*) OVER w", 1)} AS running_quality_pct
FROM fl
WINDOW w AS (PARTITION BY ck, CAST(timestamp AS DATE) ORDER BY timestamp, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""))
def quality_running(spark, sf_dir):
    d = (_flagged(spark, sf_dir)
         .withColumn("_ck", F.coalesce(F.col("customer_id"), F.lit("~")))
         .withColumn("_day", F.to_date("timestamp")))
    out = quality.running_quality(d, ["_ck", "_day"], "timestamp", "event_id")
    return out.select("event_id", "running_processed", "running_valid", "running_quality_pct")


@register("dq_declared_invalid", O.q("""
SELECT invalid_field, COUNT(*) AS events FROM raw WHERE invalid_field IS NOT NULL GROUP BY 1
"""))
def dq_declared_invalid(spark, sf_dir):
    return quality.declared_invalid_breakdown(P.wire_events(spark, sf_dir))


# --------------------------------------------------------------------------
# Data quality (Q1, Q2, Q5, Q8, Q9, V5)
# --------------------------------------------------------------------------

@register("dq_issue_tags", O.q("""
SELECT issue, COUNT(*) AS events FROM (SELECT unnest(issues) AS issue FROM raw) GROUP BY 1
"""))
def dq_issue_tags(spark, sf_dir):
    return quality.issue_counts(P.raw_events(spark, sf_dir))


@register("dq_required_nulls", O.q("""
SELECT COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE event_id IS NULL) AS missing_event_id,
  COUNT(*) FILTER (WHERE event_type IS NULL) AS missing_event_type,
  COUNT(*) FILTER (WHERE timestamp IS NULL) AS missing_timestamp,
  COUNT(*) FILTER (WHERE event_id IS NULL) + COUNT(*) FILTER (WHERE event_type IS NULL)
    + COUNT(*) FILTER (WHERE timestamp IS NULL) AS missing_total
FROM raw
"""))
def dq_required_nulls(spark, sf_dir):
    return quality.required_nulls(dedup.keep_first(P.raw_events(spark, sf_dir)))


@register("dq_future_ts", O.q(f"""
SELECT COUNT(*) FILTER (WHERE timestamp > {O.NOW}) AS future_events, COUNT(*) AS total_rows FROM raw
"""))
def dq_future_ts(spark, sf_dir):
    return quality.future_timestamps(P.raw_events(spark, sf_dir), as_of=FIXTURE_NOW)


def _two_sources(spark, sf_dir):
    """Files (every landed event) + the local store (its half of the two-way
    split, re-ingested a day later): the ETL's two extracts."""
    raw = P.landed_raw_events(spark, sf_dir)
    files = raw.withColumn("source_rank", F.lit(0))
    store = (raw.filter(F.col("storage_type") == "duckdb")
             .withColumn("source_file", F.lit("duckdb"))
             .withColumn("ingestion_time", F.col("ingestion_time") + F.expr("INTERVAL 1 DAY"))
             .withColumn("source_rank", F.lit(1)))
    return dedup.union_by_name([files, store])


@register("dq_key_uniqueness", O.q("""
SELECT event_id, COUNT(*) AS copies FROM (
  SELECT event_id FROM raw UNION ALL SELECT event_id FROM raw WHERE storage_type = 'duckdb')
GROUP BY 1 HAVING COUNT(*) > 1
"""))
def dq_key_uniqueness(spark, sf_dir):
    return quality.duplicate_keys(_two_sources(spark, sf_dir), "event_id")


@register("dq_order_reconcile", O.q("""

, late AS (SELECT event_id, order_id, subtotal, discount_amount, CAST(substr(order_id, 5) AS BIGINT) AS n,
  CAST(tax_amount + CASE WHEN CAST(substr(order_id, 5) AS BIGINT) % 5 = 0 THEN 0.03 ELSE 0.02 END AS DECIMAL(12,2)) AS tax_amount,
  CAST(shipping_cost + CASE WHEN CAST(substr(order_id, 5) AS BIGINT) % 7 = 0 THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS shipping_cost,
  CAST(total_amount + CASE WHEN CAST(substr(order_id, 5) AS BIGINT) % 3 = 0 THEN 1 ELSE 0.02 END AS DECIMAL(12,2)) AS total_amount
  FROM pu),
ruled AS (SELECT *, abs(total_amount - (subtotal + tax_amount + shipping_cost - discount_amount)) > 0.02 AS total_mismatch,
  abs(tax_amount - round(subtotal * 0.08, 2)) > 0.02 AS tax_mismatch,
  shipping_cost <> CASE WHEN subtotal > 50 THEN 0 ELSE 9.99 END AS shipping_mismatch FROM late)
SELECT event_id, order_id, CAST(subtotal AS DOUBLE) AS subtotal, CAST(tax_amount AS DOUBLE) AS tax_amount,
  CAST(shipping_cost AS DOUBLE) AS shipping_cost, CAST(discount_amount AS DOUBLE) AS discount_amount,
  CAST(total_amount AS DOUBLE) AS total_amount, total_mismatch, tax_mismatch, shipping_mismatch
FROM ruled WHERE total_mismatch OR tax_mismatch OR shipping_mismatch
"""))
def dq_order_reconcile(spark, sf_dir):
    """Q8 over all purchases, with amounts put off by a rule on the order
    number so that every check has rows on both sides of its tolerance."""
    n = F.substring("order_id", 5, 20).cast("long")
    off = P.processed(spark, sf_dir)["purchases"].withColumns({
        "tax_amount": (F.col("tax_amount") + F.when(n % 5 == 0, F.lit(0.03)).otherwise(F.lit(0.02)).cast("decimal(4,2)")).cast("decimal(12,2)"),
        "shipping_cost": (F.col("shipping_cost") + F.when(n % 7 == 0, 1).otherwise(0)).cast("decimal(10,2)"),
        "total_amount": (F.col("total_amount") + F.when(n % 3 == 0, F.lit(1.0)).otherwise(F.lit(0.02)).cast("decimal(4,2)")).cast("decimal(12,2)")})
    out = quality.order_reconciliation(off)
    return out.select(*[F.col(c).cast("double").alias(c) if c in
                        ("subtotal", "tax_amount", "shipping_cost", "discount_amount", "total_amount")
                        else F.col(c) for c in out.columns])


_DQ = """
SELECT CAST(ingestion_time AS DATE) AS date, COUNT(*) AS total_events,
  COUNT(*) FILTER (WHERE is_valid) AS valid_events,
  COUNT(*) FILTER (WHERE NOT is_valid) AS invalid_events,
  {pct} AS quality_score_pct,
  COUNT(*) FILTER (WHERE {has}) AS events_with_issues
FROM rawv GROUP BY 1
"""


@register("data_quality_summary", O.q(_DQ.format(
    pct=O.pct_sql("COUNT(*) FILTER (WHERE is_valid)", "COUNT(*)"), has="issues IS NOT NULL")))
def data_quality_summary(spark, sf_dir):
    return views.data_quality_summary(P.raw_events(spark, sf_dir), corrected=False)


@register("data_quality_summary_fixed", O.q(_DQ.format(
    pct=O.pct_sql("COUNT(*) FILTER (WHERE is_valid)", "COUNT(*)"), has="len(issues) > 0")))
def data_quality_summary_fixed(spark, sf_dir):
    return views.data_quality_summary(P.raw_events(spark, sf_dir), corrected=True)


@register("quality_last_7_days", O.q(_DQ.format(
    pct=O.pct_sql("COUNT(*) FILTER (WHERE is_valid)", "COUNT(*)"), has="len(issues) > 0")
    + " ORDER BY date DESC LIMIT 7"))
def quality_last_7_days(spark, sf_dir):
    dq = views.data_quality_summary(P.raw_events(spark, sf_dir), corrected=True)
    return metrics.latest(dq, 7, [F.col("date").desc_nulls_last()])


# --------------------------------------------------------------------------
# De-duplication, merge, incremental load
# --------------------------------------------------------------------------

@register("dedup_keep_first", O.q("""
SELECT event_id, 'events.parquet' AS source_file, storage_type, ingestion_time FROM rawv
"""))
def dedup_keep_first(spark, sf_dir):
    return dedup.keep_first(_two_sources(spark, sf_dir)).select(
        "event_id", "source_file", "storage_type", "ingestion_time")


@register("last_write_wins", O.q("""
SELECT event_id, CASE WHEN storage_type = 'duckdb' THEN 'duckdb' ELSE 'events.parquet' END AS source_file,
       CASE WHEN storage_type = 'duckdb' THEN ingestion_time + INTERVAL 1 DAY ELSE ingestion_time END AS ingestion_time
FROM rawv
"""))
def last_write_wins(spark, sf_dir):
    return dedup.last_write_wins(_two_sources(spark, sf_dir)).select("event_id", "source_file", "ingestion_time")


MERGE_CUTOFF = "2024-01-20"


@register("upsert_raw_events", O.q(f"""
, tgt AS (SELECT event_id, event_type, is_valid FROM rawv WHERE timestamp < TIMESTAMP '{MERGE_CUTOFF}')
SELECT coalesce(t.event_id, s.event_id) AS event_id,
  CASE WHEN t.event_id IS NOT NULL THEN 'run_1' ELSE 'run_2' END AS etl_run_id,
  CASE WHEN t.event_id IS NOT NULL THEN 'previous_load' ELSE 'events.parquet' END AS source_file,
  CASE WHEN s.event_id IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-20 00:00:00' END AS etl_timestamp,
  coalesce(s.event_type, t.event_type) AS event_type,
  CASE WHEN s.event_id IS NOT NULL THEN s.is_valid ELSE t.is_valid END AS is_valid
FROM tgt t FULL OUTER JOIN (SELECT event_id, event_type, is_valid FROM rawv) s ON t.event_id = s.event_id
"""))
def upsert_raw_events(spark, sf_dir):
    raw = P.landed_raw_events(spark, sf_dir)
    target = (raw.filter(F.col("timestamp") < F.lit(MERGE_CUTOFF).cast("timestamp_ntz"))
              .withColumn("etl_run_id", F.lit("run_1"))
              .withColumn("source_file", F.lit("previous_load"))
              .withColumn("etl_timestamp", F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")))
    batch = (dedup.keep_first(raw)
             .withColumn("etl_run_id", F.lit("run_2"))
             .withColumn("etl_timestamp", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")))
    merged = dedup.merge_by_key(target, batch)
    return merged.select("event_id", "etl_run_id", "source_file", "etl_timestamp", "event_type", "is_valid")


@register("incremental_anti_join", O.q(f"""
SELECT event_id, timestamp FROM pv
WHERE event_id NOT IN (SELECT event_id FROM pv WHERE timestamp < TIMESTAMP '{MERGE_CUTOFF}')
"""))
def incremental_anti_join(spark, sf_dir):
    pv = P.processed(spark, sf_dir)["page_views"]
    target = pv.filter(F.col("timestamp") < F.lit(MERGE_CUTOFF).cast("timestamp_ntz"))
    return dedup.incremental_append(pv.select("event_id", "timestamp"), target)


@register("union_by_name", O.q("""
SELECT event_id, page_url, NULL::VARCHAR AS order_id, NULL::DOUBLE AS total_amount FROM pv
UNION ALL
SELECT event_id, NULL, order_id, CAST(total_amount AS DOUBLE) FROM pu
"""))
def union_by_name(spark, sf_dir):
    t = P.processed(spark, sf_dir)
    a = t["page_views"].select("event_id", "page_url")
    b = t["purchases"].select("event_id", "order_id", F.col("total_amount").cast("double").alias("total_amount"))
    return dedup.union_by_name([a, b])


@register("order_line_reconcile", """
WITH l AS (
  SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                         * (1 + CAST(l_tax AS DECIMAL(4,2)))) AS s, COUNT(*) AS n
  FROM lineitem GROUP BY 1)
SELECT CAST(o.o_orderkey AS VARCHAR) AS order_id, CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS order_total,
       CAST(round(l.s, 2) AS DOUBLE) AS line_total, CAST(coalesce(l.n, 0) AS BIGINT) AS lines
FROM orders o LEFT JOIN l ON l.l_orderkey = o.o_orderkey
WHERE l.s IS NULL OR abs(CAST(o.o_totalprice AS DECIMAL(12,2)) - l.s) > 0.02
""")
def order_line_reconcile(spark, sf_dir):
    """Q8 on the order tables: orders whose total is not the sum of their
    lines' extended price after discount and tax (lines aggregated per order
    before the join)."""
    return quality.order_line_reconciliation(P.read_table(spark, sf_dir, "orders"),
                                             P.read_table(spark, sf_dir, "lineitem"))


# --------------------------------------------------------------------------
# Routing (R1-R7, R9, R6)
# --------------------------------------------------------------------------

@register("page_views", O.q("""
SELECT event_id, session_id, customer_id, timestamp, event_type, page_url, page_title, previous_page,
       time_on_page, scroll_depth, device_type, browser, traffic_source, is_bounce
FROM pv
"""))
def page_views(spark, sf_dir):
    return P.processed(spark, sf_dir)["page_views"]


@register("product_interactions", O.q("""
SELECT event_id, event_type, session_id, customer_id, timestamp, product_id, product_name, product_category,
       product_brand, CAST(product_price AS DOUBLE) AS product_price, quantity, variant,
       CAST(discount_applied AS DOUBLE) AS discount_applied, device_type, page_url
FROM pi
"""))
def product_interactions(spark, sf_dir):
    d = P.processed(spark, sf_dir)["product_interactions"]
    return (d.withColumn("product_price", F.col("product_price").cast("double"))
             .withColumn("discount_applied", F.col("discount_applied").cast("double")))


_MONEY = ["subtotal", "tax_amount", "shipping_cost", "discount_amount", "total_amount"]


@register("purchases", O.q("""
SELECT event_id, session_id, customer_id, timestamp, order_id,
       CAST(1 + pk_k % 3 AS INTEGER) AS item_count,
       CAST(subtotal AS DOUBLE) AS subtotal, CAST(tax_amount AS DOUBLE) AS tax_amount,
       CAST(shipping_cost AS DOUBLE) AS shipping_cost, CAST(discount_amount AS DOUBLE) AS discount_amount,
       CAST(total_amount AS DOUBLE) AS total_amount, currency, payment_method, shipping_method, coupon_code,
       device_type, is_guest_checkout
FROM pu JOIN (SELECT event_id, pk_k FROM rawv) USING (event_id)
"""))
def purchases(spark, sf_dir):
    d = P.processed(spark, sf_dir)["purchases"]
    d = d.withColumn("item_count", F.json_array_length("items").cast("int")).drop("items")
    for c in _MONEY:
        d = d.withColumn(c, F.col(c).cast("double"))
    return d


@register("purchase_items", O.q("""
SELECT purchase_item_id, event_id, order_id, product_id, product_name, category, brand,
       CAST(price AS DOUBLE) AS price, quantity, CAST(line_total AS DOUBLE) AS line_total
FROM pit
"""))
def purchase_items(spark, sf_dir):
    d = P.processed(spark, sf_dir)["purchase_items"]
    return d.withColumn("price", F.col("price").cast("double")).withColumn("line_total", F.col("line_total").cast("double"))


@register("searches", O.q("""
SELECT event_id, session_id, customer_id, timestamp, search_query, search_results_count, search_category,
       clicked_result_position, device_type, filter_price_min, filter_price_max, filter_brand, filter_rating
FROM se
"""))
def searches(spark, sf_dir):
    raw = P.raw_events(spark, sf_dir)
    return route.searches(raw, expand_filters=True).drop("search_filters")


@register("user_engagement", O.q("""
SELECT event_id, event_type, session_id, customer_id, timestamp, device_type, product_id, rating, review_text,
       is_verified_purchase, CAST(shared_content AS VARCHAR) AS shared_content,
       CAST(share_platform AS VARCHAR) AS share_platform, CAST(shared_url AS VARCHAR) AS shared_url,
       email, subscription_type
FROM ue
"""))
def user_engagement(spark, sf_dir):
    return P.processed(spark, sf_dir)["user_engagement"]


@register("table_routing", O.q(f"""
SELECT {O.TARGET_SQL} AS target_table, COUNT(*) AS events,
       COUNT(*) FILTER (WHERE is_valid) AS valid_events
FROM rawv GROUP BY 1
"""))
def table_routing(spark, sf_dir):
    raw = P.raw_events(spark, sf_dir)
    return (raw.groupBy(route.target_table().alias("target_table"))
               .agg(F.count(F.lit(1)).alias("events"),
                    F.count_if(F.col("is_valid") == F.lit(True)).alias("valid_events")))


@register("batch_table_choice", O.q(f"""
, b AS (SELECT 'batch_' || strftime(ingestion_time, '%Y%m%d%H%M') AS source_file,
               list_sort(list_distinct(list(event_type))) AS event_types
        FROM rawv GROUP BY 1)
SELECT source_file, event_types,
  CASE WHEN list_has_any(event_types, ['PAGE_VIEW']) THEN 'PAGE_VIEWS'
       WHEN list_has_any(event_types, ['PRODUCT_VIEW','ADD_TO_CART','REMOVE_FROM_CART','ADD_TO_WISHLIST']) THEN 'PRODUCT_INTERACTIONS'
       WHEN list_has_any(event_types, ['PURCHASE']) THEN 'PURCHASES'
       WHEN list_has_any(event_types, ['SEARCH']) THEN 'SEARCHES'
       WHEN list_has_any(event_types, ['REVIEW','RATING','SHARE','NEWSLETTER_SIGNUP']) THEN 'USER_ENGAGEMENT'
       ELSE 'MIXED_EVENTS' END AS target_table
FROM b
"""))
def batch_table_choice(spark, sf_dir):
    """R6 batch form over the whole stream, in batches of a minute."""
    files = P.raw_events(spark, sf_dir).withColumn(
        "source_file", F.concat(F.lit("batch_"), F.date_format("ingestion_time", "yyyyMMddHHmm")))
    return route.batch_table_choice(files, "source_file")


# --------------------------------------------------------------------------
# Rollups and views
# --------------------------------------------------------------------------

@register("sessions", O.q(O.SESSIONS_CTE + " SELECT * FROM ses"))
def sessions(spark, sf_dir):
    return rollups.sessions(P.raw_events(spark, sf_dir))


@register("customers_360", O.q(O.ORDERS_CTE + f"""
, per AS (SELECT customer_id, COUNT(*) AS n, SUM(total_amount) AS spent,
                 MAX(CAST(timestamp AS DATE)) AS last_purchase_date FROM op GROUP BY 1)
SELECT cu.customer_id, cu.full_name, cu.customer_segment, cu.country,
  CAST(coalesce(per.n, 0) AS INTEGER) AS total_orders,
  CAST(coalesce(per.spent, 0) AS DOUBLE) AS total_spent,
  coalesce({O.money_avg_sql("coalesce(per.spent, 0)", "coalesce(per.n, 0)")}, 0.0) AS avg_order_value,
  per.last_purchase_date,
  CAST(date_diff('day', per.last_purchase_date, DATE '{ORDERS_TODAY}') AS INTEGER) AS days_since_last_purchase
FROM cu LEFT JOIN per USING (customer_id)
"""))
def customers_360(spark, sf_dir):
    return rollups.customers_360(P.order_purchases(spark, sf_dir), P.customer_dim(spark, sf_dir), ORDERS_TODAY)


@register("customer_journey", O.q(O.JOURNEY_CTE + " SELECT * FROM jr"))
def customer_journey(spark, sf_dir):
    return _journey(spark, sf_dir).withColumn("purchase_amount", F.col("purchase_amount").cast("double"))


def _journey(spark, sf_dir):
    raw = P.landed_raw_events(spark, sf_dir)
    return views.customer_journey(rollups.sessions(raw), P.processed(spark, sf_dir, raw)["purchases"])


@register("top_customers", O.q(O.JOURNEY_CTE + """
SELECT customer_id, COUNT(DISTINCT session_id) AS total_sessions,
  COUNT(DISTINCT session_id) FILTER (WHERE converted) AS converted_sessions,
  CAST(coalesce(SUM(purchase_amount), 0) AS DOUBLE) AS total_revenue
FROM jr GROUP BY 1 ORDER BY total_revenue DESC NULLS LAST, customer_id ASC NULLS LAST LIMIT 10
"""))
def top_customers(spark, sf_dir):
    return rollups.top_customers(_journey(spark, sf_dir), 10)  # sums decimals


_PP_SIDES = """
, inter AS (SELECT product_id, product_name, product_category, product_brand,
                   COUNT(*) FILTER (WHERE event_type = 'PRODUCT_VIEW') AS views,
                   COUNT(*) FILTER (WHERE event_type = 'ADD_TO_CART') AS cart_adds
            FROM pi GROUP BY 1, 2, 3, 4),
it AS (SELECT product_id, COUNT(DISTINCT order_id) AS purchases, SUM(quantity) AS q, SUM(line_total) AS rev
       FROM pit GROUP BY 1),
pp AS (
  SELECT i.product_id, product_name, product_category, product_brand, views, cart_adds,
    coalesce(purchases, 0) AS purchases, CAST(q AS BIGINT) AS units_sold, CAST(rev AS DOUBLE) AS revenue,
    """ + O.pct_sql("cart_adds", "views") + """ AS view_to_cart_rate,
    """ + O.pct_sql("coalesce(purchases, 0)", "cart_adds") + """ AS cart_to_purchase_rate
  FROM inter i LEFT JOIN it USING (product_id))
"""


@register("product_performance", O.q(_PP_SIDES + " SELECT * FROM pp"))
def product_performance(spark, sf_dir):
    t = P.processed(spark, sf_dir)
    return views.product_performance(t["product_interactions"], t["purchase_items"])


@register("product_performance_literal", O.q("""
SELECT pi.product_id, pi.product_name, pi.product_category, pi.product_brand,
  COUNT(CASE WHEN pi.event_type = 'PRODUCT_VIEW' THEN 1 END) AS views,
  COUNT(CASE WHEN pi.event_type = 'ADD_TO_CART' THEN 1 END) AS cart_adds,
  COUNT(DISTINCT pit.order_id) AS purchases,
  CAST(SUM(pit.quantity) AS BIGINT) AS units_sold,
  CAST(SUM(pit.line_total) AS DOUBLE) AS revenue,
  """ + O.pct_sql("COUNT(CASE WHEN pi.event_type = 'ADD_TO_CART' THEN 1 END)",
                  "COUNT(CASE WHEN pi.event_type = 'PRODUCT_VIEW' THEN 1 END)") + """ AS view_to_cart_rate,
  """ + O.pct_sql("COUNT(DISTINCT pit.order_id)", "COUNT(CASE WHEN pi.event_type = 'ADD_TO_CART' THEN 1 END)") + """ AS cart_to_purchase_rate
FROM pi LEFT JOIN pit ON pi.product_id = pit.product_id
GROUP BY pi.product_id, pi.product_name, pi.product_category, pi.product_brand
"""))
def product_performance_literal(spark, sf_dir):
    t = P.processed(spark, sf_dir)
    return views.product_performance_literal(t["product_interactions"], t["purchase_items"])


@register("top_products", O.q(_PP_SIDES + """
SELECT * FROM pp ORDER BY revenue DESC NULLS LAST, product_id ASC LIMIT 10
"""))
def top_products(spark, sf_dir):
    pp = product_performance(spark, sf_dir)
    return metrics.latest(pp, 10, [F.col("revenue").desc_nulls_last(), F.col("product_id").asc()])


_DAY = f"CAST(timestamp AS DATE) = DATE '{FIXTURE_TODAY}'"


@register("realtime_metrics", O.q(f"""
SELECT COUNT(*) AS total_events_today, COUNT(DISTINCT customer_id) AS unique_customers_today,
  COUNT(DISTINCT session_id) AS unique_sessions_today,
  COUNT(*) FILTER (WHERE event_type = 'PAGE_VIEW') AS page_views_today,
  COUNT(*) FILTER (WHERE event_type IN ('PRODUCT_VIEW', 'ADD_TO_CART', 'REMOVE_FROM_CART')) AS product_interactions_today,
  (SELECT COUNT(*) FROM pu WHERE {_DAY}) AS purchases_today,
  (SELECT COUNT(*) FROM se WHERE {_DAY}) AS searches_today,
  (SELECT CAST(SUM(total_amount) AS DOUBLE) FROM pu WHERE {_DAY}) AS revenue_today
FROM (
  SELECT 'PAGE_VIEW' AS event_type, customer_id, session_id FROM pv WHERE {_DAY}
  UNION ALL SELECT event_type, customer_id, session_id FROM pi WHERE {_DAY}
  UNION ALL SELECT 'PURCHASE', customer_id, session_id FROM pu WHERE {_DAY}
  UNION ALL SELECT 'SEARCH', customer_id, session_id FROM se WHERE {_DAY}
  UNION ALL SELECT event_type, customer_id, session_id FROM ue WHERE {_DAY})
"""))
def realtime_metrics(spark, sf_dir):
    return views.realtime_metrics_of(P.raw_events(spark, sf_dir), FIXTURE_TODAY)


# --------------------------------------------------------------------------
# KPIs, reports, top-k
# --------------------------------------------------------------------------

@register("event_rate", O.q("""
SELECT time_bucket(INTERVAL 1 MINUTE, timestamp) AS window_start,
       time_bucket(INTERVAL 1 MINUTE, timestamp) + INTERVAL 1 MINUTE AS window_end, COUNT(*) AS events
FROM rawv GROUP BY 1, 2
"""))
def event_rate(spark, sf_dir):
    return metrics.event_rate(P.raw_events(spark, sf_dir))


@register("type_distribution", O.q(f"""
SELECT event_type, COUNT(*) AS events, {O.GROUP_SQL} AS counter_group,
       {O.pct_sql("COUNT(*)", "SUM(COUNT(*)) OVER ()")} AS share_pct
FROM rawv GROUP BY event_type
"""))
def type_distribution(spark, sf_dir):
    return metrics.type_distribution(P.raw_events(spark, sf_dir))


@register("daily_volume", O.q(f"""
SELECT CAST(timestamp AS DATE) AS day, COUNT(*) AS events FROM rawv
WHERE CAST(timestamp AS DATE) < DATE '{FIXTURE_TODAY}' AND CAST(timestamp AS DATE) >= DATE '{FIXTURE_TODAY}' - INTERVAL 7 DAY
GROUP BY 1
"""))
def daily_volume(spark, sf_dir):
    return metrics.daily_volume(P.raw_events(spark, sf_dir), FIXTURE_TODAY, 7)


_WEEKS = O.ORDERS_CTE + """
, wk AS (SELECT CAST(date_trunc('week', timestamp) AS DATE) AS week_start, total_amount FROM op)
"""


@register("weekly_revenue", O.q(_WEEKS + f"""
SELECT week_start, CAST(SUM(total_amount) AS DOUBLE) AS revenue, COUNT(*) AS orders FROM wk
WHERE week_start < CAST(date_trunc('week', DATE '{ORDERS_TODAY}') AS DATE)
  AND week_start >= CAST(date_trunc('week', DATE '{ORDERS_TODAY}') AS DATE) - INTERVAL 28 DAY
GROUP BY 1
"""))
def weekly_revenue(spark, sf_dir):
    return metrics.weekly_revenue(P.order_purchases(spark, sf_dir), ORDERS_TODAY, 4)


@register("growth_rate", O.q(_WEEKS + """
, w AS (SELECT week_start, CAST(SUM(total_amount) AS DOUBLE) AS revenue FROM wk GROUP BY 1),
g AS (SELECT week_start, revenue, lag(revenue) OVER (ORDER BY week_start) AS previous FROM w)
SELECT week_start, revenue, previous,
  CASE WHEN CAST(CAST(previous * 100 AS BIGINT) AS DOUBLE) != 0 THEN
    floor(((CAST(CAST(revenue * 100 AS BIGINT) AS DOUBLE) - CAST(CAST(previous * 100 AS BIGINT) AS DOUBLE)) * 20000.0
           + CAST(CAST(previous * 100 AS BIGINT) AS DOUBLE)) / (CAST(CAST(previous * 100 AS BIGINT) AS DOUBLE) * 2.0)) / 100.0
  END AS growth_pct
FROM g
"""))
def growth_rate(spark, sf_dir):
    op = P.order_purchases(spark, sf_dir)
    weeks = (op.groupBy(F.date_trunc("week", F.col("timestamp").cast("timestamp")).cast("date").alias("week_start"))
               .agg(F.sum("total_amount").cast("double").alias("revenue")))
    return metrics.growth_rate(weeks, "week_start", "revenue")


@register("segment_distribution", O.q(O.ORDERS_CTE + f"""
SELECT customer_segment, COUNT(*) AS customers, {O.pct_sql("COUNT(*)", "SUM(COUNT(*)) OVER ()")} AS share_pct
FROM cu GROUP BY 1
"""))
def segment_distribution(spark, sf_dir):
    return metrics.segment_distribution(P.customer_dim(spark, sf_dir))


@register("revenue_kpis", O.q(O.ORDERS_CTE + f"""
SELECT CAST(SUM(total_amount) AS DOUBLE) AS total_revenue, COUNT(*) AS orders,
       {O.money_avg_sql("SUM(total_amount)", "COUNT(*)")} AS avg_order_value
FROM op
"""))
def revenue_kpis(spark, sf_dir):
    return metrics.revenue_kpis(P.order_purchases(spark, sf_dir))


@register("top_category", O.q(O.ORDERS_CTE + """
SELECT category, CAST(SUM(line_total) AS DOUBLE) AS revenue FROM oi GROUP BY 1
ORDER BY revenue DESC NULLS LAST, category ASC NULLS LAST LIMIT 1
"""))
def top_category(spark, sf_dir):
    return metrics.top_category(P.order_items(spark, sf_dir))


@register("session_kpis", O.q(O.SESSIONS_CTE + f"""
, s AS (SELECT COUNT(*) AS sessions, COUNT(*) FILTER (WHERE conversion_flag) AS converted,
               SUM(duration_seconds) AS dur FROM ses),
e AS (SELECT COUNT(*) AS events FROM rawv WHERE session_id IS NOT NULL)
SELECT sessions, converted, {O.pct_sql("converted", "sessions")} AS conversion_rate_pct,
  floor((CAST(dur AS DOUBLE) * 200.0 + sessions) / (sessions * 2.0)) / 100.0 AS avg_session_seconds,
  floor((CAST(events AS DOUBLE) * 200.0 + sessions) / (sessions * 2.0)) / 100.0 AS events_per_session
FROM s, e
"""))
def session_kpis(spark, sf_dir):
    raw = P.landed_raw_events(spark, sf_dir)
    return metrics.session_kpis(rollups.sessions(raw), raw)


@register("storage_share", O.q(f"""
SELECT storage_type, COUNT(*) AS events, {O.pct_sql("COUNT(*)", "greatest(SUM(COUNT(*)) OVER (), 1)", 1)} AS share_pct
FROM rawv GROUP BY 1
"""))
def storage_share(spark, sf_dir):
    return metrics.storage_share(P.raw_events(spark, sf_dir))


@register("latest_events", O.q("""
SELECT event_id, event_type, customer_id, ingestion_time, page_url FROM rawv
ORDER BY ingestion_time DESC NULLS LAST, event_id ASC LIMIT 100
"""))
def latest_events(spark, sf_dir):
    raw = route.with_payload(P.raw_events(spark, sf_dir))
    top = metrics.latest(raw, 100, [F.col("ingestion_time").desc_nulls_last(), F.col("event_id").asc()])
    return top.select("event_id", "event_type", "customer_id", "ingestion_time",
                      F.coalesce(F.col("_p.page_url"), F.lit(None)).alias("page_url"))


@register("latest_event", O.q("""
SELECT event_id, event_type, ingestion_time FROM rawv ORDER BY ingestion_time DESC NULLS LAST, event_id ASC LIMIT 1
"""))
def latest_event(spark, sf_dir):
    return metrics.latest(P.raw_events(spark, sf_dir), 1,
                          [F.col("ingestion_time").desc_nulls_last(), F.col("event_id").asc()]).select(
        "event_id", "event_type", "ingestion_time")


@register("recent_per_partition", O.q("""
SELECT * FROM (
  SELECT partition_id, event_id, ingestion_time,
         ROW_NUMBER() OVER (PARTITION BY partition_id ORDER BY ingestion_time DESC NULLS LAST, event_id ASC) AS rank
  FROM rawv) WHERE rank <= 100
"""))
def recent_per_partition(spark, sf_dir):
    raw = P.raw_events(spark, sf_dir).select("partition_id", "event_id", "ingestion_time")
    return metrics.top_n_per_group(raw, ["partition_id"],
                                   [F.col("ingestion_time").desc_nulls_last(), F.col("event_id").asc()], 100)


@register("day_event_types", O.q(f"""
SELECT event_type, COUNT(*) AS events FROM rawv WHERE {_DAY} GROUP BY 1
"""))
def day_event_types(spark, sf_dir):
    from shoptrail.operators.validate import on_day
    d = on_day(P.raw_events(spark, sf_dir), "timestamp", FIXTURE_TODAY)
    return d.groupBy("event_type").agg(F.count(F.lit(1)).alias("events")).orderBy(F.col("events").desc())


@register("counters", O.q(f"""
, f AS (SELECT *, {WV} AS ok, {O.GROUP_SQL} AS g FROM raw),
a AS (SELECT COUNT(*) AS raw_events_count, COUNT(*) FILTER (WHERE ok) AS clean_events_count,
        COUNT(*) FILTER (WHERE NOT ok) AS invalid_events_count,
        COUNT(*) FILTER (WHERE g = 'page_views') AS page_views,
        COUNT(*) FILTER (WHERE g = 'product_interactions') AS product_interactions,
        COUNT(*) FILTER (WHERE g = 'purchases') AS purchases,
        COUNT(*) FILTER (WHERE g = 'searches') AS searches,
        COUNT(*) FILTER (WHERE g = 'user_engagement') AS user_engagement FROM f)
SELECT counter, CAST(value_i AS DOUBLE) AS value
FROM (UNPIVOT a ON raw_events_count, clean_events_count, invalid_events_count, page_views,
               product_interactions, purchases, searches, user_engagement INTO NAME counter VALUE value_i)
UNION ALL
SELECT 'data_quality_score', CASE WHEN raw_events_count > 0 THEN
  {O.pct_sql("clean_events_count", "raw_events_count", 1)} ELSE 100.0 END FROM a
"""))
def counters(spark, sf_dir):
    return metrics.counters(_flagged(spark, sf_dir))


@register("cumulative_counts", O.q(f"""
, f AS (SELECT date_trunc('hour', timestamp) AS bucket, COUNT(*) AS r, COUNT(*) FILTER (WHERE {WV}) AS c
        FROM raw GROUP BY 1)
SELECT bucket, CAST(SUM(r) OVER w AS BIGINT) AS cumulative_raw, CAST(SUM(c) OVER w AS BIGINT) AS cumulative_clean
FROM f WINDOW w AS (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
ORDER BY bucket DESC LIMIT 20
"""))
def cumulative_counts(spark, sf_dir):
    return metrics.cumulative_counts(_flagged(spark, sf_dir))


@register("cumulative_counts_15", O.q(f"""
, f AS (SELECT time_bucket(INTERVAL 15 MINUTE, timestamp) AS bucket, COUNT(*) AS r, COUNT(*) FILTER (WHERE {WV}) AS c
        FROM raw GROUP BY 1)
SELECT bucket, CAST(SUM(r) OVER w AS BIGINT) AS cumulative_raw, CAST(SUM(c) OVER w AS BIGINT) AS cumulative_clean
FROM f WINDOW w AS (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
ORDER BY bucket DESC LIMIT 20
"""))
def cumulative_counts_15(spark, sf_dir):
    return metrics.cumulative_counts(_flagged(spark, sf_dir), minutes=15)


@register("table_counts", O.q("""
SELECT 'raw_events' AS table_name, COUNT(*) AS row_count FROM rawv
UNION ALL SELECT 'page_views', COUNT(*) FROM pv
UNION ALL SELECT 'product_interactions', COUNT(*) FROM pi
UNION ALL SELECT 'purchases', COUNT(*) FROM pu
UNION ALL SELECT 'purchase_items', COUNT(*) FROM pit
UNION ALL SELECT 'searches', COUNT(*) FROM se
UNION ALL SELECT 'user_engagement', COUNT(*) FROM ue
"""))
def table_counts(spark, sf_dir):
    return metrics.processed_counts(P.raw_events(spark, sf_dir))


@register("freshness", O.q("""
SELECT (SELECT MAX(ingestion_time) FROM rawv) AS last_ingestion_time,
       (SELECT MAX(timestamp) FROM pv) AS last_processed_time
"""))
def freshness(spark, sf_dir):
    raw = P.landed_raw_events(spark, sf_dir)
    t = P.processed(spark, sf_dir, raw)
    return metrics.freshness(raw, t["page_views"], created_col="timestamp")


@register("etl_stats", O.q("""
, u AS (SELECT event_id, timestamp, event_type, 0 AS src FROM rawv
        UNION ALL SELECT event_id, timestamp, event_type, 1 FROM rawv WHERE storage_type = 'duckdb'),
a AS (SELECT COUNT(*) FILTER (WHERE src = 0) AS extracted_files, COUNT(*) FILTER (WHERE src = 1) AS extracted_store,
             COUNT(*) AS total_extracted FROM u),
d AS (SELECT COUNT(*) AS loaded,
             COUNT(*) FILTER (WHERE event_id IS NULL) + COUNT(*) FILTER (WHERE event_type IS NULL)
             + COUNT(*) FILTER (WHERE timestamp IS NULL) + COUNT(*) FILTER (WHERE timestamp > TIMESTAMP '""" + FIXTURE_NOW + """') AS quality_issues
      FROM rawv)
SELECT extracted_files, extracted_store, total_extracted, total_extracted - loaded AS duplicates_removed,
       quality_issues, loaded FROM a, d
"""))
def etl_stats(spark, sf_dir):
    from shoptrail.plans.etl import etl_statistics
    return etl_statistics(_two_sources(spark, sf_dir), as_of=FIXTURE_NOW)


@register("load_statistics", O.q(f"""
SELECT
  (SELECT COUNT(*) FROM rawv WHERE CAST(ingestion_time AS DATE) = DATE '{FIXTURE_TODAY}') AS raw_events_today,
  (SELECT COUNT(*) FROM pv WHERE {_DAY}) AS page_views_today,
  (SELECT COUNT(*) FROM pi WHERE {_DAY}) AS product_interactions_today,
  (SELECT COUNT(*) FROM pu WHERE {_DAY}) AS purchases_today,
  (SELECT COUNT(*) FROM se WHERE {_DAY}) AS searches_today,
  (SELECT COUNT(*) FILTER (WHERE is_valid) FROM rawv WHERE CAST(ingestion_time AS DATE) = DATE '{FIXTURE_TODAY}') AS valid_today,
  (SELECT {O.pct_sql("COUNT(*) FILTER (WHERE is_valid)", "COUNT(*)")} FROM rawv
     WHERE CAST(ingestion_time AS DATE) = DATE '{FIXTURE_TODAY}') AS quality_score_pct
"""))
def load_statistics(spark, sf_dir):
    from shoptrail.plans.etl import load_statistics as ls
    return ls(P.raw_events(spark, sf_dir), FIXTURE_TODAY)


STATS_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                "embeddings", "pages", "benchmark", "labels", "conversations"]


@register("file_stats", " UNION ALL ".join(f"SELECT '{t}.parquet' AS table_name, COUNT(*) AS records FROM {t}" for t in STATS_TABLES))
def file_stats(spark, sf_dir):
    """A13 over all the driver's Parquet files: records of each table's
    files (sizes and times have no SQL twin)."""
    def of(t):
        per = metrics.file_stats(spark.read.parquet(f"{sf_dir}/{t}.parquet").select("_metadata"))
        return per.agg(F.lit(f"{t}.parquet").alias("table_name"), F.coalesce(F.sum("records"), F.lit(0)).alias("records"))
    out = of(STATS_TABLES[0])
    for t in STATS_TABLES[1:]:
        out = out.unionByName(of(t))
    return out


# --------------------------------------------------------------------------
# Projections and small enrichments
# --------------------------------------------------------------------------

@register("silver_events", O.q(f"""
SELECT event_id AS EVENT_ID, customer_id AS CUSTOMER_ID, event_type AS EVENT_TYPE, amount AS AMOUNT,
       currency AS CURRENCY, strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS EVENT_TIMESTAMP
FROM raw WHERE {WV}
"""))
def silver_events(spark, sf_dir):
    valid, _ = validate.split_valid(P.wire_events(spark, sf_dir), as_of=FIXTURE_NOW)
    return validate.silver_projection(valid)


@register("search_filters_flat", O.q("""
SELECT event_id, search_query, filter_price_min AS search_filters_price_min,
       filter_price_max AS search_filters_price_max, filter_brand AS search_filters_brand,
       filter_rating AS search_filters_rating
FROM se
"""))
def search_filters_flat(spark, sf_dir):
    raw = P.raw_events(spark, sf_dir)
    d = route.with_payload(raw.filter((F.col("event_type") == "SEARCH") & (F.col("is_valid") == F.lit(True))))
    nested = d.select("event_id", F.col("_p.search_query").alias("search_query"),
                      F.col("_p.search_filters").alias("search_filters"))
    return validate.flatten(nested)


@register("display_summary", O.q("""
SELECT event_id, event_type,
  CASE WHEN event_type = 'PURCHASE'
         THEN '{"total_amount":' || CAST(total_amount AS VARCHAR) || ',"order_id":"' || order_id || '"}'
       WHEN event_type = 'SEARCH'
         THEN '{"query":"' || search_query || '","results":' || CAST(search_results_count AS VARCHAR) || '}'
       WHEN page_url IS NULL THEN '{}'
       ELSE '{"page_url":"' || page_url || '"}' END AS summary
FROM rawv WHERE is_valid
"""))
def display_summary(spark, sf_dir):
    raw = P.raw_events(spark, sf_dir).filter(F.col("is_valid") == F.lit(True))
    return validate.display_summary(raw).select("event_id", "event_type", "summary")


@register("product_catalog", """
SELECT 'PROD_' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
       p_brand AS brand, CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS price,
       '/product/' || lower('PROD_' || CAST(p_partkey AS VARCHAR)) AS product_url
FROM part
""")
def product_catalog(spark, sf_dir):
    from shoptrail.functions.events import product_url
    dim = P.product_dim(spark, sf_dir)
    return dim.select("product_id", "product_name", "category", "brand",
                      F.col("price").cast("double").alias("price"), product_url("product_id").alias("product_url"))


@register("quality_bands", O.q("""
, d AS (SELECT CAST(ingestion_time AS DATE) AS date, """ + O.pct_sql("COUNT(*) FILTER (WHERE is_valid)", "COUNT(*)")
    + """ AS quality_score_pct FROM rawv GROUP BY 1)
SELECT date, quality_score_pct,
  CASE WHEN quality_score_pct >= 90 THEN 'excellent' WHEN quality_score_pct >= 70 THEN 'good' ELSE 'poor' END AS quality_band
FROM d
"""))
def quality_bands(spark, sf_dir):
    from shoptrail.functions.events import quality_band
    dq = views.data_quality_summary(P.raw_events(spark, sf_dir), corrected=True)
    return dq.select("date", "quality_score_pct", quality_band("quality_score_pct").alias("quality_band"))


@register("etl_breakdown", O.q("""
, u AS (SELECT event_id FROM rawv UNION ALL SELECT event_id FROM rawv WHERE storage_type = 'duckdb')
SELECT (SELECT COUNT(*) FROM u) AS extracted,
       (SELECT COUNT(*) FROM u) - (SELECT COUNT(*) FROM rawv) AS duplicates,
       (SELECT COUNT(*) FROM rawv) AS transformed,
       (SELECT COUNT(*) FROM rawv WHERE is_valid) AS valid,
       (SELECT COUNT(*) FROM rawv WHERE len(issues) > 0) AS with_issues
"""))
def etl_breakdown(spark, sf_dir):
    """Extracted, duplicates, transformed (= extracted - duplicates),
    valid and with-issues counts of one ETL run."""
    both = _two_sources(spark, sf_dir)
    a = both.agg(F.count(F.lit(1)).alias("extracted"))
    kept = dedup.keep_first(both)
    b = kept.agg(F.count(F.lit(1)).alias("transformed"),
                 F.count_if(F.col("is_valid") == F.lit(True)).alias("valid"),
                 F.count_if(F.json_array_length("data_quality_issues") > 0).alias("with_issues"))
    j = dedup.side_by_side([a, b])
    return j.select("extracted", (F.col("extracted") - F.col("transformed")).alias("duplicates"),
                    "transformed", "valid", "with_issues")


# --------------------------------------------------------------------------
# Streaming forms (X1, X6, X8) -- run to completion on files Spark derives
# from the driver tables, checked against the batch twin's SQL
# --------------------------------------------------------------------------

def _stream_input(spark, sf_dir, replay: bool = False, closing: bool = False, shuffled: bool = False) -> str:
    """Write the wire events as JSON-lines files (the topic substitute) into
    a fresh folder under the shared checkpoint location."""
    import uuid as _uuid
    from shoptrail.session import scratch_path
    path = scratch_path(spark, f"streams/input-{_uuid.uuid4().hex}")
    wire = P.wire_events(spark, sf_dir).select(*[f.name for f in S.FLAT_EVENT_SCHEMA.fields], "session_id")
    # several files, in time order unless shuffled, so that a stream over them has several triggers; more as the
    # table grows (its count comes from the file footers)
    files = max(6, -(-spark.read.parquet(f"{sf_dir}/events.parquet").count() // 1_000_000))
    if shuffled:
        dealt = wire.repartition(files, F.xxhash64("event_id"))
    else:  # ranges are sampled first: the events are derived once and read for both
        wire.write.parquet(derived := scratch_path(spark, f"streams/derived-{_uuid.uuid4().hex}"))
        dealt = spark.read.schema(wire.schema).parquet(derived).repartitionByRange(files, "event_timestamp")
    dealt.write.mode("overwrite").json(path)
    if closing:  # one late event moves the watermark past all others, so that append mode gives every window
        last = F.date_format(F.lit(FIXTURE_NOW).cast("timestamp") + F.expr("INTERVAL 400 DAYS"), "yyyy-MM-dd'T'HH:mm:ss")
        (spark.range(1).select(F.lit("closing").alias("event_id"), F.lit("HEARTBEAT").alias("event_type"),
                               F.lit("~").alias("customer_id"), F.lit("~").alias("session_id"), last.alias("event_timestamp"))
         .write.mode("append").json(path))
    if replay:  # at-least-once delivery: every event arrives a second time
        spark.read.json(path, schema=S.FLAT_EVENT_SCHEMA).coalesce(files).write.mode("append").json(path)
    return path


def _run_stream(spark, df, mode: str = "append"):
    """Run a streaming query to completion (availableNow) into Parquet in
    the shared folder and read the result back. Append mode uses the file
    sink (exactly-once via its commit log); complete mode rewrites the whole
    result table per micro-batch with ``foreachBatch``. Nothing is held on
    the driver."""
    import uuid as _uuid
    from shoptrail.session import scratch_path
    name = f"q_{_uuid.uuid4().hex}"
    out = scratch_path(spark, f"streams/out-{name}")
    w = (df.writeStream.outputMode(mode)
         .option("checkpointLocation", scratch_path(spark, f"streams/ckpt-{name}"))
         .trigger(availableNow=True))
    if mode == "append":
        w = w.format("parquet").option("path", out)
    else:
        w = w.foreachBatch(lambda batch, _id: batch.write.mode("overwrite").parquet(out))
    w.start().awaitTermination()
    return spark.read.parquet(out)


@register("stream_clean_events", O.q(f"""
SELECT event_id, event_type, customer_id, {O.CATEGORY_SQL} AS event_category,
       CAST({O.SCORE_SQL} AS INTEGER) AS business_value_score
FROM raw WHERE {WV}
"""))
def stream_clean_events(spark, sf_dir):
    from shoptrail.streaming import processor as X
    src = X.file_events(spark, _stream_input(spark, sf_dir), max_files_per_trigger=4)
    out = X.validate_and_enrich(src, as_of=FIXTURE_NOW).filter(F.col("is_valid_event"))
    return _run_stream(spark, out.select("event_id", "event_type", "customer_id", "event_category",
                                         "business_value_score"))


@register("stream_dedup", O.q(f"SELECT event_id, event_type FROM raw WHERE timestamp <= TIMESTAMP '{FIXTURE_NOW}' + INTERVAL 1 HOUR"))
def stream_dedup(spark, sf_dir):
    """X6 in several triggers (two files each) with future stamps and a
    replay of every event. The watermark is wider than the replayed month."""
    from shoptrail.streaming import processor as X, stateful
    stateful.use_rocksdb(spark)
    src = X.with_event_time(X.file_events(spark, _stream_input(spark, sf_dir, replay=True), max_files_per_trigger=2))
    good = X.not_future(src, FIXTURE_NOW)
    return _run_stream(spark, X.dedup_stream(good, watermark="45 days").select("event_id", "event_type"))


@register("stream_counters", O.q(f"""
SELECT coalesce({O.GROUP_SQL}, 'other') AS counter_group, COUNT(*) AS raw_events,
       COUNT(*) FILTER (WHERE {WV}) AS clean_events, COUNT(*) FILTER (WHERE NOT {WV}) AS invalid_events
FROM raw GROUP BY 1
"""))
def stream_counters(spark, sf_dir):
    from shoptrail.streaming import processor as X
    src = X.file_events(spark, _stream_input(spark, sf_dir), max_files_per_trigger=4)
    return _run_stream(spark, X.running_counters(X.validate_and_enrich(src, as_of=FIXTURE_NOW)), "complete")


@register("enriched_events", O.q(f"""
SELECT event_id, event_type, {WV} AS is_valid_event, {O.CATEGORY_SQL} AS event_category,
       CAST({O.SCORE_SQL} AS INTEGER) AS business_value_score
FROM raw
"""))
def enriched_events(spark, sf_dir):
    """X1 batch form: every event with its validity flag and enrichment."""
    from shoptrail.streaming import processor as X
    out = X.validate_and_enrich(P.wire_events(spark, sf_dir), as_of=FIXTURE_NOW)
    return out.select("event_id", "event_type", "is_valid_event", "event_category", "business_value_score")


def _processor_routes(spark, sf_dir):
    import uuid as _uuid
    from shoptrail.session import scratch_path
    from shoptrail.streaming import processor as X
    run = _uuid.uuid4().hex
    clean, dead = scratch_path(spark, f"streams/clean-{run}"), scratch_path(spark, f"streams/dead-{run}")
    src = X.file_events(spark, _stream_input(spark, sf_dir), max_files_per_trigger=4)
    X.start_processor(spark, src, clean, dead, name=f"processor_{run}",
                      checkpoint=scratch_path(spark, f"streams/ckpt-processor-{run}"),
                      available_now=True, as_of=FIXTURE_NOW).awaitTermination()
    return clean, dead


@register("dead_letter", O.q(f"""
SELECT event_id, event_type, customer_id, invalid_field FROM raw WHERE NOT {WV}
"""))
def dead_letter(spark, sf_dir):
    """The stream processor's dead-letter route, read back."""
    _, dead = _processor_routes(spark, sf_dir)
    return spark.read.parquet(dead).select("event_id", "event_type", "customer_id", "invalid_field")


@register("stream_event_rate", O.q("""
SELECT time_bucket(INTERVAL 1 MINUTE, timestamp) AS window_start,
       time_bucket(INTERVAL 1 MINUTE, timestamp) + INTERVAL 1 MINUTE AS window_end, COUNT(*) AS events
FROM raw GROUP BY 1, 2
"""))
def stream_event_rate(spark, sf_dir):
    """Tumbling one-minute counts on the stream in append mode: a window
    is written once, when the watermark passes it. The watermark is wider
    than the month of events and the stamps 45 days ahead of it."""
    from shoptrail.streaming import processor as X
    src = X.with_event_time(X.file_events(spark, _stream_input(spark, sf_dir, closing=True), max_files_per_trigger=2))
    out = _run_stream(spark, X.rate_per_minute(src, watermark="90 days"))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "events")


@register("stream_sessions", O.q("""
, s0 AS (SELECT customer_id, timestamp, event_type, page_url,
                lag(timestamp) OVER (PARTITION BY customer_id ORDER BY timestamp, event_id) AS prev
         FROM raw WHERE customer_id IS NOT NULL),
s1 AS (SELECT *, SUM(CASE WHEN prev IS NULL OR timestamp - prev >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                 OVER (PARTITION BY customer_id ORDER BY timestamp, event_type, page_url
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sn FROM s0)
SELECT customer_id, min(timestamp) AS session_start, max(timestamp) + INTERVAL 30 MINUTE AS session_end,
       COUNT(*) AS events, COUNT(*) FILTER (WHERE event_type = 'PAGE_VIEW') AS page_views,
       arg_max(page_url, timestamp) FILTER (WHERE event_type = 'PAGE_VIEW') AS last_page
FROM s1 GROUP BY customer_id, sn
"""))
def stream_sessions(spark, sf_dir):
    """Per-customer 30-minute inactivity sessions with ``session_window``
    on the stream in append mode, read back from Parquet."""
    from shoptrail.streaming import processor as X
    src = X.with_event_time(X.file_events(spark, _stream_input(spark, sf_dir, closing=True), max_files_per_trigger=2))
    out = _run_stream(spark, X.session_activity(src, gap="30 minutes", watermark="90 days"))
    return out.select("customer_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                      F.col("session_end").cast("timestamp_ntz").alias("session_end"),
                      "events", "page_views", "last_page")


from shoptrail.plans import catalog_io  # noqa: E402,F401  (registers the file, sink and ETL queries)
from shoptrail.plans import catalog_loads  # noqa: E402,F401  (registers repeatable loads)
from shoptrail.plans import catalog_stream  # noqa: E402,F401  (registers the keyed-state streams)
from shoptrail.plans import catalog_tables  # noqa: E402,F401  (registers VARIANT, sketch and keyed-table queries)
