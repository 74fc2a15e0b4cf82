"""DuckDB SQL twins of the registered queries (the correctness oracle).

``BASE`` repeats the fixture adapter (``shoptrail.sources.fixtures``) and the
landing/routing steps as SQL CTEs over the pre-registered driver views, with
payload fields kept typed instead of packed to JSON. Each oracle is
``BASE + ', ' + <more CTEs> + SELECT``.
"""

from __future__ import annotations

from shoptrail import schemas as S
from shoptrail.sources import fixtures as FX


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join("'" + v + "'" for v in values) + ")"


def _title_sql(url: str) -> str:
    known = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.PAGE_TITLES.items())
    fallback = (f"array_to_string(list_transform(regexp_extract_all(replace({url}, '/', ''), '(\\pL+|\\PL+)', 1), "
                f"lambda x: CASE WHEN regexp_matches(x, '^\\pL') THEN upper(x[1]) || lower(x[2:]) ELSE x END), '')"
                f" || '{S.PAGE_TITLE_SUFFIX}'")
    return f"CASE {url} {known} ELSE {fallback} END"


NOW = f"TIMESTAMP '{FX.FIXTURE_NOW}'"

BASE = f"""
WITH
ev0 AS (
  SELECT e.event_id AS eid, e.ts, e.user_id, e.event_type AS src_type, e.value,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k
  FROM events e),
ev1 AS (
  SELECT ev0.*, p.p_name, p.p_brand, p.p_type, p.p_retailprice
  FROM ev0 LEFT JOIN part p ON p.p_partkey = ev0.k),
ev2 AS (
  SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, eid) AS prev_ts FROM ev1),
ev3 AS (
  SELECT *, SUM(CASE WHEN prev_ts IS NULL OR ts - prev_ts > INTERVAL 12 HOUR THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY ts, eid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_no
  FROM ev2),
fx AS (
  SELECT eid, k, user_id, ts, p_name, p_brand, p_type, p_retailprice,
    'EVT_' || CAST(eid AS VARCHAR) AS event_id,
    CASE src_type
      WHEN 'view' THEN CASE WHEN k % 2 = 0 THEN 'PAGE_VIEW' ELSE 'PRODUCT_VIEW' END
      WHEN 'click' THEN (['ADD_TO_CART', 'REMOVE_FROM_CART', 'ADD_TO_WISHLIST', 'SEARCH'])[k % 4 + 1]
      WHEN 'purchase' THEN 'PURCHASE'
      WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN 'NEWSLETTER_SIGNUP' ELSE 'REVIEW' END
      ELSE 'ERROR' END AS event_type,
    CASE WHEN eid % 97 = 13 THEN NULL
         ELSE 'SES_' || CAST(user_id AS VARCHAR) || '_' || CAST(session_no AS VARCHAR) END AS session_id,
    CASE WHEN eid % 53 = 7 THEN NULL ELSE 'CUST_' || CAST(user_id AS VARCHAR) END AS customer_id,
    CASE WHEN eid % 71 = 5 THEN ts + INTERVAL 45 DAY ELSE ts END AS timestamp,
    CASE WHEN eid % 37 = 3 THEN 'invalid_amount'
         WHEN eid % 43 = 19 THEN CAST(-CAST(value AS DECIMAL(12,2)) AS VARCHAR)
         ELSE CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
    CASE WHEN eid % 59 = 11 THEN NULL ELSE 'USD' END AS currency,
    CASE WHEN eid % 53 = 7 THEN 'customer_id' WHEN eid % 97 = 13 THEN 'session_id'
         WHEN eid % 71 = 5 THEN 'timestamp' WHEN eid % 37 = 3 OR eid % 43 = 19 THEN 'amount'
         WHEN eid % 59 = 11 THEN 'currency' WHEN eid % 41 = 17 THEN 'product_price' END AS invalid_field,
    eid % 41 = 17 AS neg_price,
    CAST(user_id % 3 AS INTEGER) AS partition_id,
    eid AS offset_id,
    ts + INTERVAL 90 SECOND AS ingestion_time
  FROM ev3),
items AS (
  SELECT eid, event_id, i, pk, 'PROD_' || CAST(pk AS VARCHAR) AS product_id,
         CAST(CAST(5 AS DECIMAL(10,2)) + CAST(pk AS DECIMAL(10,2)) * CAST(1.25 AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS price,
         CAST(1 + (k + i) % 3 AS INTEGER) AS quantity
  FROM (SELECT *, 1 + (eid + 31 * i) % (SELECT max(p_partkey) FROM part) AS pk FROM
        (SELECT eid, event_id, k, unnest(range(0, 1 + k % 3)) AS i FROM fx WHERE event_type = 'PURCHASE'))),
subt AS (
  SELECT eid, CAST(SUM(price * quantity) AS DECIMAL(12,2)) AS subtotal FROM items GROUP BY eid),
fx2 AS (
  SELECT fx.*,
    {_list(FX.DEVICES)}[user_id % 3 + 1] AS device_type,
    CASE WHEN event_type = 'PAGE_VIEW' THEN {_list(FX.URLS)}[k % 12 + 1]
         WHEN event_type IN {_in(FX.PRODUCT_TYPES)} THEN '/product/prod_' || CAST(k AS VARCHAR) END AS page_url,
    CASE WHEN event_type = 'PAGE_VIEW' THEN CAST(5 + (k * 7) % 300 AS INTEGER) END AS time_on_page,
    CASE WHEN event_type = 'PAGE_VIEW' THEN k END AS scroll_depth,
    CASE WHEN event_type = 'PAGE_VIEW' THEN {_list(FX.BROWSERS)}[user_id % 4 + 1] END AS browser,
    CASE WHEN event_type = 'PAGE_VIEW' THEN {_list(FX.TRAFFIC)}[user_id % 5 + 1] END AS traffic_source,
    CASE WHEN event_type IN {_in(FX.PRODUCT_TYPES + ['REVIEW'])} THEN 'PROD_' || CAST(k AS VARCHAR) END AS product_id,
    CASE WHEN event_type IN {_in(FX.PRODUCT_TYPES)} THEN p_name END AS product_name,
    CASE WHEN event_type IN {_in(FX.PRODUCT_TYPES)} THEN p_type END AS product_category,
    CASE WHEN event_type IN {_in(FX.PRODUCT_TYPES)} THEN p_brand END AS product_brand,
    CASE WHEN event_type IN {_in(FX.PRODUCT_TYPES)} THEN
      CAST(CASE WHEN neg_price THEN -CAST(p_retailprice AS DECIMAL(10,2)) ELSE CAST(p_retailprice AS DECIMAL(10,2)) END AS DECIMAL(10,2)) END AS product_price,
    CASE WHEN event_type IN {_in(FX.PRODUCT_TYPES)} THEN CAST(1 + k % 3 AS INTEGER) END AS quantity,
    CASE WHEN event_type IN {_in(FX.PRODUCT_TYPES)} AND k % 2 = 1 THEN {_list(FX.SIZES)}[k % 3 + 1] END AS variant,
    CASE WHEN event_type IN {_in(FX.PRODUCT_TYPES)} THEN CAST(CAST(k % 5 AS DECIMAL(5,4)) * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(5,4)) END AS discount_applied,
    CASE WHEN event_type = 'PURCHASE' THEN 'ORD_' || CAST(eid AS VARCHAR) END AS order_id,
    subt.subtotal,
    CASE WHEN event_type = 'PURCHASE' THEN k END AS pk_k,
    CASE WHEN event_type = 'PURCHASE' THEN {_list(FX.PAYMENTS)}[k % 5 + 1] END AS payment_method,
    CASE WHEN event_type = 'PURCHASE' THEN {_list(FX.SHIPPING)}[user_id % 3 + 1] END AS shipping_method,
    CASE WHEN event_type = 'PURCHASE' AND k % 4 = 0 THEN 'SAVE10' END AS coupon_code,
    CASE WHEN event_type = 'PURCHASE' THEN k % 7 = 0 END AS is_guest_checkout,
    CASE WHEN event_type = 'SEARCH' THEN {_list(FX.QUERIES)}[k % 8 + 1] END AS search_query,
    CASE WHEN event_type = 'SEARCH' THEN CAST((k * 13) % 200 AS INTEGER) END AS search_results_count,
    CASE WHEN event_type = 'SEARCH' AND k % 3 != 0 THEN {_list(FX.SEARCH_CATS)}[k % 4 + 1] END AS search_category,
    CASE WHEN event_type = 'SEARCH' THEN CAST((k % 5) * 10 AS INTEGER) END AS filter_price_min,
    CASE WHEN event_type = 'SEARCH' THEN CAST((k % 5) * 10 + 100 AS INTEGER) END AS filter_price_max,
    CASE WHEN event_type = 'SEARCH' AND k % 2 = 0 THEN p_brand END AS filter_brand,
    CASE WHEN event_type = 'SEARCH' THEN CAST(1 + k % 5 AS INTEGER) END AS filter_rating,
    CASE WHEN event_type = 'SEARCH' AND k % 4 != 0 THEN CAST(1 + k % 10 AS INTEGER) END AS clicked_result_position,
    CASE WHEN event_type = 'REVIEW' THEN CAST(1 + k % 5 AS INTEGER) END AS rating,
    CASE WHEN event_type = 'REVIEW' THEN 'Review of ' || p_name END AS review_text,
    CASE WHEN event_type = 'REVIEW' THEN k % 2 = 0 END AS is_verified_purchase,
    CASE WHEN event_type = 'NEWSLETTER_SIGNUP' THEN lower(customer_id) || '@example.com' END AS email,
    CASE WHEN event_type = 'NEWSLETTER_SIGNUP' THEN {_list(FX.SUBSCRIPTIONS)}[k % 3 + 1] END AS subscription_type
  FROM fx LEFT JOIN subt USING (eid)),
fx3 AS (
  SELECT *,
    CASE WHEN event_type = 'PURCHASE' THEN CAST(round(subtotal * CAST(0.08 AS DECIMAL(4,2)), 2) AS DECIMAL(12,2)) END AS tax_amount,
    CASE WHEN event_type = 'PURCHASE' THEN CAST(CASE WHEN subtotal > 50 THEN 0 ELSE 9.99 END AS DECIMAL(10,2)) END AS shipping_cost,
    CASE WHEN event_type = 'PURCHASE' THEN CAST(CASE WHEN k % 4 = 0 THEN round(subtotal * CAST(0.10 AS DECIMAL(4,2)), 2) ELSE 0 END AS DECIMAL(10,2)) END AS discount_amount,
    CASE WHEN event_type = 'PAGE_VIEW' THEN {_title_sql('page_url')} END AS page_title
  FROM fx2),
raw AS (
  SELECT *,
    CAST(subtotal + tax_amount + shipping_cost - discount_amount AS DECIMAL(12,2)) AS total_amount,
    list_filter([
      CASE WHEN customer_id IS NULL OR customer_id = '' THEN '{S.ISSUE_MISSING_CUSTOMER}' END,
      CASE WHEN session_id IS NULL THEN '{S.ISSUE_MISSING_SESSION}' END,
      CASE WHEN timestamp IS NULL THEN '{S.ISSUE_MISSING_TIMESTAMP}' END,
      CASE WHEN amount IS NOT NULL AND TRY_CAST(amount AS DECIMAL(38,6)) IS NULL THEN '{S.ISSUE_INVALID_AMOUNT}' END,
      CASE WHEN timestamp > {NOW} THEN '{S.ISSUE_FUTURE_TIMESTAMP}' END,
      CASE WHEN product_price < 0 THEN '{S.ISSUE_NEGATIVE_PRICE}' END], lambda x: x IS NOT NULL) AS issues,
    invalid_field IS NULL AS declared_valid,
    CASE WHEN right(md5(event_id), 1) IN ('0','2','4','6','8','a','c','e') THEN 'parquet' ELSE 'duckdb' END AS storage_type
  FROM fx3),
rawv AS (
  SELECT *, declared_valid AND len(issues) = 0 AS is_valid FROM raw),
pv0 AS (
  SELECT event_id, session_id, customer_id, timestamp, 'PAGE_VIEW' AS event_type, page_url, page_title,
         time_on_page, scroll_depth, device_type, browser, traffic_source
  FROM rawv WHERE event_type = 'PAGE_VIEW' AND is_valid),
pv AS (
  SELECT *,
    CASE WHEN session_id IS NOT NULL THEN lag(page_url) OVER (PARTITION BY session_id ORDER BY timestamp, event_id) END AS previous_page,
    CASE WHEN session_id IS NOT NULL THEN COUNT(*) OVER (PARTITION BY session_id) = 1 END AS is_bounce
  FROM pv0),
pi AS (
  SELECT event_id, event_type, session_id, customer_id, timestamp, product_id, product_name, product_category,
         product_brand, product_price, quantity, variant, discount_applied, device_type, page_url
  FROM rawv WHERE event_type IN {_in(S.PRODUCT_INTERACTION_TYPES)} AND is_valid),
pu AS (
  SELECT event_id, session_id, customer_id, timestamp, order_id, subtotal, tax_amount, shipping_cost,
         discount_amount, total_amount, 'USD' AS currency, payment_method, shipping_method, coupon_code,
         device_type, is_guest_checkout
  FROM rawv WHERE event_type = 'PURCHASE' AND is_valid),
pit AS (
  SELECT pu.event_id || '_' || CAST(it.i AS VARCHAR) AS purchase_item_id, pu.event_id, pu.order_id,
         it.product_id, pt.p_name AS product_name, pt.p_type AS category, pt.p_brand AS brand,
         it.price, it.quantity, CAST(it.price * it.quantity AS DECIMAL(12,2)) AS line_total
  FROM pu JOIN items it ON it.event_id = pu.event_id
  LEFT JOIN part pt ON pt.p_partkey = it.pk),
se AS (
  SELECT event_id, session_id, customer_id, timestamp, search_query, search_results_count, search_category,
         clicked_result_position, device_type, filter_price_min, filter_price_max, filter_brand, filter_rating
  FROM rawv WHERE event_type = 'SEARCH' AND is_valid),
ue AS (
  SELECT event_id, event_type, session_id, customer_id, timestamp, device_type, product_id, rating, review_text,
         is_verified_purchase, NULL AS shared_content, NULL AS share_platform, NULL AS shared_url, email,
         subscription_type
  FROM rawv WHERE event_type IN {_in(S.USER_ENGAGEMENT_TYPES)} AND is_valid)
"""


def q(body: str) -> str:
    """Oracle = shared CTEs + the query body (which may add CTEs with a
    leading comma)."""
    return BASE + body


def pct_sql(n: str, d: str, scale: int = 2) -> str:
    f = 10 ** scale
    return (f"(CASE WHEN CAST({d} AS DOUBLE) != 0 THEN floor((CAST({n} AS DOUBLE) * {200.0 * f} + CAST({d} AS DOUBLE))"
            f" / (CAST({d} AS DOUBLE) * 2.0)) / {float(f)} END)")


def money_avg_sql(total: str, n: str) -> str:
    return (f"(CASE WHEN CAST({n} AS DOUBLE) != 0 THEN floor((CAST(CAST({total} * 100 AS BIGINT) AS DOUBLE) * 2.0"
            f" + CAST({n} AS DOUBLE)) / (CAST({n} AS DOUBLE) * 2.0)) / 100.0 END)")


VALID_SQL = f"""COALESCE(customer_id IS NOT NULL AND customer_id != ''
  AND event_type IN {_in(S.VALID_EVENT_TYPES)}
  AND (CASE WHEN event_type IN {_in(S.MONEY_EVENT_TYPES)}
            THEN TRY_CAST(amount AS DECIMAL(38,6)) > 0 AND currency IS NOT NULL AND currency != ''
            ELSE TRUE END)
  AND timestamp IS NOT NULL AND timestamp <= {NOW} + INTERVAL 1 HOUR
  AND declared_valid, FALSE)"""

CATEGORY_SQL = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in S.EVENT_CATEGORY.items()) + " END"
SCORE_SQL = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in S.BUSINESS_VALUE_SCORE.items()) + " ELSE 0 END"
GROUP_SQL = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in S.COUNTER_GROUPS.items()) + " END"
TARGET_SQL = "CASE " + " ".join(
    f"WHEN event_type IN {_in(ts)} THEN '{t}'" for t, ts in S.TABLE_PRECEDENCE) + f" ELSE '{S.MIXED_TABLE}' END"


ROUTED = (S.PAGE_VIEW_TYPES + S.PRODUCT_INTERACTION_TYPES + S.PURCHASE_TYPES + S.SEARCH_TYPES
          + S.USER_ENGAGEMENT_TYPES)

SESSIONS_CTE = f"""
, sv AS (SELECT * FROM rawv WHERE is_valid AND session_id IS NOT NULL AND event_type IN {_in(ROUTED)}),
ses AS (
  SELECT session_id, min(customer_id) AS customer_id, min(timestamp) AS start_time, max(timestamp) AS end_time,
    CAST((epoch_us(max(timestamp)) - epoch_us(min(timestamp))) // 1000000 AS INTEGER) AS duration_seconds,
    arg_min(device_type, struct_pack(t := timestamp, e := event_id)) AS device_type,
    arg_min(traffic_source, struct_pack(t := timestamp, e := event_id)) FILTER (WHERE event_type = 'PAGE_VIEW') AS traffic_source,
    arg_min(page_url, struct_pack(t := timestamp, e := event_id)) FILTER (WHERE event_type = 'PAGE_VIEW') AS landing_page,
    arg_max(page_url, struct_pack(t := timestamp, e := event_id)) FILTER (WHERE event_type = 'PAGE_VIEW') AS exit_page,
    CAST(count(*) FILTER (WHERE event_type = 'PAGE_VIEW') AS INTEGER) AS page_views,
    CAST(count(DISTINCT page_url) FILTER (WHERE event_type = 'PAGE_VIEW') AS INTEGER) AS unique_pages,
    CAST(CASE WHEN count(*) FILTER (WHERE event_type = 'PAGE_VIEW') = 1 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS bounce_rate,
    bool_or(event_type = 'PURCHASE') AS conversion_flag,
    CAST(coalesce(sum(total_amount) FILTER (WHERE event_type = 'PURCHASE'), 0) AS DOUBLE) AS total_purchase_amount
  FROM sv GROUP BY session_id)
"""

JOURNEY_CTE = SESSIONS_CTE + """
, jr AS (
  SELECT s.customer_id, s.session_id, s.start_time, s.duration_seconds, s.page_views, s.device_type, s.traffic_source,
    p.order_id IS NOT NULL AS converted, CAST(p.total_amount AS DOUBLE) AS purchase_amount,
    ROW_NUMBER() OVER (PARTITION BY coalesce(s.customer_id, chr(0))
                       ORDER BY s.start_time ASC NULLS LAST, s.session_id ASC NULLS LAST, p.order_id ASC NULLS LAST) AS session_sequence
  FROM ses s LEFT JOIN pu p ON s.session_id = p.session_id)
"""

ORDERS_CTE = """
, op AS (SELECT 'CUST_' || CAST(o_custkey AS VARCHAR) AS customer_id, CAST(o_orderkey AS VARCHAR) AS order_id,
                CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, o_orderdate AS timestamp FROM orders),
oi AS (SELECT CAST(l.l_orderkey AS VARCHAR) AS order_id, 'PROD_' || CAST(l.l_partkey AS VARCHAR) AS product_id,
              CAST(l.l_extendedprice AS DECIMAL(12,2)) AS line_total, p.p_type AS category
       FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey),
cu AS (SELECT 'CUST_' || CAST(c.c_custkey AS VARCHAR) AS customer_id, c.c_name AS full_name,
              c.c_mktsegment AS customer_segment, n.n_name AS country
       FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey)
"""
