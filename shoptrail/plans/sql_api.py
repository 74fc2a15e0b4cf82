"""The library from SQL: functions for validity, category, score, counter group
and issue tags (F1, E1, E2, E12, Q5), the five views (V1-V5) and the
incremental load PROCESS_RAW_EVENTS (U2) as a SQL script.

Functions are SQL functions of the session, views are temporary views over a
RAW_EVENTS table and the processed tables; the script runs in Spark's SQL
scripting. The value sets come from ``shoptrail.schemas``."""

from __future__ import annotations

from pyspark.sql import SparkSession

from shoptrail import schemas as S

PROCESSED = ["page_views", "product_interactions", "purchases", "searches", "user_engagement"]


def _text(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_text(v) for v in values) + ")"


def _case(column: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {_text(k)} THEN {v if isinstance(v, int) else _text(v)}" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE {default} END"


def create_functions(spark: SparkSession) -> list[str]:
    """Registers the SQL functions; returns their names."""
    declared = {
        "event_category(t STRING) RETURNS STRING": _case("t", S.EVENT_CATEGORY, "NULL"),
        "business_value_score(t STRING) RETURNS INT": _case("t", S.BUSINESS_VALUE_SCORE, "0"),
        "counter_group(t STRING) RETURNS STRING": _case("t", S.COUNTER_GROUPS, "NULL"),
        "is_valid_event(customer STRING, t STRING, amount STRING, currency STRING, at TIMESTAMP_NTZ, declared BOOLEAN, clock TIMESTAMP_NTZ) "
        "RETURNS BOOLEAN": f"""coalesce(customer <> '' AND t IN {_in(S.VALID_EVENT_TYPES)}
            AND CASE WHEN t IN {_in(S.MONEY_EVENT_TYPES)}
                     THEN coalesce(try_cast(amount AS DECIMAL(38,6)) > 0 AND currency <> '', FALSE) ELSE TRUE END
            AND at <= clock + {S.FUTURE_TOLERANCE} AND declared, FALSE)""",
        "issue_tags(customer STRING, session STRING, at TIMESTAMP_NTZ, amount STRING, price DECIMAL(10,2), clock TIMESTAMP_NTZ) "
        "RETURNS ARRAY<STRING>": f"""array_compact(array(
            CASE WHEN customer IS NULL OR customer = '' THEN {_text(S.ISSUE_MISSING_CUSTOMER)} END,
            CASE WHEN session IS NULL THEN {_text(S.ISSUE_MISSING_SESSION)} END,
            CASE WHEN at IS NULL THEN {_text(S.ISSUE_MISSING_TIMESTAMP)} END,
            CASE WHEN amount IS NOT NULL AND try_cast(amount AS DECIMAL(38,6)) IS NULL THEN {_text(S.ISSUE_INVALID_AMOUNT)} END,
            CASE WHEN at > clock THEN {_text(S.ISSUE_FUTURE_TIMESTAMP)} END,
            CASE WHEN price < 0 THEN {_text(S.ISSUE_NEGATIVE_PRICE)} END))""",
    }
    for head, body in declared.items():
        name = head.split("(")[0]
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
        spark.sql(f"CREATE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in declared]


def create_views(spark: SparkSession, tables: dict[str, str], clock: str | None = None) -> list[str]:
    """The five analytics views over tables named in ``tables`` (raw_events,
    sessions and the processed ones; a name or a temporary view each). ``clock``
    is the time that counts as now."""
    now = f"TIMESTAMP_NTZ {_text(clock)}" if clock else "localtimestamp()"
    t = tables
    daily = " UNION ALL ".join(f"SELECT {kind} AS event_type, timestamp, customer_id, session_id FROM {t[name]}" for name, kind in (
        ("page_views", "'PAGE_VIEW'"), ("product_interactions", "event_type"), ("purchases", "'PURCHASE'"), ("searches", "'SEARCH'"),
        ("user_engagement", "event_type")))
    views = {
        "daily_event_summary": f"""
            SELECT CAST(timestamp AS DATE) AS event_date, event_type, count(*) AS event_count,
                   count(DISTINCT customer_id) AS unique_customers, count(DISTINCT session_id) AS unique_sessions
            FROM ({daily}) GROUP BY 1, 2""",
        "customer_journey": f"""
            SELECT s.customer_id, s.session_id, s.start_time, p.order_id, p.total_amount AS purchase_amount, p.order_id IS NOT NULL AS converted,
                   row_number() OVER (PARTITION BY s.customer_id ORDER BY s.start_time, s.session_id, p.order_id) AS session_sequence
            FROM {t["sessions"]} s LEFT JOIN {t["purchases"]} p USING (session_id)""",
        "product_performance": f"""
            SELECT product_id, product_name, product_category, product_brand,
                   count_if(event_type = 'PRODUCT_VIEW') AS views, count_if(event_type = 'ADD_TO_CART') AS cart_adds
            FROM {t["product_interactions"]} GROUP BY ALL""",
        "realtime_metrics": f"""
            SELECT metric, events FROM (
              SELECT count_if(event_type = 'PAGE_VIEW') AS page_views_today, count_if(event_type = 'PURCHASE') AS purchases_today,
                     count(DISTINCT session_id) AS sessions_today, count(*) AS events_today
              FROM {t["raw_events"]} WHERE is_valid AND timestamp >= date_trunc('DAY', {now}) AND timestamp < date_trunc('DAY', {now}) + INTERVAL 1 DAY)
            UNPIVOT (events FOR metric IN (page_views_today, purchases_today, sessions_today, events_today))""",
        "data_quality_summary": f"""
            SELECT CAST(timestamp AS DATE) AS event_date, count(*) AS total_events, count_if(is_valid) AS valid_events,
                   count_if(NOT is_valid) AS invalid_events, count_if(json_array_length(data_quality_issues) > 0) AS events_with_issues
            FROM {t["raw_events"]} GROUP BY 1""",
    }
    for name, body in views.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {body}")
    return list(views)


def process_raw_events(raw: str, targets: dict[str, str]) -> str:
    """U2 as a SQL script: for each processed table the valid events of its
    types that it does not hold yet, payload fields from VARIANT. ``targets``
    names page_views, product_interactions and purchases tables."""
    def typed(*names: str) -> str:
        return ", ".join(f"try_variant_get(v, '$.{n}', '{S.PAYLOAD_SCHEMA[n].dataType.simpleString()}') AS {n}" for n in names)
    parts = {
        "page_views": ("", S.PAGE_VIEW_TYPES, ("page_url", "page_title", "time_on_page", "scroll_depth", "device_type", "browser", "traffic_source")),
        "product_interactions": ("event_type, ", S.PRODUCT_INTERACTION_TYPES, (
            "product_id", "product_name", "product_category", "product_brand", "product_price", "quantity", "variant", "discount_applied",
            "device_type", "page_url")),
        "purchases": ("", S.PURCHASE_TYPES, ("order_id", "subtotal", "tax_amount", "shipping_cost", "discount_amount", "total_amount", "currency",
                                             "payment_method", "shipping_method", "coupon_code", "device_type", "is_guest_checkout"))}
    loads = "\n".join(f"""
      INSERT INTO {targets[name]} BY NAME
      SELECT event_id, {kind}session_id, customer_id, timestamp, {typed(*fields)}
      FROM (SELECT *, try_parse_json(event_data) AS v FROM {raw} WHERE is_valid AND event_type IN {_in(types)}) r
      WHERE event_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {targets[name]} t WHERE t.event_id = r.event_id);
      SET done = done + 1;""" for name, (kind, types, fields) in parts.items())
    return f"""
    BEGIN
      DECLARE done INT DEFAULT 0;
      {loads}
      SELECT concat('Raw events processed into ', done, ' tables') AS status;
    END"""


def create_targets(spark: SparkSession, folder: str, prefix: str) -> dict[str, str]:
    """Empty page_views, product_interactions and purchases tables under
    ``folder``, for the script to fill."""
    def columns(*names: str) -> str:
        return ", ".join(f"{n} {S.PAYLOAD_SCHEMA[n].dataType.simpleString()}" for n in names)
    envelope = "event_id STRING, session_id STRING, customer_id STRING, timestamp TIMESTAMP_NTZ, "
    shapes = {
        "page_views": columns("page_url", "page_title", "time_on_page", "scroll_depth", "device_type", "browser", "traffic_source"),
        "product_interactions": "event_type STRING, " + columns(
            "product_id", "product_name", "product_category", "product_brand", "product_price", "quantity", "variant", "discount_applied",
            "device_type", "page_url"),
        "purchases": columns("order_id", "subtotal", "tax_amount", "shipping_cost", "discount_amount", "total_amount", "currency",
                             "payment_method", "shipping_method", "coupon_code", "device_type", "is_guest_checkout")}
    for name, shape in shapes.items():
        spark.sql(f"CREATE TABLE {prefix}_{name} ({envelope}{shape}) USING parquet LOCATION '{folder}/{name}'")
    return {name: f"{prefix}_{name}" for name in shapes}
