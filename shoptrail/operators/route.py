"""Routing RAW_EVENTS into typed tables, payload extraction.

The payload is JSON text in RAW_EVENTS; each router parses it once with
``from_json`` against the union payload schema (missing path -> NULL, a
value of the wrong type -> NULL instead of a failed job) and then only
projects fields, so the parse, filter and projection fuse in one codegen
stage right after the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.operators.enrich import with_bounce, with_previous_page
from shoptrail.operators.validate import processed_filter

_P = "_p"


def with_payload(df: DataFrame, col: str = "event_data") -> DataFrame:
    return df.withColumn(_P, F.from_json(F.col(col), S.PAYLOAD_SCHEMA))


def _p(field: str):
    return F.col(f"{_P}.{field}")


_ENVELOPE = ["event_id", "session_id", "customer_id", "timestamp"]


def page_views(raw: DataFrame, derive_session_fields: bool = True) -> DataFrame:
    """PAGE_VIEWS. When the payload lacks ``previous_page`` / ``is_bounce``
    they are derived per session (E6, E7)."""
    d = with_payload(processed_filter(raw, S.PAGE_VIEW_TYPES)).select(
        *_ENVELOPE, F.lit("PAGE_VIEW").alias("event_type"),
        _p("page_url").alias("page_url"), _p("page_title").alias("page_title"),
        _p("previous_page").alias("_pp"), _p("time_on_page").alias("time_on_page"),
        _p("scroll_depth").alias("scroll_depth"), _p("device_type").alias("device_type"),
        _p("browser").alias("browser"), _p("traffic_source").alias("traffic_source"),
        _p("is_bounce").alias("_bounce"))
    d = d.withColumnRenamed("_pp", "previous_page").withColumnRenamed("_bounce", "is_bounce")
    return with_session_fields(d) if derive_session_fields else d


def with_session_fields(views: DataFrame) -> DataFrame:
    """E6, E7 over a page view table: ``previous_page`` and ``is_bounce`` where
    the payload gave none. Both depend on the whole session, so a table that
    grows by increments keeps the payload's values and is read through this."""
    d = with_bounce(with_previous_page(views, out="_lag"), out="_b")
    return (d.withColumn("previous_page", F.coalesce("previous_page", "_lag"))
             .withColumn("is_bounce", F.coalesce("is_bounce", "_b"))
             .drop("_lag", "_b"))


def product_interactions(raw: DataFrame) -> DataFrame:
    """R2: PRODUCT_INTERACTIONS."""
    return with_payload(processed_filter(raw, S.PRODUCT_INTERACTION_TYPES)).select(
        "event_id", "event_type", "session_id", "customer_id", "timestamp",
        _p("product_id").alias("product_id"), _p("product_name").alias("product_name"),
        _p("product_category").alias("product_category"), _p("product_brand").alias("product_brand"),
        _p("product_price").alias("product_price"), _p("quantity").alias("quantity"),
        _p("variant").alias("variant"), _p("discount_applied").alias("discount_applied"),
        _p("device_type").alias("device_type"), _p("page_url").alias("page_url"))


def purchases(raw: DataFrame) -> DataFrame:
    """PURCHASES; ``items`` stays semi-structured (JSON text)."""
    return with_payload(processed_filter(raw, S.PURCHASE_TYPES)).select(
        *_ENVELOPE,
        _p("order_id").alias("order_id"), F.to_json(_p("items")).alias("items"),
        _p("subtotal").alias("subtotal"), _p("tax_amount").alias("tax_amount"),
        _p("shipping_cost").alias("shipping_cost"), _p("discount_amount").alias("discount_amount"),
        _p("total_amount").alias("total_amount"), _p("currency").alias("currency"),
        _p("payment_method").alias("payment_method"), _p("shipping_method").alias("shipping_method"),
        _p("coupon_code").alias("coupon_code"), _p("device_type").alias("device_type"),
        _p("is_guest_checkout").alias("is_guest_checkout"))


def purchase_items(purchases_df: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """One row per item; ``purchase_item_id = event_id || '_' || position``,
    ``line_total = price x quantity``. Names, category and brand missing from
    the item are filled from the product dimension when one is given
    (``products``: product_id, product_name, category, brand)."""
    items = F.from_json(F.col("items"), "array<" + S.ITEM_SCHEMA.simpleString() + ">")
    d = (purchases_df.select("event_id", "order_id", F.posexplode(items).alias("_pos", "_it"))
         .select(F.concat(F.col("event_id"), F.lit("_"), F.col("_pos").cast("string")).alias("purchase_item_id"),
                 "event_id", "order_id",
                 F.col("_it.product_id").alias("product_id"), F.col("_it.product_name").alias("product_name"),
                 F.col("_it.category").alias("category"), F.col("_it.brand").alias("brand"),
                 F.col("_it.price").alias("price"), F.col("_it.quantity").alias("quantity")))
    if products is not None:
        dim = products.select("product_id", F.col("product_name").alias("_dn"),
                              F.col("category").alias("_dc"), F.col("brand").alias("_db"))
        d = (d.join(dim, "product_id", "left")
              .withColumn("product_name", F.coalesce("product_name", "_dn"))
              .withColumn("category", F.coalesce("category", "_dc"))
              .withColumn("brand", F.coalesce("brand", "_db"))
              .drop("_dn", "_dc", "_db"))
    return d.withColumn("line_total", (F.col("price") * F.col("quantity")).cast("decimal(12,2)"))


def searches(raw: DataFrame, expand_filters: bool = False) -> DataFrame:
    """R4 (+ R9 when ``expand_filters``: filter fields as columns)."""
    d = with_payload(processed_filter(raw, S.SEARCH_TYPES))
    cols = [*_ENVELOPE,
            _p("search_query").alias("search_query"),
            _p("search_results_count").alias("search_results_count"),
            _p("search_category").alias("search_category"),
            F.to_json(_p("search_filters")).alias("search_filters"),
            _p("clicked_result_position").alias("clicked_result_position"),
            _p("device_type").alias("device_type")]
    if expand_filters:
        cols += [_p(f"search_filters.{f.name}").alias(f"filter_{f.name}")
                 for f in S.SEARCH_FILTERS_SCHEMA.fields]
    return d.select(*cols)


def user_engagement(raw: DataFrame) -> DataFrame:
    """USER_ENGAGEMENT (reviews, ratings, shares, sign-ups, account updates)."""
    return with_payload(processed_filter(raw, S.USER_ENGAGEMENT_TYPES)).select(
        "event_id", "event_type", "session_id", "customer_id", "timestamp",
        _p("device_type").alias("device_type"), _p("product_id").alias("product_id"),
        _p("rating").alias("rating"), _p("review_text").alias("review_text"),
        _p("is_verified_purchase").alias("is_verified_purchase"),
        _p("shared_content").alias("shared_content"), _p("share_platform").alias("share_platform"),
        _p("shared_url").alias("shared_url"), _p("email").alias("email"),
        _p("subscription_type").alias("subscription_type"))


def target_table(event_type: str = "event_type"):
    """R6 per row: the processed table an event type belongs to."""
    c = F.col(event_type)
    expr = None
    for table, types in S.TABLE_PRECEDENCE:
        expr = F.when(c.isin(*types), F.lit(table)) if expr is None else expr.when(c.isin(*types), F.lit(table))
    return expr.otherwise(F.lit(S.MIXED_TABLE))


def batch_table_choice(df: DataFrame, batch_col: str = "source_file") -> DataFrame:
    """R6 batch form: per batch (file), the one table the mirrored loader
    would pick -- the first table in precedence order whose types occur.
    The set of types per batch is bounded by the type vocabulary."""
    types = df.groupBy(batch_col).agg(F.collect_set("event_type").alias("_types"))
    expr = None
    for table, ts in S.BATCH_TABLE_PRECEDENCE:
        cond = F.arrays_overlap(F.col("_types"), F.array(*[F.lit(t) for t in ts]))
        expr = F.when(cond, F.lit(table)) if expr is None else expr.when(cond, F.lit(table))
    return types.select(batch_col, F.array_sort("_types").alias("event_types"),
                        expr.otherwise(F.lit(S.MIXED_TABLE)).alias("target_table"))
