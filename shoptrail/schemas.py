"""Canonical schemas and fixed value sets.

The values under "Fixed values" must equal the ones the pipeline we mirror
uses, so that validation, routing and scoring give the same answers. They
are stated once here, in natural order, and every operator imports them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the mirrored pipeline exactly)
# ---------------------------------------------------------------------------

# Event types accepted by the stream validator.
VALID_EVENT_TYPES = ["PAGE_VIEW", "PRODUCT_VIEW", "ADD_TO_CART", "PURCHASE", "SEARCH", "REVIEW"]

# Event types that must carry a positive amount and a currency.
MONEY_EVENT_TYPES = ["ADD_TO_CART", "PURCHASE"]

# Event category per type (other types have no category).
EVENT_CATEGORY = {
    "PAGE_VIEW": "engagement",
    "SEARCH": "engagement",
    "PRODUCT_VIEW": "consideration",
    "ADD_TO_CART": "consideration",
    "PURCHASE": "conversion",
    "REVIEW": "retention",
}

# Business value score per type (other types score 0).
BUSINESS_VALUE_SCORE = {
    "PAGE_VIEW": 1,
    "PRODUCT_VIEW": 3,
    "SEARCH": 2,
    "ADD_TO_CART": 7,
    "PURCHASE": 10,
    "REVIEW": 5,
}

PROCESSOR_VERSION = "enhanced_stream_processor_v1.0"

# Routing sets: raw event type -> processed table.
PAGE_VIEW_TYPES = ["PAGE_VIEW"]
PRODUCT_INTERACTION_TYPES = ["PRODUCT_VIEW", "ADD_TO_CART", "REMOVE_FROM_CART", "ADD_TO_WISHLIST"]
PURCHASE_TYPES = ["PURCHASE"]
SEARCH_TYPES = ["SEARCH"]
USER_ENGAGEMENT_TYPES = ["REVIEW", "RATING", "SHARE", "NEWSLETTER_SIGNUP", "ACCOUNT_UPDATE"]

# Batch table chooser precedence (first match wins), and its fallback.
TABLE_PRECEDENCE = [
    ("PAGE_VIEWS", PAGE_VIEW_TYPES),
    ("PRODUCT_INTERACTIONS", PRODUCT_INTERACTION_TYPES),
    ("PURCHASES", PURCHASE_TYPES),
    ("SEARCHES", SEARCH_TYPES),
    ("USER_ENGAGEMENT", USER_ENGAGEMENT_TYPES),
]
# Every type that some processed table takes; a type belongs to one table.
PROCESSED_TYPES = [t for _, types in TABLE_PRECEDENCE for t in types]
# The whole-batch chooser does not know account updates.
BATCH_TABLE_PRECEDENCE = [(table, [t for t in types if t != "ACCOUNT_UPDATE"]) for table, types in TABLE_PRECEDENCE]
MIXED_TABLE = "MIXED_EVENTS"

# "Product interactions today" in the realtime metrics view (no ADD_TO_WISHLIST).
REALTIME_PRODUCT_TYPES = ["PRODUCT_VIEW", "ADD_TO_CART", "REMOVE_FROM_CART"]

# Live counter groups (narrower than the routing sets).
COUNTER_GROUPS = {
    "PAGE_VIEW": "page_views",
    "PRODUCT_VIEW": "product_interactions",
    "ADD_TO_CART": "product_interactions",
    "PURCHASE": "purchases",
    "SEARCH": "searches",
    "REVIEW": "user_engagement",
}

# Page titles for known URLs; other URLs get "<Title-cased path> - E-commerce Store".
PAGE_TITLES = {
    "/": "Home - E-commerce Store",
    "/products": "All Products - E-commerce Store",
    "/categories/electronics": "Electronics - E-commerce Store",
    "/categories/clothing": "Clothing - E-commerce Store",
    "/categories/footwear": "Footwear - E-commerce Store",
    "/search": "Search Results - E-commerce Store",
    "/cart": "Shopping Cart - E-commerce Store",
    "/checkout": "Checkout - E-commerce Store",
    "/account": "My Account - E-commerce Store",
    "/sale": "Sale Items - E-commerce Store",
    "/new-arrivals": "New Arrivals - E-commerce Store",
}
PAGE_TITLE_SUFFIX = " - E-commerce Store"

# Data-quality issue vocabulary.
ISSUE_MISSING_CUSTOMER = "missing_customer_id"
ISSUE_MISSING_SESSION = "missing_session_id"
ISSUE_MISSING_TIMESTAMP = "missing_timestamp"
ISSUE_INVALID_AMOUNT = "invalid_amount_format"
ISSUE_FUTURE_TIMESTAMP = "future_timestamp"
ISSUE_NEGATIVE_PRICE = "negative_price"

# Order arithmetic: tax rate, free-shipping threshold, flat shipping fee.
TAX_RATE = "0.08"
FREE_SHIPPING_OVER = "50"
SHIPPING_FEE = "9.99"

# Quality bands (percent): >= 90 excellent, >= 70 good, else poor.
QUALITY_BANDS = [(90, "excellent"), (70, "good")]
QUALITY_BAND_FALLBACK = "poor"

# Future-timestamp tolerance of the stream validator.
FUTURE_TOLERANCE = "INTERVAL 1 HOUR"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

# Landing table RAW_EVENTS (plus the three ETL bookkeeping columns).
RAW_EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("event_data", T.StringType()),
    T.StructField("data_quality_issues", T.StringType()),
    T.StructField("is_valid", T.BooleanType()),
    T.StructField("partition_id", T.IntegerType()),
    T.StructField("offset_id", T.LongType()),
    T.StructField("ingestion_time", T.TimestampNTZType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("storage_type", T.StringType()),
    T.StructField("etl_run_id", T.StringType()),
    T.StructField("etl_timestamp", T.TimestampNTZType()),
])

# Flat wire dialect (topic raw_events).
FLAT_EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("amount", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("event_data", T.StringType()),
    T.StructField("is_valid", T.BooleanType()),
    T.StructField("invalid_field", T.StringType()),
    T.StructField("source", T.StringType()),
])

ITEM_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.DecimalType(10, 2)),
    T.StructField("quantity", T.IntegerType()),
])

SEARCH_FILTERS_SCHEMA = T.StructType([
    T.StructField("price_min", T.IntegerType()),
    T.StructField("price_max", T.IntegerType()),
    T.StructField("brand", T.StringType()),
    T.StructField("rating", T.IntegerType()),
])

# Payload schema: the union of every type-specific field, parsed once.
PAYLOAD_SCHEMA = T.StructType([
    # page views
    T.StructField("page_url", T.StringType()),
    T.StructField("page_title", T.StringType()),
    T.StructField("previous_page", T.StringType()),
    T.StructField("time_on_page", T.IntegerType()),
    T.StructField("scroll_depth", T.IntegerType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("browser", T.StringType()),
    T.StructField("traffic_source", T.StringType()),
    T.StructField("is_bounce", T.BooleanType()),
    # product interactions
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("product_brand", T.StringType()),
    T.StructField("product_price", T.DecimalType(10, 2)),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("variant", T.StringType()),
    T.StructField("discount_applied", T.DecimalType(5, 4)),
    # purchases
    T.StructField("order_id", T.StringType()),
    T.StructField("items", T.ArrayType(ITEM_SCHEMA)),
    T.StructField("subtotal", T.DecimalType(12, 2)),
    T.StructField("tax_amount", T.DecimalType(12, 2)),
    T.StructField("shipping_cost", T.DecimalType(10, 2)),
    T.StructField("discount_amount", T.DecimalType(10, 2)),
    T.StructField("total_amount", T.DecimalType(12, 2)),
    T.StructField("currency", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("shipping_method", T.StringType()),
    T.StructField("coupon_code", T.StringType()),
    T.StructField("is_guest_checkout", T.BooleanType()),
    # searches
    T.StructField("search_query", T.StringType()),
    T.StructField("search_results_count", T.IntegerType()),
    T.StructField("search_category", T.StringType()),
    T.StructField("search_filters", SEARCH_FILTERS_SCHEMA),
    T.StructField("clicked_result_position", T.IntegerType()),
    # user engagement
    T.StructField("rating", T.IntegerType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("is_verified_purchase", T.BooleanType()),
    T.StructField("shared_content", T.StringType()),
    T.StructField("share_platform", T.StringType()),
    T.StructField("shared_url", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("subscription_type", T.StringType()),
])
