"""Adapter from the driver's test tables to the e-commerce event shape.

This is a deterministic projection, not a generator: every raw event is one
row of ``events`` (all rows, every run), its product fields come from a
lookup join on ``part``, and its session from sessionising each user's
events with a 12-hour inactivity gap. A deterministic twin of the mirrored
pipeline's defect injector (which corrupts about 15 % of events at random)
corrupts rows by rules on the event id, so validation and quality operators
have something to find; it changes values, it never drops rows.

The same projection is written in SQL in ``shoptrail.plans.oracles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.functions.events import page_title
from shoptrail.operators.ordered import sessionize
from shoptrail.schemas import PAGE_TITLES

# Fixture values: the pages whose titles are known plus one that is not, and
# numbered names by a rule elsewhere (no operator depends on them).
URLS = [*PAGE_TITLES, "/not-in-the-list"]
DEVICES = [f"device_{i}" for i in range(3)]
BROWSERS = [f"browser_{i}" for i in range(4)]
TRAFFIC = [f"channel_{i}" for i in range(5)]
PAYMENTS = [f"payment_{i}" for i in range(5)]
SHIPPING = [f"carrier_{i}" for i in range(3)]
SIZES = [f"size_{i}" for i in range(3)]
QUERIES = [f"query {i}" for i in range(8)]
SEARCH_CATS = [f"search_group_{i}" for i in range(4)]
SUBSCRIPTIONS = [f"list_{i}" for i in range(3)]

SESSION_GAP = "12 hours"
# Fixture clocks: "now" for validation (after the last event) and "today"
# for the one-day views.
FIXTURE_NOW = "2024-01-31 00:00:00"
FIXTURE_TODAY = "2024-01-15"
ORDERS_TODAY = "2001-08-02"

PRODUCT_TYPES = ["PRODUCT_VIEW", "ADD_TO_CART", "REMOVE_FROM_CART", "ADD_TO_WISHLIST"]


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat typed events with every payload field as a column."""
    ev = read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("eid"), "ts", "user_id",
        F.col("event_type").alias("src_type"), "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"))
    # Product catalogue lookup (J7). Spark sizes the join itself: part is a
    # dimension at test scale and a shuffled join when it is not.
    part = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("k"), "p_name", "p_brand", "p_type", "p_retailprice")
    ev = ev.join(part, "k", "left")

    ev = sessionize(ev, ["user_id"], "ts", "eid", SESSION_GAP, out="session_no")

    k = F.col("k")
    eid = F.col("eid")
    uid = F.col("user_id")
    etype = (F.when(F.col("src_type") == "view",
                    F.when(k % 2 == 0, "PAGE_VIEW").otherwise("PRODUCT_VIEW"))
             .when(F.col("src_type") == "click",
                   _pick(["ADD_TO_CART", "REMOVE_FROM_CART", "ADD_TO_WISHLIST", "SEARCH"], k % 4))
             .when(F.col("src_type") == "purchase", F.lit("PURCHASE"))
             .when(F.col("src_type") == "signup",
                   F.when(k % 2 == 0, "NEWSLETTER_SIGNUP").otherwise("REVIEW"))
             .otherwise(F.lit("ERROR")))

    # Deterministic defect rules (value changes only).
    d_customer = eid % 53 == 7
    d_session = eid % 97 == 13
    d_future = eid % 71 == 5
    d_text_amount = eid % 37 == 3
    d_neg_amount = eid % 43 == 19
    d_currency = eid % 59 == 11
    d_neg_price = eid % 41 == 17
    amount_dec = F.col("value").cast("decimal(12,2)")
    invalid_field = (F.when(d_customer, "customer_id").when(d_session, "session_id")
                     .when(d_future, "timestamp").when(d_text_amount | d_neg_amount, "amount")
                     .when(d_currency, "currency").when(d_neg_price, "product_price"))

    ev = ev.select(
        "eid", "k", "user_id", "ts", "p_name", "p_brand", "p_type", "p_retailprice",
        F.concat(F.lit("EVT_"), eid.cast("string")).alias("event_id"),
        etype.alias("event_type"),
        F.when(d_session, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("SES_"), uid.cast("string"), F.lit("_"),
                             F.col("session_no").cast("string"))).alias("session_id"),
        F.when(d_customer, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("CUST_"), uid.cast("string"))).alias("customer_id"),
        F.when(d_future, F.col("ts") + F.expr("INTERVAL 45 DAYS")).otherwise(F.col("ts")).alias("timestamp"),
        F.when(d_text_amount, F.lit("invalid_amount"))
         .when(d_neg_amount, (-amount_dec).cast("string"))
         .otherwise(amount_dec.cast("string")).alias("amount"),
        F.when(d_currency, F.lit(None).cast("string")).otherwise(F.lit("USD")).alias("currency"),
        invalid_field.isNull().alias("declared_valid"),
        invalid_field.alias("invalid_field"),
        d_neg_price.alias("neg_price"),
    )
    return ev


def _payload(ev: DataFrame) -> DataFrame:
    k = F.col("k")
    uid = F.col("user_id")
    et = F.col("event_type")

    def on(types, value):
        return F.when(et.isin(*types), value)

    is_page = ["PAGE_VIEW"]
    is_prod = PRODUCT_TYPES
    is_buy = ["PURCHASE"]
    is_search = ["SEARCH"]
    is_review = ["REVIEW"]
    is_news = ["NEWSLETTER_SIGNUP"]

    price = F.col("p_retailprice").cast("decimal(10,2)")
    prod_price = F.when(F.col("neg_price"), -price).otherwise(price).cast("decimal(10,2)")
    n_items = 1 + k % 3

    def part_key(i):
        return 1 + (F.col("eid") + 31 * i) % F.col("n_parts")
    items = F.transform(F.sequence(F.lit(0), n_items - 1), lambda i: F.struct(
        F.concat(F.lit("PROD_"), part_key(i).cast("string")).alias("product_id"),
        F.lit(None).cast("string").alias("product_name"),
        F.lit(None).cast("string").alias("category"),
        F.lit(None).cast("string").alias("brand"),
        (F.lit(5).cast("decimal(10,2)") + part_key(i).cast("decimal(10,2)")
         * F.lit("1.25").cast("decimal(10,2)")).cast("decimal(10,2)").alias("price"),
        (1 + (k + i) % 3).cast("int").alias("quantity")))
    ev = ev.withColumn("_items", on(is_buy, items))
    subtotal = F.aggregate("_items", F.lit(0).cast("decimal(12,2)"),
                           lambda acc, x: (acc + x["price"] * x["quantity"]).cast("decimal(12,2)"))
    ev = ev.withColumn("_subtotal", subtotal)
    sub = F.col("_subtotal")
    tax = F.round(sub * F.lit("0.08").cast("decimal(4,2)"), 2).cast("decimal(12,2)")
    ship = F.when(sub > 50, F.lit(0).cast("decimal(10,2)")).otherwise(F.lit("9.99").cast("decimal(10,2)"))
    disc = F.when(k % 4 == 0, F.round(sub * F.lit("0.10").cast("decimal(4,2)"), 2).cast("decimal(10,2)")
                  ).otherwise(F.lit(0).cast("decimal(10,2)"))
    ev = ev.withColumn("_tax", tax).withColumn("_ship", ship).withColumn("_disc", disc)
    total = (sub + F.col("_tax") + F.col("_ship") - F.col("_disc")).cast("decimal(12,2)")
    device = _pick(DEVICES, uid % 3)
    page_url = _pick(URLS, k % 12)
    product_id = F.concat(F.lit("PROD_"), k.cast("string"))

    payload = F.struct(
        F.coalesce(on(is_page, page_url), on(is_prod, F.concat(F.lit("/product/prod_"), k.cast("string")))).alias("page_url"),
        on(is_page, page_title(page_url)).alias("page_title"),
        on(is_page, (5 + (k * 7) % 300).cast("int")).alias("time_on_page"),
        on(is_page, k.cast("int")).alias("scroll_depth"),
        device.alias("device_type"),
        on(is_page, _pick(BROWSERS, uid % 4)).alias("browser"),
        on(is_page, _pick(TRAFFIC, uid % 5)).alias("traffic_source"),
        on(is_prod + is_review, product_id).alias("product_id"),
        on(is_prod, F.col("p_name")).alias("product_name"),
        on(is_prod, F.col("p_type")).alias("product_category"),
        on(is_prod, F.col("p_brand")).alias("product_brand"),
        on(is_prod, prod_price).alias("product_price"),
        on(is_prod, (1 + k % 3).cast("int")).alias("quantity"),
        on(is_prod, F.when(k % 2 == 1, _pick(SIZES, k % 3))).alias("variant"),
        on(is_prod, ((k % 5).cast("decimal(5,4)") * F.lit("0.05").cast("decimal(3,2)")).cast("decimal(5,4)")).alias("discount_applied"),
        on(is_buy, F.concat(F.lit("ORD_"), F.col("eid").cast("string"))).alias("order_id"),
        F.col("_items").alias("items"),
        on(is_buy, sub).alias("subtotal"),
        on(is_buy, F.col("_tax")).alias("tax_amount"),
        on(is_buy, F.col("_ship")).alias("shipping_cost"),
        on(is_buy, F.col("_disc")).alias("discount_amount"),
        on(is_buy, total).alias("total_amount"),
        on(is_buy, F.col("currency")).alias("currency"),
        on(is_buy, _pick(PAYMENTS, k % 5)).alias("payment_method"),
        on(is_buy, _pick(SHIPPING, uid % 3)).alias("shipping_method"),
        on(is_buy, F.when(k % 4 == 0, F.lit("SAVE10"))).alias("coupon_code"),
        on(is_buy, k % 7 == 0).alias("is_guest_checkout"),
        on(is_search, _pick(QUERIES, k % 8)).alias("search_query"),
        on(is_search, ((k * 13) % 200).cast("int")).alias("search_results_count"),
        on(is_search, F.when(k % 3 != 0, _pick(SEARCH_CATS, k % 4))).alias("search_category"),
        on(is_search, F.struct(
            ((k % 5) * 10).cast("int").alias("price_min"),
            ((k % 5) * 10 + 100).cast("int").alias("price_max"),
            F.when(k % 2 == 0, F.col("p_brand")).alias("brand"),
            (1 + k % 5).cast("int").alias("rating"))).alias("search_filters"),
        on(is_search, F.when(k % 4 != 0, 1 + k % 10).cast("int")).alias("clicked_result_position"),
        on(is_review, (1 + k % 5).cast("int")).alias("rating"),
        on(is_review, F.concat(F.lit("Review of "), F.col("p_name"))).alias("review_text"),
        on(is_review, k % 2 == 0).alias("is_verified_purchase"),
        on(is_news, F.concat(F.lower(F.col("customer_id")), F.lit("@example.com"))).alias("email"),
        on(is_news, _pick(SUBSCRIPTIONS, k % 3)).alias("subscription_type"),
    )
    return ev.withColumn("payload", payload)


def raw_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat-dialect wire events (one per ``events`` row), as a batch.

    Columns: event_id, customer_id, event_type, amount (text), currency,
    event_timestamp (ISO text), session_id, event_data (JSON), is_valid,
    invalid_field, source, plus the topic coordinates partition and offset.
    """
    parts = read_table(spark, sf_dir, "part").agg(F.max("p_partkey").cast("long"))
    ev = _payload(_typed_events(spark, sf_dir).withColumn("n_parts", parts.scalar()))
    return ev.select(
        "event_id", "customer_id", "event_type", "amount", "currency",
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
        "session_id",
        F.to_json("payload").alias("event_data"),
        F.col("declared_valid").alias("is_valid"),
        "invalid_field",
        F.lit("events.parquet").alias("source"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("eid").alias("offset"),
        "timestamp",
        (F.col("ts") + F.expr("INTERVAL 90 SECONDS")).alias("ingestion_time"),
    )
