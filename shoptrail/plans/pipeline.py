"""The batch pipeline over the driver tables, one lazy plan per output.

wire events (fixture adapter) -> RAW_EVENTS -> processed tables -> views.
Nothing here collects; each function returns a DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.operators import route
from shoptrail.operators.land import to_raw_events
from shoptrail.session import scratch_path
from shoptrail.sources.fixtures import FIXTURE_NOW, raw_event_stream, read_table


def wire_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_event_stream(spark, sf_dir)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW_EVENTS landed from the whole ``events`` table (lazy plan)."""
    return to_raw_events(wire_events(spark, sf_dir), as_of=FIXTURE_NOW)


def landed_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW_EVENTS written once as a Parquet table and read back, as the
    pipeline's landing table.

    Plans that fan out into several routed tables read this instead of
    re-deriving the landing step per branch. The table lives in the shared
    folder named by ``spark.checkpoint.dir`` (it survives executor loss and
    cuts the lineage); being Parquet, later filters and projections push
    down into its scan, and rows are sorted by event time within each file
    so row-group statistics prune time-range filters."""
    path = scratch_path(spark, f"landed/raw_events-{uuid.uuid4().hex}")
    (raw_events(spark, sf_dir).sortWithinPartitions("timestamp")
        .write.mode("overwrite").parquet(path))
    return spark.read.parquet(path)


def processed(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> dict[str, DataFrame]:
    raw = raw if raw is not None else landed_raw_events(spark, sf_dir)
    buys = route.purchases(raw)
    return {
        "page_views": route.page_views(raw),
        "product_interactions": route.product_interactions(raw),
        "purchases": buys,
        "searches": route.searches(raw),
        "user_engagement": route.user_engagement(raw),
        "purchase_items": route.purchase_items(buys, product_dim(spark, sf_dir)),
    }


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension from ``part``: PROD_<partkey>, name, type, brand."""
    return read_table(spark, sf_dir, "part").select(
        F.concat(F.lit("PROD_"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"))


def order_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historic orders as purchases: customer CUST_<custkey>, order id,
    total, order time."""
    return read_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("CUST_"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_orderstatus").alias("order_status"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historic order lines as purchase items, with catalogue fields."""
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.concat(F.lit("PROD_"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("line_total"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax"))
    dim = product_dim(spark, sf_dir).drop("price")
    return li.join(dim, "product_id", "left")


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension: CUST_<custkey>, name, segment, country name."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    return c.join(n, "c_nationkey", "left").select(
        F.concat(F.lit("CUST_"), F.col("c_custkey").cast("string")).alias("customer_id"),
        F.col("c_name").alias("full_name"), F.col("c_mktsegment").alias("customer_segment"), "country")
