"""Data-quality operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.functions.events import as_of_ts, order_shipping, order_tax, order_total, pct
from shoptrail.operators.ordered import running_counts


def required_nulls(df: DataFrame, fields=("event_id", "event_type", "timestamp")) -> DataFrame:
    """Q1: NULL counts per required field and their sum, in one pass."""
    aggs = [F.count_if(F.col(f).isNull()).alias(f"missing_{f}") for f in fields]
    out = df.agg(F.count(F.lit(1)).alias("total_rows"), *aggs)
    return out.withColumn("missing_total", sum((F.col(f"missing_{f}") for f in fields), F.lit(0)).cast("long"))


def future_timestamps(df: DataFrame, as_of=None, ts: str = "timestamp") -> DataFrame:
    """Q2: events stamped later than the clock (unparsable times are not counted)."""
    return df.agg(F.count_if(F.col(ts) > as_of_ts(as_of)).alias("future_events"),
                  F.count(F.lit(1)).alias("total_rows"))


def issue_counts(raw: DataFrame) -> DataFrame:
    """Q5 report: rows per issue tag (a row with k tags counts under each)."""
    tags = F.from_json(F.col("data_quality_issues"), "array<string>")
    return (raw.select(F.explode(tags).alias("issue"))
               .groupBy("issue").agg(F.count(F.lit(1)).alias("events")))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Q9: keys that occur more than once (NULL keys reported as a group)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
              .filter(F.col("copies") > 1))


def order_reconciliation(purchases: DataFrame, tolerance: str = "0.02") -> DataFrame:
    """Q8: purchases whose total differs from subtotal + tax + shipping -
    discount by more than ``tolerance``; also re-derives tax and shipping from
    the subtotal with the order rules and reports each mismatch."""
    exp_tax = order_tax("subtotal")
    exp_ship = order_shipping("subtotal")
    exp_total = order_total("subtotal", "tax_amount", "shipping_cost", "discount_amount")
    tol = F.lit(tolerance).cast("decimal(4,2)")
    return (purchases
            .select("event_id", "order_id", "subtotal", "tax_amount", "shipping_cost", "discount_amount",
                    "total_amount",
                    (F.abs(F.col("total_amount") - exp_total) > tol).alias("total_mismatch"),
                    (F.abs(F.col("tax_amount") - exp_tax) > tol).alias("tax_mismatch"),
                    (F.col("shipping_cost") != exp_ship).alias("shipping_mismatch"))
            .filter(F.col("total_mismatch") | F.col("tax_mismatch") | F.col("shipping_mismatch")))


def declared_invalid_breakdown(wire: DataFrame) -> DataFrame:
    """Q10: declared-invalid events counted by the field named invalid."""
    return (wire.filter(F.col("invalid_field").isNotNull())
                .groupBy("invalid_field").agg(F.count(F.lit(1)).alias("events")))


def running_quality(flagged: DataFrame, keys: list[str], ts: str, tie: str,
                    valid_col: str = "is_valid_event", chunk: str = "hour") -> DataFrame:
    """Running processed / valid counts and quality % per key in time
    order (the stream processor's cumulative score, per customer-day here).
    ``chunk`` must be finer than any time unit among the keys."""
    d = running_counts(flagged, keys, ts, tie,
                       {"running_processed": F.lit(True), "running_valid": F.col(valid_col)}, chunk)
    return d.withColumn("running_quality_pct", pct("running_valid", "running_processed", 1))


def order_line_reconciliation(orders: DataFrame, lineitem: DataFrame, tolerance: str = "0.02") -> DataFrame:
    """Q8 for order tables: orders whose total differs from the sum of
    extendedprice x (1 - discount) x (1 + tax) over their lines by more than
    ``tolerance`` (or that have no lines). Lines are summed per order first
    (partial aggregation), then joined to orders on the order key."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    net = price * (1 - F.col("l_discount").cast("decimal(4,2)")) * (1 + F.col("l_tax").cast("decimal(4,2)"))
    lines = lineitem.groupBy("l_orderkey").agg(F.sum(net).alias("_s"), F.count(F.lit(1)).alias("_n"))
    total = F.col("o_totalprice").cast("decimal(12,2)")
    j = orders.select("o_orderkey", "o_totalprice").join(
        lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
    return (j.filter(F.col("_s").isNull() | (F.abs(total - F.col("_s")) > F.lit(tolerance).cast("decimal(4,2)")))
             .select(F.col("o_orderkey").cast("string").alias("order_id"),
                     total.cast("double").alias("order_total"),
                     F.round(F.col("_s"), 2).cast("double").alias("line_total"),
                     F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("lines")))
