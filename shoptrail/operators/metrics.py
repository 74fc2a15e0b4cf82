"""KPIs, reports, top-k and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.functions.events import counter_group, money_avg, pct


def event_rate(df: DataFrame, ts: str = "timestamp", minutes: int = 1) -> DataFrame:
    """M1: events per tumbling window of ``minutes``."""
    w = F.window(F.col(ts).cast("timestamp"), f"{minutes} minutes")
    return (df.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("events"))
              .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), "events"))


def type_distribution(df: DataFrame) -> DataFrame:
    """Events per type with the live-counter group and share %.
    The share's keyless window runs over the per-type aggregate (one row per
    type), never over events."""
    return (df.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
              .withColumn("counter_group", counter_group("event_type"))
              .withColumn("share_pct", pct("events", F.sum("events").over(Window.partitionBy()))))


def daily_volume(df: DataFrame, as_of, days: int = 7, ts: str = "timestamp") -> DataFrame:
    """M3: events per day for the ``days`` days ending the day before ``as_of``."""
    end = F.lit(str(as_of)).cast("date")
    d = df.select(F.to_date(ts).alias("day"))
    return (d.filter((F.col("day") < end) & (F.col("day") >= F.date_sub(end, days)))
             .groupBy("day").agg(F.count(F.lit(1)).alias("events")))


def weekly_revenue(purchases: DataFrame, as_of, weeks: int = 4) -> DataFrame:
    """M4: revenue per ISO week (Monday start) for the ``weeks`` weeks before
    the week of ``as_of``."""
    this_week = F.date_trunc("week", F.lit(str(as_of)).cast("timestamp")).cast("date")
    wk = F.date_trunc("week", F.col("timestamp").cast("timestamp")).cast("date")
    d = purchases.select(wk.alias("week_start"), "total_amount")
    return (d.filter((F.col("week_start") < this_week)
                     & (F.col("week_start") >= F.date_sub(this_week, 7 * weeks)))
             .groupBy("week_start")
             .agg(F.sum("total_amount").cast("double").alias("revenue"),
                  F.count(F.lit(1)).alias("orders")))


def segment_distribution(customers: DataFrame, segment: str = "customer_segment") -> DataFrame:
    """M5: customers per segment and share of all customers (keyless window
    over the per-segment aggregate only)."""
    return (customers.groupBy(segment).agg(F.count(F.lit(1)).alias("customers"))
                     .withColumn("share_pct", pct("customers", F.sum("customers").over(Window.partitionBy()))))


def revenue_kpis(purchases: DataFrame) -> DataFrame:
    """M6: total revenue, orders, average order value (one row)."""
    return (purchases.agg(F.sum("total_amount").alias("_rev"), F.count(F.lit(1)).alias("orders"))
            .select(F.col("_rev").cast("double").alias("total_revenue"), "orders",
                    money_avg("_rev", "orders").alias("avg_order_value")))


def top_category(items: DataFrame) -> DataFrame:
    """M7: the category with the highest item revenue (ties by name)."""
    return (items.groupBy("category").agg(F.sum("line_total").cast("double").alias("revenue"))
                 .orderBy(F.col("revenue").desc_nulls_last(), F.col("category").asc_nulls_last()).limit(1))


def session_kpis(sessions: DataFrame, raw: DataFrame) -> DataFrame:
    """M8: conversion rate %, average session seconds, events per session."""
    s = sessions.agg(F.count(F.lit(1)).alias("sessions"),
                     F.count_if(F.col("conversion_flag")).alias("converted"),
                     F.sum("duration_seconds").alias("_dur"))
    e = raw.filter(F.col("session_id").isNotNull()).agg(F.count(F.lit(1)).alias("_events"))
    from shoptrail.operators.dedup import side_by_side
    j = side_by_side([s, e])
    return j.select("sessions", "converted",
                    pct("converted", "sessions").alias("conversion_rate_pct"),
                    (F.floor((F.col("_dur").cast("double") * 200.0 + F.col("sessions")) / (F.col("sessions") * 2.0)) / 100.0).alias("avg_session_seconds"),
                    (F.floor((F.col("_events").cast("double") * 200.0 + F.col("sessions")) / (F.col("sessions") * 2.0)) / 100.0).alias("events_per_session")).drop("_x")


def growth_rate(periods: DataFrame, period: str, value: str) -> DataFrame:
    """M9: period-over-period growth % of ``value``. The input is already an
    aggregate (one row per period), so the global ordering is over a few rows."""
    w = Window.orderBy(period)
    prev = F.lag(value).over(w)
    cents = F.round(F.col(value) * 100).cast("long").cast("double")
    prev_c = F.round(prev * 100).cast("long").cast("double")
    return periods.select(period, value, prev.alias("previous"),
                          F.when(prev_c != 0, F.floor(((cents - prev_c) * 20000.0 + prev_c) / (prev_c * 2.0)) / 100.0)
                          .alias("growth_pct"))


def storage_share(raw: DataFrame) -> DataFrame:
    """Events per store and share %, 1 dp, total floored at 1 (keyless
    window over the per-store aggregate only)."""
    per = raw.groupBy("storage_type").agg(F.count(F.lit(1)).alias("events"))
    total = F.greatest(F.sum("events").over(Window.partitionBy()), F.lit(1))
    return per.withColumn("share_pct", pct("events", total, 1))


def latest(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The newest ``n`` rows (a TakeOrdered: top-n per task, then merged)."""
    return df.orderBy(*order).limit(n)


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """T5: top ``n`` rows per group with their ``rank``. The rank filter
    becomes a partial ``WindowGroupLimit`` before the shuffle, so a hot group
    sends at most ``n`` rows per map task, not all of its rows."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
              .withColumn("rank", F.col("_rn").cast("long")).drop("_rn"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table, as one union of global counts."""
    from shoptrail.operators.dedup import union_by_name
    return union_by_name([df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()])


def processed_counts(raw: DataFrame) -> DataFrame:
    """U6/A14 straight from RAW_EVENTS: row counts of the raw and the routed
    tables and of the purchase items, in one scan."""
    good = F.col("is_valid") == F.lit(True)
    buys = good & F.col("event_type").isin(*S.PURCHASE_TYPES)
    items = F.from_json(F.when(buys, F.col("event_data")), S.PAYLOAD_SCHEMA)["items"]
    one = raw.agg(F.count(F.lit(1)).alias("raw_events"),
                  *[F.count_if(good & F.col("event_type").isin(*types)).alias(table.lower()) for table, types in S.TABLE_PRECEDENCE],
                  F.coalesce(F.sum(F.when(items.isNotNull(), F.size(items)).cast("long")), F.lit(0)).alias("purchase_items"))
    return one.unpivot([], one.columns, "table_name", "row_count")


def freshness(raw: DataFrame, page_views: DataFrame, created_col: str = "created_at") -> DataFrame:
    """Newest ingestion time and newest processed row, as one row
    (two one-row aggregates side by side; no join at all)."""
    from shoptrail.operators.dedup import side_by_side
    a = raw.agg(F.max("ingestion_time").alias("last_ingestion_time"))
    b = page_views.agg(F.max(created_col).alias("last_processed_time"))
    return side_by_side([a, b])


def counters(wire: DataFrame, valid_flag: str = "is_valid_event") -> DataFrame:
    """M11 (batch twin): raw / clean / invalid totals, counter-group totals
    and the quality score, as (counter, value) rows."""
    g = counter_group("event_type")
    agg = wire.agg(
        F.count(F.lit(1)).alias("raw_events_count"),
        F.count_if(F.col(valid_flag)).alias("clean_events_count"),
        F.count_if(~F.col(valid_flag)).alias("invalid_events_count"),
        F.count_if(g == "page_views").alias("page_views"),
        F.count_if(g == "product_interactions").alias("product_interactions"),
        F.count_if(g == "purchases").alias("purchases"),
        F.count_if(g == "searches").alias("searches"),
        F.count_if(g == "user_engagement").alias("user_engagement"))
    names = ["raw_events_count", "clean_events_count", "invalid_events_count", "page_views",
             "product_interactions", "purchases", "searches", "user_engagement"]
    stack = F.expr("stack({n}, {pairs}) as (counter, value)".format(
        n=len(names), pairs=", ".join(f"'{c}', {c}" for c in names)))
    quality = agg.select(F.lit("data_quality_score").alias("counter"),
                         F.when(F.col("raw_events_count") > 0,
                                pct("clean_events_count", "raw_events_count", 1)).otherwise(F.lit(100.0)).alias("value"))
    return agg.select(stack).select("counter", F.col("value").cast("double")).unionByName(quality)


def cumulative_counts(wire: DataFrame, valid_flag: str = "is_valid_event", ts: str = "timestamp",
                      minutes: int = 60, points: int = 20) -> DataFrame:
    """Cumulative raw and clean counts per ``minutes`` long time bucket,
    last ``points`` buckets. Counts are aggregated per bucket first; the running sum then
    runs over one row per bucket."""
    per = (wire.groupBy(F.window(ts, f"{int(minutes)} minutes")["start"].alias("bucket"))
               .agg(F.count(F.lit(1)).alias("raw"), F.count_if(F.col(valid_flag)).alias("clean")))
    w = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    cum = per.select("bucket", F.sum("raw").over(w).alias("cumulative_raw"),
                     F.sum("clean").over(w).alias("cumulative_clean"))
    return cum.orderBy(F.col("bucket").desc()).limit(points)


def file_stats(df: DataFrame) -> DataFrame:
    """Per file: records, bytes, modification time (from the scan's
    hidden ``_metadata`` column), plus totals per folder."""
    m = df.select(F.col("_metadata.file_path").alias("file_path"),
                  F.col("_metadata.file_name").alias("file_name"),
                  F.col("_metadata.file_size").alias("file_size"),
                  F.col("_metadata.file_modification_time").alias("modified"))
    return (m.groupBy("file_path", "file_name", "file_size", "modified")
             .agg(F.count(F.lit(1)).alias("records")))


def file_summary(df: DataFrame) -> DataFrame:
    """A13 totals: file count, MB (2 dp), records, newest file."""
    per = file_stats(df)
    return per.agg(F.count(F.lit(1)).alias("files"),
                   F.round(F.sum("file_size") / (1024 * 1024), 2).alias("size_mb"),
                   F.sum("records").alias("records"),
                   F.max_by("file_name", "modified").alias("latest_file"))


def load_report(loaded: DataFrame, file_col: str = "source_file", loaded_at=None) -> DataFrame:
    """K6: per source file, rows loaded, a success flag and the load time --
    the bulk loader's per-file result list as a DataFrame (one grouped
    aggregate over the appended rows)."""
    ts = F.current_timestamp().cast("timestamp_ntz") if loaded_at is None else F.lit(str(loaded_at)).cast("timestamp_ntz")
    return (loaded.groupBy(file_col).agg(F.count(F.lit(1)).alias("rows_loaded"))
                  .select(F.col(file_col).alias("file"), "rows_loaded",
                          (F.col("rows_loaded") > 0).alias("success"), ts.alias("timestamp")))
