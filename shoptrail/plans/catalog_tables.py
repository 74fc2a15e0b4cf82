"""Registered queries of VARIANT payloads, sketches, bucketed and keyed
tables, run statistics and the SQL interface."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.operators import sketches, variants
from shoptrail.plans import oracles as O
from shoptrail.plans import pipeline as P
from shoptrail.plans.catalog import MERGE_CUTOFF, register
from shoptrail.session import scratch_path


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex}")


# ---- VARIANT payloads ----

def _drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW_EVENTS whose producers changed: every 23rd quantity is a word, every
    17th payload has a field that no table knows, every 29th is cut short."""
    raw = P.raw_events(spark, sf_dir)
    n, text = F.col("offset_id"), F.col("event_data")
    text = F.when(n % 23 == 3, F.regexp_replace(text, '"quantity":[0-9]+', '"quantity":"many"')).otherwise(text)
    text = F.when(n % 17 == 2, F.regexp_replace(text, r"^\{", '{"promo":{"code":"P1","step":1},')).otherwise(text)
    return raw.withColumn("event_data", F.when(n % 29 == 4, F.expr("substring(event_data, 1, 7)")).otherwise(text))


_TYPES = O._in(S.PRODUCT_INTERACTION_TYPES)


@register("variant_interactions", O.q(f"""
SELECT event_id, event_type, session_id, customer_id, timestamp,
       CASE WHEN offset_id % 29 <> 4 THEN product_id END AS product_id,
       CASE WHEN offset_id % 29 <> 4 THEN product_price END AS product_price,
       CASE WHEN offset_id % 29 <> 4 AND offset_id % 23 <> 3 THEN quantity END AS quantity,
       CASE WHEN offset_id % 29 = 4 THEN 'bad_json' WHEN offset_id % 23 = 3 THEN 'bad_cast:quantity' ELSE '' END AS payload_issues
FROM rawv WHERE is_valid AND event_type IN {_TYPES}
"""))
def variant_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 from VARIANT payloads, bad values tagged."""
    out = variants.route(_drifted(spark, sf_dir), S.PRODUCT_INTERACTION_TYPES, ["product_id", "product_price", "quantity"])
    return out.withColumn("payload_issues", F.array_join("payload_issues", ","))


@register("variant_items", O.q("""
SELECT purchase_item_id, event_id, product_id, price, quantity FROM pit
"""))
def variant_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 from VARIANT payloads."""
    buys = P.raw_events(spark, sf_dir).where(F.col("is_valid") & F.col("event_type").isin(*S.PURCHASE_TYPES))
    return variants.items(buys).where("purchase_item_id is not null")


@register("payload_drift", O.q("""
SELECT event_type, 'promo' AS path, COUNT(*) AS events FROM rawv
WHERE offset_id % 17 = 2 AND offset_id % 29 <> 4 GROUP BY 1
"""))
def payload_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload paths that no table has a column for."""
    return variants.drift(_drifted(spark, sf_dir)).select("event_type", "path", "events")


# ---- distinct counts kept by sketches ----

@register("daily_summary_sketched", O.q(f"""
SELECT CAST(timestamp AS DATE) AS event_date, event_type, COUNT(*) AS event_count,
       TRUE AS as_one_load, TRUE AS customers_within_error, TRUE AS sessions_within_error
FROM rawv WHERE is_valid AND event_type IN {O._in(S.PROCESSED_TYPES)} GROUP BY 1, 2
"""))
def daily_summary_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1/V1 kept over three loads that share days (one of them loaded twice),
    against one load and against the exact counts: within five standard errors
    or one."""
    raw = P.landed_raw_events(spark, sf_dir)
    path = _folder(spark, "sketches")
    early = F.col("timestamp") < F.lit(MERGE_CUTOFF).cast("timestamp_ntz")
    part = F.when(early, 0).otherwise(1 + F.col("offset_id") % 2)
    for load in (0, 1, 2, 1):
        sketches.add_load(spark, path, str(load), raw.where(F.coalesce(part, F.lit(0)) == load))
    kept = sketches.read(spark, path).alias("k")
    once = sketches.estimates(sketches.day_sketches(raw)).withColumnsRenamed({"unique_customers": "c1", "unique_sessions": "s1"})
    from shoptrail.operators.views import daily_event_summary_of
    exact = daily_event_summary_of(raw).select("event_date", "event_type", F.col("unique_customers").alias("c"), F.col("unique_sessions").alias("s"))
    both = kept.join(once.drop("event_count"), ["event_date", "event_type"]).join(exact, ["event_date", "event_type"])

    def near(estimate: str, true: str):
        return F.abs(F.col(estimate) - F.col(true)) <= F.greatest(F.lit(1.0), 5 * sketches.STANDARD_ERROR * F.col(true))
    return both.select("event_date", "event_type", "event_count",
                       ((F.col("unique_customers") == F.col("c1")) & (F.col("unique_sessions") == F.col("s1"))).alias("as_one_load"),
                       near("unique_customers", "c").alias("customers_within_error"), near("unique_sessions", "s").alias("sessions_within_error"))


# ---- tables laid out by key ----

from shoptrail.operators import dedup  # noqa: E402
from shoptrail.plans.catalog import ORACLES  # noqa: E402
from shoptrail.sinks import keyed  # noqa: E402


def _bucketed(spark: SparkSession, rows: DataFrame) -> str:
    name = f"bucketed_{uuid.uuid4().hex}"
    keyed.write_bucketed(rows, name, _folder(spark, name))
    return name


@register("bucketed_merge", ORACLES["upsert_raw_events"])
def bucketed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 into a bucketed table: the same answer as ``upsert_raw_events``."""
    raw = P.landed_raw_events(spark, sf_dir)
    target = raw.where(F.col("timestamp") < F.lit(MERGE_CUTOFF).cast("timestamp_ntz")).withColumns(
        {"etl_run_id": F.lit("run_1"), "source_file": F.lit("previous_load"), "etl_timestamp": F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")})
    batch = dedup.keep_first(raw).withColumns({"etl_run_id": F.lit("run_2"), "etl_timestamp": F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")})
    merged = keyed.merge_bucketed(_bucketed(spark, target), batch)
    return merged.select("event_id", "etl_run_id", "source_file", "etl_timestamp", "event_type", "is_valid")


@register("bucketed_anti_join", ORACLES["incremental_anti_join"])
def bucketed_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 against a bucketed table."""
    pv = P.processed(spark, sf_dir)["page_views"].select("event_id", "timestamp")
    target = pv.where(F.col("timestamp") < F.lit(MERGE_CUTOFF).cast("timestamp_ntz"))
    return keyed.unseen_in_bucketed(dedup.keep_first(pv), _bucketed(spark, target))


@register("customer_look_up", O.q("""
SELECT event_id, customer_id, event_type FROM rawv WHERE customer_id = 'CUST_1'
"""))
def customer_look_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 from files clustered by customer."""
    path = _folder(spark, "clustered")
    keyed.write_clustered(P.raw_events(spark, sf_dir).select("event_id", "customer_id", "event_type"), path, "customer_id")
    return keyed.look_up(spark, path, "customer_id", "CUST_1")


@register("event_look_up", O.q("""
SELECT event_id, customer_id, event_type FROM rawv WHERE event_id = 'EVT_77'
"""))
def event_look_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event from files clustered by customer, by Bloom filter."""
    path = _folder(spark, "bloom")
    keyed.write_clustered(P.raw_events(spark, sf_dir).select("event_id", "customer_id", "event_type"), path, "customer_id", bloom="event_id")
    return keyed.look_up(spark, path, "event_id", "EVT_77")


# ---- the library from SQL ----

from shoptrail.plans import sql_api  # noqa: E402
from shoptrail.plans.catalog import WV  # noqa: E402
from shoptrail.sources.fixtures import FIXTURE_NOW  # noqa: E402


@register("sql_functions", O.q(f"""
SELECT event_id, {O.CATEGORY_SQL} AS event_category, CAST({O.SCORE_SQL} AS INTEGER) AS business_value_score,
       {O.GROUP_SQL} AS counter_group, {WV} AS is_valid_event, array_to_string(issues, ',') AS issues FROM raw
"""))
def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, E1, E2, E12, Q5 called from SQL."""
    sql_api.create_functions(spark)
    price = F.from_json("event_data", "product_price decimal(10,2)")["product_price"]
    wire = P.wire_events(spark, sf_dir).withColumns({"price": price, "at": F.col("event_timestamp").cast("timestamp_ntz")})
    view = f"wire_{uuid.uuid4().hex}"
    wire.createOrReplaceTempView(view)
    clock = f"TIMESTAMP_NTZ '{FIXTURE_NOW}'"
    return spark.sql(f"""
        SELECT event_id, event_category(event_type) AS event_category, business_value_score(event_type) AS business_value_score,
               counter_group(event_type) AS counter_group,
               is_valid_event(customer_id, event_type, amount, currency, at, is_valid, {clock}) AS is_valid_event,
               array_join(issue_tags(customer_id, session_id, at, amount, price, {clock}), ',') AS issues
        FROM {view}""")


def _landed_view(spark: SparkSession, sf_dir: str) -> str:
    view = f"raw_events_{uuid.uuid4().hex}"
    P.landed_raw_events(spark, sf_dir).createOrReplaceTempView(view)
    return view


@register("sql_process_raw_events", O.q("""
SELECT 'page_views' AS table_name, event_id, page_url AS detail FROM pv
UNION ALL SELECT 'product_interactions', event_id, product_id FROM pi
UNION ALL SELECT 'purchases', event_id, order_id FROM pu
"""))
def sql_process_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2 by the SQL script: once with the earlier events, then with all."""
    raw = P.landed_raw_events(spark, sf_dir)
    names = [f"raw_{uuid.uuid4().hex}" for _ in range(2)]
    raw.where(F.col("timestamp") < F.lit(MERGE_CUTOFF).cast("timestamp_ntz")).createOrReplaceTempView(names[0])
    raw.createOrReplaceTempView(names[1])
    targets = sql_api.create_targets(spark, _folder(spark, "sql"), f"t_{uuid.uuid4().hex}")
    for name in names:
        spark.sql(sql_api.process_raw_events(name, targets)).first()
    detail = {"page_views": "page_url", "product_interactions": "product_id", "purchases": "order_id"}
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{n}' AS table_name, event_id, {c} AS detail FROM {targets[n]}" for n, c in detail.items()))


@register("sql_daily_event_summary", ORACLES["daily_event_summary"])
def sql_daily_event_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 by name from SQL, over the processed tables."""
    raw = P.landed_raw_events(spark, sf_dir)
    tables = {}
    for name, rows in (P.processed(spark, sf_dir, raw) | {"raw_events": raw, "sessions": _sessions(raw)}).items():
        tables[name] = f"{name}_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(tables[name])
    sql_api.create_views(spark, tables, FIXTURE_NOW)
    return spark.sql("SELECT * FROM daily_event_summary")


def _sessions(raw: DataFrame) -> DataFrame:
    return raw.where("session_id is not null").groupBy("session_id").agg(F.min("customer_id").alias("customer_id"), F.min("timestamp").alias("start_time"))
