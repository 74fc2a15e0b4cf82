"""Enrichment."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.functions.events import (business_value_score, counter_group, event_category,
                                        page_title)
from shoptrail.operators.ordered import previous_value


def enrich_events(df: DataFrame, processed_at=None) -> DataFrame:
    """Category, business value score, processing metadata."""
    ts = (F.current_timestamp().cast("timestamp_ntz") if processed_at is None
          else F.lit(str(processed_at)).cast("timestamp_ntz"))
    return (df.withColumn("processed_timestamp", ts)
              .withColumn("processor_version", F.lit(S.PROCESSOR_VERSION))
              .withColumn("event_category", event_category("event_type"))
              .withColumn("business_value_score", business_value_score("event_type")))


def etl_metadata(df: DataFrame, run_at: datetime | None = None) -> DataFrame:
    """One run id (yyyyMMdd_HHmmss) and timestamp for the whole run."""
    run_at = run_at or datetime.now(timezone.utc).replace(tzinfo=None)
    return (df.withColumn("etl_run_id", F.lit(run_at.strftime("%Y%m%d_%H%M%S")))
              .withColumn("etl_timestamp", F.lit(run_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")))


def with_page_title(df: DataFrame, url: str = "page_url", out: str = "page_title") -> DataFrame:
    """E5: title for a page URL (lookup, else title-cased path)."""
    return df.withColumn(out, page_title(url))


def with_previous_page(df: DataFrame, session: str = "session_id", ts: str = "timestamp",
                       tie: str = "event_id", url: str = "page_url", out: str = "previous_page") -> DataFrame:
    """The page URL seen before this one in the same session.

    Rows without a session get NULL; sessions are split by day so one long
    session cannot pin a single task."""
    key = F.coalesce(F.col(session), F.concat(F.lit("\u0000"), F.col(tie).cast("string")))
    out_df = previous_value(df.withColumn("_sk", key), ["_sk"], ts, tie, url, out)
    return (out_df.withColumn(out, F.when(F.col(session).isNotNull(), F.col(out)))
                  .drop("_sk"))


def with_bounce(df: DataFrame, session: str = "session_id", out: str = "is_bounce") -> DataFrame:
    """A page view is a bounce when its session has exactly one page view.

    Counted by an aggregate (partial counts before the shuffle) joined back,
    not by a window over the session."""
    counts = (df.filter(F.col(session).isNotNull()).groupBy(session)
                .agg(F.count(F.lit(1)).alias("_views")))
    return (df.join(counts, session, "left")
              .withColumn(out, F.when(F.col(session).isNotNull(), F.col("_views") == 1))
              .drop("_views"))


def with_counter_group(df: DataFrame, out: str = "counter_group") -> DataFrame:
    """Live-counter bucket (narrower than the routing sets)."""
    return df.withColumn(out, counter_group("event_type"))
