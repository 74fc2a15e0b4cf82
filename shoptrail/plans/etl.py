"""Batch ETL run (U4) and its statistics.

``run_etl`` wires extract -> union -> de-duplicate -> quality -> metadata ->
merge -> route -> write; every step is a DataFrame transform, and the only
actions are the writes (and the optional statistics row).
"""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.functions.events import as_of_ts, pct
from shoptrail.operators import dedup, route
from shoptrail.operators.enrich import etl_metadata


def etl_statistics(extracted: DataFrame, as_of=None) -> DataFrame:
    """One row -- extracted per source, total, duplicates removed,
    required-field and future-time issues after de-duplication, rows loaded."""
    a = extracted.agg(
        F.count_if(F.col("source_rank") == 0).alias("extracted_files"),
        F.count_if(F.col("source_rank") == 1).alias("extracted_store"),
        F.count(F.lit(1)).alias("total_extracted"))
    d = dedup.keep_first(extracted).agg(
        F.count(F.lit(1)).alias("loaded"),
        (F.count_if(F.col("event_id").isNull()) + F.count_if(F.col("event_type").isNull())
         + F.count_if(F.col("timestamp").isNull())
         + F.count_if(F.col("timestamp") > as_of_ts(as_of))).alias("quality_issues"))
    j = dedup.side_by_side([a, d])
    return j.select("extracted_files", "extracted_store", "total_extracted",
                    (F.col("total_extracted") - F.col("loaded")).alias("duplicates_removed"),
                    "quality_issues", "loaded")


def load_statistics(raw: DataFrame, day) -> DataFrame:
    """today's counts per table and today's quality, as one row. A row
    counts for a table by its type, validity and event day, and as raw by its
    ingestion day, so one scan of RAW_EVENTS holds all of it."""
    start = F.lit(str(day)).cast("date").cast("timestamp_ntz")

    def today(col: str):
        return (F.col(col) >= start) & (F.col(col) < start + F.expr("INTERVAL 1 DAY"))
    good = F.col("is_valid") == F.lit(True)
    tables = {"page_views": S.PAGE_VIEW_TYPES, "product_interactions": S.PRODUCT_INTERACTION_TYPES,
              "purchases": S.PURCHASE_TYPES, "searches": S.SEARCH_TYPES}
    out = raw.where(today("ingestion_time") | today("timestamp")).agg(
        F.count_if(today("ingestion_time")).alias("raw_events_today"),
        F.count_if(today("ingestion_time") & good).alias("valid_today"),
        *[F.count_if(today("timestamp") & good & F.col("event_type").isin(*types)).alias(f"{name}_today")
          for name, types in tables.items()])
    return out.select("raw_events_today", "page_views_today", "product_interactions_today",
                      "purchases_today", "searches_today", "valid_today",
                      pct("valid_today", "raw_events_today").alias("quality_score_pct"))


PROCESSED = ("page_views", "product_interactions", "purchases", "searches", "user_engagement", "purchase_items")
STEPS = ("stage", "rejects", "merge", *PROCESSED, "statistics", "manifest")


def run_etl(spark: SparkSession, file_dir: str, store: DataFrame | None, target_dir: str,
            processed_dir: str, run_at: datetime | None = None, buckets: int = 256,
            products: DataFrame | None = None, manifest: str | None = None, ledger: str | None = None,
            statistics: str | None = None, after_step=None) -> dict[str, str]:
    """U4: one batch run. Reads landed Parquet files (and the local store
    table when given), de-duplicates (files first, newest store rows next),
    stamps run metadata, merges into RAW_EVENTS at ``target_dir`` rewriting
    only the key buckets the batch touches (``merge_into_buckets``; staging
    in the shared checkpoint folder), then routes this run's rows only and
    appends the unseen ones to every processed table. Returns the written paths.

    With ``manifest`` (a table of loaded file paths) files that it names are
    not read again; this run's files are added once all tables are written. A
    file that cannot be read to its end fails the run, with its name, before any
    table is written: it is not named as loaded, and is read once it is whole or
    gone. Page views keep the payload's session fields: read them through
    ``route.with_session_fields``.

    Every step can be repeated: rejects replace those of the same run, the
    merge and the appends go by key. With ``ledger`` (a folder) a run is noted
    as staged, with its batch, and as committed after its last step; the next
    run first ends one that broke off, from the staged batch and under its run
    time, whatever has become of the files. Without one, a broken run is
    repeated whole from its files; its rejects are kept by run id.

    ``statistics`` is a table that gets one row a run (U5): the counts are
    observed while the batch is staged, not read again. ``after_step`` is called
    with the name of each step done (``STEPS``)."""
    import uuid

    from shoptrail.session import scratch_path, table_exists
    from shoptrail.sources.files import new_files, read_landed
    written = {"raw_events": target_dir, "rejected": f"{processed_dir}/rejected"} | {
        name: f"{processed_dir}/{name}" for name in _builders(None)}
    done = after_step or (lambda step: None)
    for open_run in _open_runs(spark, ledger):
        _apply(spark, open_run, written, buckets, products, manifest, ledger, statistics, done)
    run_at = run_at or datetime.now(timezone.utc).replace(tzinfo=None)
    paths = file_dir if manifest is None else new_files(spark, file_dir, manifest)
    frames = []
    if paths:
        frames.append(read_landed(spark, paths, skip_unreadable=False).drop("extraction_time").withColumn("source_rank", F.lit(0)))
    if store is not None:
        frames.append(store.withColumn("source_rank", F.lit(1)).withColumn("source_file", F.lit("duckdb")))
    if not frames:
        return written
    began = time.monotonic()
    run = uuid.uuid4().hex
    folder = f"{ledger.rstrip('/')}/batches" if ledger else scratch_path(spark, "staging")
    landed, rejects = f"{folder}/batch-{run}", f"{folder}/rejects-{run}"  # read by the merge and by every router
    seen, kept = Observation(f"extracted-{run}"), Observation(f"loaded-{run}")
    union = dedup.union_by_name(frames).observe(
        seen, F.count_if(F.col("source_rank") == 0).alias("extracted_files"), F.count_if(F.col("source_rank") == 1).alias("extracted_store"),
        F.count_if(F.col("event_id").isNull()).alias("rejected"))
    batch = etl_metadata(dedup.keep_first(union.filter(F.col("event_id").isNotNull())).drop("source_rank"), run_at)
    batch = batch.withColumn("is_valid", F.coalesce(F.col("is_valid"), F.lit(True)))
    issues = [F.col("event_type").isNull(), F.col("timestamp").isNull(), F.col("timestamp") > F.lit(run_at)]
    batch = batch.observe(kept, F.count(F.lit(1)).alias("loaded"), *[F.count_if(c).alias(f"issue_{i}") for i, c in enumerate(issues)])
    batch.write.parquet(landed)
    etl_metadata(dedup.null_key_rows(dedup.union_by_name(frames)).drop("source_rank"), run_at).write.parquet(rejects)
    counts = seen.get | kept.get
    total = counts["extracted_files"] + counts["extracted_store"]
    row = {"run": run, "run_at": run_at, "landed": landed, "rejects": rejects, "files": [] if isinstance(paths, str) else list(paths),
           "extracted_files": counts["extracted_files"], "extracted_store": counts["extracted_store"], "total_extracted": total,
           "rejected": counts["rejected"], "duplicates_removed": total - counts["rejected"] - counts["loaded"],
           "quality_issues": sum(counts[f"issue_{i}"] for i in range(len(issues))), "loaded": counts["loaded"],
           "seconds": time.monotonic() - began}
    if ledger:
        _note(spark, ledger, "staged", row)
    done("stage")
    _apply(spark, row, written, buckets, products, manifest, ledger, statistics, done)
    return written


LEDGER = ("run string, run_at timestamp_ntz, landed string, rejects string, files array<string>, extracted_files long, extracted_store long, "
          "total_extracted long, rejected long, duplicates_removed long, quality_issues long, loaded long, seconds double")
STATISTICS = ["run_at", "extracted_files", "extracted_store", "total_extracted", "rejected", "duplicates_removed", "quality_issues", "loaded",
              "seconds"]


def _builders(products: DataFrame | None) -> dict:
    return {"page_views": lambda raw: route.page_views(raw, derive_session_fields=False),
            "product_interactions": route.product_interactions,
            "purchases": route.purchases, "searches": route.searches,
            "user_engagement": route.user_engagement,
            "purchase_items": lambda raw: route.purchase_items(route.purchases(raw), products)}


def _note(spark: SparkSession, ledger: str, state: str, row: dict) -> None:
    """A run's entry in a state; writing it again replaces it."""
    fields = [f.split()[0] for f in LEDGER.split(", ")]
    one = spark.createDataFrame([tuple(row[f] for f in fields)], LEDGER)
    one.write.mode("overwrite").parquet(f"{ledger}/{state}/run_id={row['run']}")


def _open_runs(spark: SparkSession, ledger: str | None) -> list[dict]:
    """Runs that are staged and not committed, oldest first."""
    from shoptrail.session import table_exists
    if not ledger or not table_exists(spark, f"{ledger}/staged"):
        return []
    found = spark.read.schema(LEDGER).parquet(f"{ledger}/staged")
    if table_exists(spark, f"{ledger}/committed"):
        found = found.join(spark.read.schema(LEDGER).parquet(f"{ledger}/committed").select("run"), "run", "left_anti")
    return [r.asDict() for r in found.orderBy("run_at", "run").collect()]  # as many as broke off, at most one


def _apply(spark: SparkSession, row: dict, written: dict[str, str], buckets: int, products: DataFrame | None, manifest: str | None,
           ledger: str | None, statistics: str | None, done) -> None:
    """All steps after staging; each may be repeated."""
    from shoptrail.session import scratch_path
    began = time.monotonic()
    run_id = f"{row['run_at']:%Y%m%d_%H%M%S}"
    batch = spark.read.parquet(row["landed"])
    spark.read.parquet(row["rejects"]).write.mode("overwrite").parquet(f"{written['rejected']}/etl_run={run_id}")
    done("rejects")
    dedup.merge_into_buckets(spark, written["raw_events"], batch, scratch_path(spark, f"staging/raw_events-{row['run']}"), buckets=buckets)
    done("merge")
    _append_routed(spark, batch, written, products, done)
    if statistics:
        seconds = row["seconds"] + time.monotonic() - began
        types = dict(f.split() for f in LEDGER.split(", "))
        one = spark.createDataFrame([tuple({**row, "seconds": seconds}[c] for c in STATISTICS)], ", ".join(f"{c} {types[c]}" for c in STATISTICS))
        one.write.mode("overwrite").parquet(f"{statistics}/etl_run={run_id}")
    done("statistics")
    if manifest is not None and row["files"]:
        spark.createDataFrame([(p,) for p in row["files"]], "path string").write.mode("append").parquet(manifest)
    done("manifest")
    if ledger:
        _note(spark, ledger, "committed", row)


def _append_routed(spark: SparkSession, batch: DataFrame, written: dict[str, str], products: DataFrame | None, done) -> None:
    """The batch's rows that a processed table does not hold yet."""
    from shoptrail.session import table_exists
    for name, build in _builders(products).items():
        rows = build(batch)
        if table_exists(spark, written[name]):
            rows = dedup.unseen(rows, spark.read.parquet(written[name]), "purchase_item_id" if name == "purchase_items" else "event_id")
        rows.write.mode("append").parquet(written[name])
        done(name)


def start_scheduled_load(spark: SparkSession, raw_dir: str, processed_dir: str, checkpoint: str, products: DataFrame | None = None,
                         every: str = "5 minutes", available_now: bool = False, max_files: int | None = None):
    """The incremental load (U2) on a cadence, as a streaming query over the
    files that come to RAW_EVENTS: each trigger takes the new files, routes their
    valid rows and appends those that the processed tables do not hold. The
    checkpoint remembers the files; a trigger that broke off is repeated, and
    what it had appended is not appended again. ``available_now`` loads what
    is there and stops, for an outer scheduler."""
    written = {name: f"{processed_dir}/{name}" for name in _builders(None)}
    files = spark.readStream.schema(spark.read.parquet(raw_dir).schema)
    if max_files:
        files = files.option("maxFilesPerTrigger", max_files)

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = dedup.keep_first(batch.where("event_id is not null")).persist()
        try:
            _append_routed(rows.sparkSession, rows, written, products, lambda step: None)
        finally:
            rows.unpersist()
    query = files.parquet(raw_dir).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (query.trigger(availableNow=True) if available_now else query.trigger(processingTime=every)).start()


def last_run(spark: SparkSession, statistics: str) -> DataFrame:
    """The newest run's statistics, one row."""
    return spark.read.parquet(statistics).orderBy(F.desc("run_at")).limit(1).withColumnRenamed("run_at", "last_run")


def warehouse_summary(raw: DataFrame, sessions: DataFrame, customers: DataFrame, day) -> DataFrame:
    """Rows of RAW_EVENTS and of the seven processed tables, and the day's
    quality, as (section, name, value): the raw and routed tables and the
    quality in one scan of RAW_EVENTS, sessions and customers by their counts."""
    from shoptrail.operators.metrics import processed_counts
    counts = processed_counts(raw).where("table_name <> 'purchase_items'")
    extra = [t.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, t in (("sessions", sessions), ("customers", customers))]
    tables = dedup.union_by_name([counts, *extra]).select(F.lit("tables").alias("section"), F.col("table_name").alias("name"),
                                                          F.col("row_count").cast("double").alias("value"))
    start = F.lit(str(day)).cast("date").cast("timestamp_ntz")
    today = raw.where((F.col("timestamp") >= start) & (F.col("timestamp") < start + F.expr("INTERVAL 1 DAY")))
    good = F.count_if(F.col("is_valid") == F.lit(True))
    one = today.agg(F.count(F.lit(1)).alias("total_events"), good.alias("valid_events")).withColumn(
        "invalid_events", F.col("total_events") - F.col("valid_events")).withColumn("quality_score_pct", pct("valid_events", "total_events"))
    quality = one.select(*[F.col(c).cast("double").alias(c) for c in one.columns]).unpivot([], one.columns, "name", "value")
    return tables.unionByName(quality.select(F.lit("quality").alias("section"), "name", "value"))
