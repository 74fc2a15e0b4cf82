"""Batch file sources."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptrail.session import table_exists


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, modification time and length of every file under ``path``
    (file metadata only; the content column is pruned)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", "modificationTime", "length"))


def new_files(spark: SparkSession, path: str, manifest: str, suffix: str = ".parquet") -> list[str]:
    """The files under ``path`` with this ending that ``manifest`` (a Parquet table of
    loaded paths, absent before the first run) does not name. The list is of
    file names, which the driver's file index holds for any scan."""
    found = list_files(spark, path).where(F.col("path").endswith(suffix)).select("path")
    if table_exists(spark, manifest):
        found = found.join(spark.read.parquet(manifest), "path", "left_anti")
    return [r[0] for r in found.orderBy("path").collect()]


def read_landed(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
                skip_unreadable: bool = True) -> DataFrame:
    """Every Parquet file under ``path`` (a folder or a list of files)
    with lineage.

    Schemas of different files are merged by name (missing columns NULL);
    unreadable files are skipped, from the row on where reading fails (without
    ``skip_unreadable`` the read fails and names the file); each row gets
    ``source_file`` (file name, from the scan's hidden metadata) and
    ``extraction_time``."""
    reader = (spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", str(skip_unreadable).lower())
              .option("recursiveFileLookup", "true"))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    cols = [c for c in df.columns if c != "source_file"]
    return df.select(*cols, F.col("_metadata.file_name").alias("source_file"),
                     F.current_timestamp().cast("timestamp_ntz").alias("extraction_time"))


def read_recent(spark: SparkSession, path: str, days_back: int = 7,
                now: datetime | None = None) -> DataFrame:
    """Files modified within the last ``days_back`` days (file pruning by
    modification time happens in the file index, before any read)."""
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    since = (now - timedelta(days=days_back)).strftime("%Y-%m-%dT%H:%M:%S")
    df = (spark.read.option("mergeSchema", "true").option("modifiedAfter", since)
          .option("recursiveFileLookup", "true").parquet(path))
    return df.withColumn("source_file", F.col("_metadata.file_name"))


def read_store_table(spark: SparkSession, table: str) -> DataFrame:
    """The local store's events as an extract, tagged ``duckdb``.

    The reference orders by ingestion time DESC; here that order is the
    de-duplication rank (``keep_first``), not a global sort."""
    cols = ["event_id", "event_type", "session_id", "customer_id", "timestamp", "event_data",
            "data_quality_issues", "is_valid", "ingestion_time", "storage_type"]
    return spark.table(table).select(*cols).withColumn("source_file", F.lit("duckdb"))


def read_json_arrays(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files that each hold a JSON array of events; one row per element.

    Each event is kept whole as ``event_data`` (JSON text) next to its
    envelope fields, ``source_file`` names the file and ``file`` is its path."""
    text = spark.read.text(path, wholetext=True).select(
        F.col("value"), F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("file"))
    events = text.select(F.explode(F.from_json("value", "array<string>")).alias("event_data"), "source_file", "file")
    env = F.from_json("event_data", "event_id string, event_type string, session_id string, "
                                    "customer_id string, timestamp string, is_valid boolean")
    return events.select(env.alias("e"), "event_data", "source_file", "file").select("e.*", "event_data", "source_file", "file")


def json_array_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder that hold no JSON array, with their text;
    ``read_json_arrays`` has no rows for them."""
    text = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("source_file"), "value")
    return text.where(F.from_json("value", "array<string>").isNull())


def read_newest_files(spark: SparkSession, path: str, files: int = 5, limit: int = 100) -> DataFrame:
    """Rows of the newest ``files`` files (that hold rows) by modification
    time, newest first, at most ``limit`` rows. Files are ranked from the listing
    alone; then they are opened, newest first, until ``files`` hold a row."""
    reader = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
    ranked = (list_files(spark, path).where(F.col("path").endswith(".parquet"))
              .orderBy(F.col("modificationTime").desc(), "path").select("path"))
    newest, tried, ask = [], 0, files
    while len(newest) < files:
        found = [r.path for r in ranked.limit(ask).collect()]
        newest += [p for p in found[tried:] if reader.parquet(p).limit(1).count()][:files - len(newest)]
        if len(found) < ask:
            break
        tried, ask = ask, 2 * ask
    if not newest:
        return reader.parquet(path).limit(0)
    d = reader.parquet(*newest)
    order = [F.col(c).desc_nulls_last() for c in ("ingestion_time", "timestamp") if c in d.columns]
    order += [F.col(c) for c in ("event_id",) if c in d.columns]
    return d.orderBy(*order).limit(limit)


def read_file_for_table(spark: SparkSession, path: str) -> DataFrame:
    """One file plus the table each row routes to (R6, per row)."""
    from shoptrail.operators.route import target_table
    df = spark.read.parquet(path)
    return df.withColumn("target_table", target_table())
