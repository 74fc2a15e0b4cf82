"""Loads of files into tables that may be repeated.

A loaded file's rows lie in a folder of their own in the table, so loading the
file again replaces them; the manifest names the files that need not be read
again. A micro-batch's rows lie in the folder of its batch id in either store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.operators.land import store_of
from shoptrail.operators.validate import flatten
from shoptrail.sources import files

FILE_KEY = "file_key"


def two_store_batches(parquet_path: str, store_path: str, ingestion_time=None):
    """K3: ``foreachBatch`` function that sends each event to exactly one of
    two stores (``store_of``), stamped with ``storage_type`` and
    ``ingestion_time``; payload structs are flattened in the Parquet store. A
    batch that comes again replaces itself in both."""
    def write(batch: DataFrame, batch_id: int) -> None:
        ts = F.current_timestamp().cast("timestamp_ntz") if ingestion_time is None else F.lit(str(ingestion_time)).cast("timestamp_ntz")
        rows = batch.withColumn("storage_type", store_of("event_id")).withColumn("ingestion_time", ts).persist()
        try:
            flatten(rows.where("storage_type = 'parquet'")).write.mode("overwrite").parquet(f"{parquet_path}/batch_id={batch_id}")
            rows.where("storage_type is distinct from 'parquet'").write.mode("overwrite").parquet(f"{store_path}/batch_id={batch_id}")
        finally:
            rows.unpersist()
    return write


def _put_files(rows: DataFrame, table: str) -> None:
    """Rows with ``file`` (their file's path) into the table, in place of those
    of the same files."""
    keyed = rows.withColumn(FILE_KEY, F.md5("file"))
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(FILE_KEY).parquet(table)


def _mark(spark: SparkSession, paths: list[str], manifest: str) -> None:
    spark.createDataFrame([(p,) for p in paths], "path string").write.mode("append").parquet(manifest)


def bulk_append(spark: SparkSession, path: str, table: str, manifest: str, loaded_at=None) -> DataFrame | None:
    """K6: appends the Parquet files under ``path`` that ``manifest`` does not
    name to ``table``. The report has a row for every file asked for: file,
    rows_loaded, success, error and timestamp. A file that gives no row is an
    error, is not named as loaded, and is tried again by the next load. None
    if there is no new file."""
    paths = files.new_files(spark, path, manifest)
    if not paths:
        return None
    reader = spark.read.option("mergeSchema", "false").option("ignoreCorruptFiles", "true")
    schema = _schema_of(spark, paths)
    ts = F.current_timestamp().cast("timestamp_ntz") if loaded_at is None else F.lit(str(loaded_at)).cast("timestamp_ntz")
    asked = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file"), "path")
    found = asked.select("file", "path", F.lit(0).cast("long").alias("rows_loaded"))
    if schema is not None:
        rows = reader.schema(schema).parquet(*paths)
        _put_files(rows.select("*", F.col("_metadata.file_path").alias("file")), table)
        # the table may hold more files than these: only the folders of those asked for are read
        keys = asked.select(F.md5("file").alias(FILE_KEY))
        kept = spark.read.parquet(table).join(keys, FILE_KEY, "left_semi").groupBy("file").agg(F.count(F.lit(1)).alias("n"))
        found = asked.join(kept, "file", "left").select("file", "path", F.coalesce("n", F.lit(0)).alias("rows_loaded"))
    good = [r[0] for r in found.where("rows_loaded > 0").select("path").collect()]  # file names, as in the listing
    if good:
        _mark(spark, good, manifest)
    success = F.col("rows_loaded") > 0
    return found.select("file", "rows_loaded", success.alias("success"),
                        F.when(~success, F.lit("no row could be read")).alias("error"), ts.alias("timestamp"))


def _schema_of(spark: SparkSession, paths: list[str]):
    """The merged schema of the files that have one; None if none does."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", "true").parquet(*paths).schema
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def copy_json_files(spark: SparkSession, path: str, table: str, manifest: str, suffix: str = ".json") -> int:
    """Copies the JSON arrays under ``path`` that ``manifest`` does not
    name into ``table``, one row an element: its envelope and the whole element
    as ``event_data``, with its nulls. Returns the number of files copied."""
    paths = files.new_files(spark, path, manifest, suffix)
    if paths:
        _put_files(files.read_json_arrays(spark, paths), table)
        _mark(spark, paths, manifest)
    return len(paths)
