"""De-duplication, merge and incremental load.

Duplicates are removed with ``row_number() = 1`` per key. Spark's optimizer
turns that filter into a partial ``WindowGroupLimit`` that keeps one row per
key in every map task *before* the shuffle, so an event id with millions of
copies sends at most one row per task to the exchange instead of one task
holding all of them (measured in ``tools_skew_check.py``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.session import table_exists

# Columns MERGE updates on a match; the target keeps the rest.
MERGE_UPDATE_COLS = ["event_type", "session_id", "customer_id", "timestamp", "event_data",
                     "data_quality_issues", "is_valid", "etl_timestamp"]


def _first_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_dd_rn", F.row_number().over(w)).filter(F.col("_dd_rn") == 1).drop("_dd_rn")


def keep_first(df: DataFrame, key: str = "event_id", order: list[Column] | None = None) -> DataFrame:
    """A2: one row per key (NULL keys form one group), the smallest ``order``.

    Default order: ``source_rank`` (files before the local store), then newest
    ``ingestion_time`` (NULLs last), then ``source_file``, ``offset_id``.
    """
    cols = set(df.columns)
    if order is None:
        order = [F.coalesce(F.col("source_rank"), F.lit(0)).asc() if "source_rank" in cols else F.lit(0).asc(),
                 F.col("ingestion_time").desc_nulls_last() if "ingestion_time" in cols else F.lit(0).asc(),
                 F.col("source_file").asc_nulls_last() if "source_file" in cols else F.lit("").asc(),
                 F.col("offset_id").asc_nulls_last() if "offset_id" in cols else F.lit(0).asc()]
    return _first_per_key(df, key, order)


def last_write_wins(df: DataFrame, key: str = "event_id", ts: str = "ingestion_time",
                    tie: str = "offset_id") -> DataFrame:
    """A3: the latest arrival per key (INSERT OR REPLACE)."""
    return _first_per_key(df, key, [F.col(ts).desc_nulls_last(), F.col(tie).desc_nulls_last()])


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """O3: union with columns matched by name; missing columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def side_by_side(frames: list[DataFrame]) -> DataFrame:
    """Combine one-row aggregates into one row without a join: union them by
    name (each frame fills only its own columns) and take ``max`` per column,
    which picks the single non-NULL value."""
    u = union_by_name(frames)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])


def merge_by_key(target: DataFrame, source: DataFrame, key: str = "event_id",
                 update_cols: list[str] | None = None) -> DataFrame:
    """MERGE source into target on ``key``; returns the new table.

    * matched: the ``update_cols`` that the source has from source, every
      other column from target (so ``source_file``, ``storage_type``,
      ``etl_run_id`` are kept, and a column the source lacks is not blanked);
    * source only: inserted as is; target only: kept.
    Source rows with a NULL key are dropped here (the key is NOT NULL in the
    table; see ``null_key_rows`` for the reject list). Source must be unique
    per key -- run ``keep_first`` first.
    """
    update_cols = update_cols or MERGE_UPDATE_COLS
    src = source.filter(F.col(key).isNotNull())
    s = src.select(*[F.col(c).alias(f"_s_{c}") for c in src.columns], F.lit(True).alias("_in_s"))
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in target.columns], F.lit(True).alias("_in_t"))
    j = t.join(s, F.col(f"_t_{key}") == F.col(f"_s_{key}"), "full_outer")
    in_s = F.col("_in_s").isNotNull()
    in_t = F.col("_in_t").isNotNull()
    out = []
    for c in target.columns:
        sc = F.col(f"_s_{c}") if c in src.columns else F.lit(None)
        tc = F.col(f"_t_{c}")
        if c == key:
            out.append(F.coalesce(tc, sc).alias(c))
        elif c in update_cols and c in src.columns:
            out.append(F.when(in_s, sc).otherwise(tc).alias(c))
        else:
            out.append(F.when(in_t, tc).otherwise(sc).alias(c))
    return j.select(*out)


def null_key_rows(source: DataFrame, key: str = "event_id") -> DataFrame:
    return source.filter(F.col(key).isNull())


def unseen(source: DataFrame, target: DataFrame, key: str = "event_id") -> DataFrame:
    """Source rows whose key is not yet in target (anti join).

    NULL source keys are removed first: ``NOT IN`` drops them whenever the
    target is non-empty, and the key column is NOT NULL anyway."""
    return (source.filter(F.col(key).isNotNull())
                  .join(target.select(key).filter(F.col(key).isNotNull()), key, "left_anti"))


def incremental_append(source: DataFrame, target: DataFrame, key: str = "event_id") -> DataFrame:
    """U2 core: the rows to append -- de-duplicated within the batch, then unseen."""
    return unseen(keep_first(source, key), target, key)


BUCKET_COL = "key_bucket"


def key_bucket(key: str, buckets: int) -> Column:
    """Stable hash bucket of a key (same key, same bucket, every run)."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def merge_into_buckets(spark, target_path: str, source: DataFrame, staging_path: str,
                       key: str = "event_id", buckets: int = 256,
                       update_cols: list[str] | None = None) -> str:
    """U1 at scale: MERGE a batch into a Parquet table laid out in
    ``key_bucket=<b>`` folders, rewriting only the buckets the batch touches.

    1. the batch's distinct bucket ids (at most ``buckets`` integers: table
       metadata, not data) become a partition filter, so only touched bucket
       folders are listed and read (static partition pruning);
    2. those buckets are merged (``merge_by_key``) and written to
       ``staging_path`` (a shared folder, so the step survives executor loss);
    3. the staged buckets replace their folders in the target with a dynamic
       partition overwrite; untouched buckets are never read or rewritten.
    The first load writes the whole batch. Source must be unique per key.
    Returns ``target_path``."""
    src = source.filter(F.col(key).isNotNull()).withColumn(BUCKET_COL, key_bucket(key, buckets))
    if not table_exists(spark, target_path):  # first load; a failing read of a table that is there must rise
        src.write.mode("errorifexists").partitionBy(BUCKET_COL).parquet(target_path)
        return target_path
    target = spark.read.parquet(target_path)
    touched = [r[0] for r in src.select(BUCKET_COL).distinct().collect()]
    tgt = target.filter(F.col(BUCKET_COL).isin(touched))
    merged = merge_by_key(tgt, src.select(*[c for c in target.columns if c in src.columns]), key, update_cols)
    merged.write.mode("overwrite").partitionBy(BUCKET_COL).parquet(staging_path)
    (spark.read.parquet(staging_path).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET_COL).parquet(target_path))
    return target_path
