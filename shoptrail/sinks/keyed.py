"""Tables laid out by key: bucketed and sorted ones that MERGE and the anti
join read without a shuffle (U1, J3), and files clustered by key with Parquet
Bloom filters, so that a look-up skips what cannot hold it (U2, F6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.operators.dedup import merge_by_key, unseen


def write_bucketed(df: DataFrame, table: str, path: str, key: str = "event_id", buckets: int = 64) -> DataFrame:
    """``df`` as the catalog table ``table`` at ``path``, hashed on ``key`` into
    ``buckets`` and sorted by it inside each; one file a bucket and task."""
    (df.repartition(buckets, F.col(key)).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return df.sparkSession.table(table)


def bucket_count(spark: SparkSession, table: str) -> int:
    found = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").select("col_name", "data_type").collect()}
    return int(found["Num Buckets"])


def _alike(source: DataFrame, table: str, key: str) -> DataFrame:
    """The source dealt like the table: the only exchange of the joins below,
    whatever spark.sql.shuffle.partitions is."""
    return source.repartition(bucket_count(source.sparkSession, table), F.col(key))


def merge_bucketed(table: str, source: DataFrame, key: str = "event_id", update_cols: list[str] | None = None) -> DataFrame:
    """MERGE of the source into a bucketed table; the table's rows stay
    where they are. Source must be unique by key."""
    return merge_by_key(source.sparkSession.table(table), _alike(source, table, key), key, update_cols)


def unseen_in_bucketed(source: DataFrame, table: str, key: str = "event_id") -> DataFrame:
    """The source rows whose key the bucketed table does not hold."""
    return unseen(_alike(source, table, key), source.sparkSession.table(table), key)


def write_clustered(df: DataFrame, path: str, key: str, bloom: str | None = None, files: int = 8, distinct: int = 100_000,
                    group_rows: int = 20_000) -> None:
    """Files that each hold a range of ``key``, sorted, in row groups of about
    ``group_rows`` rows, with a Bloom filter on ``bloom`` (default: the key)
    for ``distinct`` values a row group. Range statistics prune look-ups by the
    key; the filter prunes those by a column the files are not sorted by."""
    column = bloom or key
    (df.repartitionByRange(files, F.col(key)).sortWithinPartitions(key).write.mode("overwrite")
     .option("parquet.bloom.filter.enabled#" + column, "true")
     .option("parquet.bloom.filter.expected.ndv#" + column, str(distinct))
     .option("parquet.block.row.count.limit", str(group_rows)).parquet(path))


def look_up(spark: SparkSession, path: str, column: str, value: str) -> DataFrame:
    """The rows with ``column = value``; the filter reaches the Parquet reader,
    which drops row groups by range and by Bloom filter."""
    return spark.read.parquet(path).where(F.col(column) == F.lit(value))
