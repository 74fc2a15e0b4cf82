"""Table helpers shared by the operators: staged tables in the shared
checkpoint folder, size-checked broadcasts, blocks of documents and gapless
numbering without a one-task window."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoptrail.session import scratch_path

BROADCAST_ROWS = 500_000  # of at most a few longs each


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under spark.checkpoint.dir and read it
    back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Texts go to Python in Arrow batches of at most ``rows`` rows: a batch
    of whole texts is what bounds a worker's memory. Only ever lowers the
    session's setting."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def narrow(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a staged table of a few longs a row, only if it
    has at most ``rows`` rows; beyond that the join stays a shuffled one."""
    return F.broadcast(df) if df.count() <= rows else df


def text_bytes(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(rows, UTF-8 bytes of all texts)."""
    row = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(text_col)))).first()
    return int(row[0]), int(row[1] or 0)


def blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """(doc_id, text, block) and the number of blocks.

    A block holds about ``block_bytes`` of whole texts (one longer text is a
    block's own size), so the number of blocks follows the input. Rows are
    hashed on the id, those without one on their text. Grouping by block is
    left to the callers: equal groupings share one exchange in a plan."""
    _, size = text_bytes(docs, text_col)
    n = max(1, -(-size // block_bytes))
    key = F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col)))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias("block"))
    return base, n


def number_rows(df: DataFrame, group: str, key: Column, order: list[str], out: str, weight: str | None = None) -> DataFrame:
    """Numbers the rows of each ``group`` from 0 without gaps, in the order of
    md5(``key``), ties by the ``order`` columns; with ``weight`` the sum of
    that column over the rows before instead.

    A group is cut by the first byte of that md5, so no task holds a whole
    group: rows are numbered inside (group, cut) and shifted by the totals of
    the cuts before, a table of at most groups x 256 rows. Rows that agree in
    everything are numbered one after the other."""
    value = F.col(weight) if weight else F.lit(1).cast("long")
    keyed = df.withColumn("_md", F.md5(key)).withColumn("_cut", F.substring("_md", 1, 2)).withColumn("_w", value)
    totals = keyed.groupBy(F.col(group).alias("_g"), F.col("_cut").alias("_c")).agg(F.sum("_w").alias("_t"))
    upto = Window.partitionBy("_g").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select("_g", "_c", F.coalesce(F.sum("_t").over(upto), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, "_cut").orderBy("_md", *order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = keyed.withColumn("_in", F.coalesce(F.sum("_w").over(inside), F.lit(0)))
    return (numbered.join(shift, numbered[group].eqNullSafe(shift["_g"]) & (numbered["_cut"] == shift["_c"]))
            .withColumn(out, F.col("_before") + F.col("_in"))
            .drop("_md", "_cut", "_w", "_g", "_c", "_before", "_in"))


def crc_mod(id_col: Column, m: int) -> Column:
    """crc32 of the id written as text, modulo m."""
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(m))


WORD = r"[^\x20\x09-\x0D]+"


def count_words(text: Column) -> Column:
    """Words of a text as a long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
