"""Skew-safe ordered windows per key.

A plain ``Window.partitionBy(key).orderBy(ts)`` puts every row of a key into
one task; if one customer or session holds a third of all rows, that task
holds a third of the data. These helpers split each key into time chunks
(``date_trunc(chunk, ts)``): the row-level window runs per ``(key, chunk)``,
and whatever must cross a chunk boundary (the previous row, a running count)
comes from a small per-``(key, chunk)`` aggregate whose own window holds one
row per chunk. Results are identical to the single-window form.

The per-chunk aggregate reuses the row-level window's hash partitioning on
``(key, chunk)``, and the join back is on the same columns, so the large side
is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CHUNK = "_chunk"


def _with_chunk(df: DataFrame, ts: str, chunk: str, nulls_last: bool = False) -> DataFrame:
    # rows without a time form the first (or last) chunk, where the plain window has them
    edge = F.lit("9999-12-31 23:59:59" if nulls_last else "0001-01-01 00:00:00").cast(df.schema[ts].dataType)
    return df.withColumn(_CHUNK, F.coalesce(F.date_trunc(chunk, F.col(ts)), edge))


def _join_back(df: DataFrame, agg: DataFrame, keys: list[str], extra: list[str]) -> DataFrame:
    # Plain equi-join on the window's own partition columns, so the large side
    # keeps its hash partitioning. Keys must be non-NULL (callers coalesce).
    return df.join(agg.select(*keys, _CHUNK, *extra), on=keys + [_CHUNK], how="left")


def sessionize(df: DataFrame, keys: list[str], ts: str, tie: str, gap: str,
               out: str = "session_no", chunk: str = "day") -> DataFrame:
    """Number inactivity sessions per key: a new session starts when the gap
    to the key's previous event exceeds ``gap`` (an interval string such as
    ``"12 hours"``). ``out`` is 1-based per key, in time order."""
    gap_iv = F.expr(f"INTERVAL {gap}")
    w = Window.partitionBy(*keys, _CHUNK).orderBy(F.col(ts), F.col(tie))
    d = (_with_chunk(df, ts, chunk)
         .withColumn("_o_prev", F.lag(ts).over(w))
         .withColumn("_o_start", (F.col("_o_prev").isNotNull()
                                & ((F.col(ts) - F.col("_o_prev")) > gap_iv)).cast("int"))
         .withColumn("_o_local", F.sum("_o_start").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    per_chunk = d.groupBy(*keys, _CHUNK).agg(
        F.min(ts).alias("_o_cmin"), F.max(ts).alias("_o_cmax"), F.sum("_o_start").alias("_o_cstarts"))
    wk = Window.partitionBy(*keys).orderBy(_CHUNK)
    per_chunk = (per_chunk
                 .withColumn("_o_pmax", F.lag("_o_cmax").over(wk))
                 .withColumn("_o_first", (F.col("_o_pmax").isNull()
                                        | ((F.col("_o_cmin") - F.col("_o_pmax")) > gap_iv)).cast("int"))
                 .withColumn("_o_offset", F.coalesce(
                     F.sum(F.col("_o_first") + F.col("_o_cstarts")).over(
                         wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    joined = _join_back(d, per_chunk, keys, ["_o_first", "_o_offset"])
    return (joined.withColumn(out, (F.col("_o_offset") + F.col("_o_first") + F.col("_o_local")).cast("long"))
            .drop("_o_prev", "_o_start", "_o_local", "_o_first", "_o_offset", _CHUNK))


def previous_value(df: DataFrame, keys: list[str], ts: str, tie: str, value: str,
                   out: str, chunk: str = "day") -> DataFrame:
    """``lag(value)`` per key in (ts, tie) order, without one task per key."""
    order = [F.col(ts), F.col(tie)]
    w = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    d = (_with_chunk(df, ts, chunk)
         .withColumn("_o_rn", F.row_number().over(w))
         .withColumn("_o_lag", F.lag(value).over(w)))
    per_chunk = d.groupBy(*keys, _CHUNK).agg(
        F.max_by(F.col(value), F.struct(*order)).alias("_o_last"))
    wk = Window.partitionBy(*keys).orderBy(_CHUNK)
    per_chunk = per_chunk.withColumn("_o_carry", F.lag("_o_last").over(wk))
    joined = _join_back(d, per_chunk, keys, ["_o_carry"])
    return (joined.withColumn(out, F.when(F.col("_o_rn") == 1, F.col("_o_carry")).otherwise(F.col("_o_lag")))
            .drop("_o_rn", "_o_lag", "_o_carry", _CHUNK))


def sequence_number(df: DataFrame, keys: list[str], ts: str, ties: list[str],
                    out: str, chunk: str = "day") -> DataFrame:
    """``row_number()`` per key ordered by (ts, *ties), NULL times last."""
    order = [F.col(ts).asc_nulls_last()] + [F.col(t).asc_nulls_last() for t in ties]
    w = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    d = _with_chunk(df, ts, chunk, nulls_last=True).withColumn("_o_rn", F.row_number().over(w))
    per_chunk = d.groupBy(*keys, _CHUNK).agg(F.count(F.lit(1)).alias("_o_n"))
    wk = Window.partitionBy(*keys).orderBy(F.col(_CHUNK).asc_nulls_last())
    per_chunk = per_chunk.withColumn(
        "_o_offset", F.coalesce(F.sum("_o_n").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    joined = _join_back(d, per_chunk, keys, ["_o_offset"])
    return (joined.withColumn(out, (F.col("_o_offset") + F.col("_o_rn")).cast("long"))
            .drop("_o_rn", "_o_offset", _CHUNK))


def running_count(df: DataFrame, keys: list[str], ts: str, tie: str, flag: Column | str,
                  out: str, chunk: str = "day") -> DataFrame:
    """Running count of rows where ``flag`` is true, per key, in time order."""
    return running_counts(df, keys, ts, tie, {out: flag}, chunk)


def running_counts(df: DataFrame, keys: list[str], ts: str, tie: str, flags: dict,
                   chunk: str = "day") -> DataFrame:
    """Several running counts (``{out: flag}``) per key in one two-level pass:
    one row-level window, one per-chunk aggregate, one join back."""
    w = Window.partitionBy(*keys, _CHUNK).orderBy(F.col(ts), F.col(tie))
    frame = w.rowsBetween(Window.unboundedPreceding, 0)
    d = _with_chunk(df, ts, chunk)
    names = list(flags)
    for i, name in enumerate(names):
        f = flags[name]
        f = F.col(f) if isinstance(f, str) else f
        d = d.withColumn(f"_o_f{i}", F.coalesce(f.cast("int"), F.lit(0)))
        d = d.withColumn(f"_o_l{i}", F.sum(f"_o_f{i}").over(frame))
    per_chunk = d.groupBy(*keys, _CHUNK).agg(*[F.sum(f"_o_f{i}").alias(f"_o_n{i}") for i in range(len(names))])
    wk = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    for i in range(len(names)):
        per_chunk = per_chunk.withColumn(f"_o_o{i}", F.coalesce(F.sum(f"_o_n{i}").over(wk), F.lit(0)))
    joined = _join_back(d, per_chunk, keys, [f"_o_o{i}" for i in range(len(names))])
    for i, name in enumerate(names):
        joined = joined.withColumn(name, (F.col(f"_o_o{i}") + F.col(f"_o_l{i}")).cast("long"))
    drop = [c for i in range(len(names)) for c in (f"_o_f{i}", f"_o_l{i}", f"_o_o{i}")]
    return joined.drop(*drop, _CHUNK)
