"""Sharding by minimax contiguous partition (operator 10).

Rows with equal texts are one atomic group; groups lie in the order of a
60-bit hash of the text. The smallest shard capacity for which greedy filling
in that order needs at most ``shards`` shards is found by binary search, and
the order is cut there.

The groups themselves stay distributed. The driver searches over cells
(ranges of the hash, at first 4096): a capacity is too small if it fails even
when cells could be cut anywhere, and enough if it works with cuts between
cells only. Only cells in which a cut of a capacity between those two bounds
may fall are split further (one aggregation a round, at most about 65,000
cells), until every such cell is one group. Then the bounds meet: the result
is the exact one.

Law of the result: ``bytes``.

Defined cases: null texts are a group with size ``extra``, crc 0; empty
texts another; repeated rows lie together; fewer groups than shards leave
shards empty; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.tables import number_rows, stage

BITS = 60
FIRST_BITS = 12
MAX_CELLS = 65_536


def order_key(text: Column) -> Column:
    """The first 60 bits of the text's md5; null comes first."""
    return F.coalesce(F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long"), F.lit(0).cast("long"))


class _Cells:
    """Ranges of the order: first key, width in bits, bytes, groups."""

    def __init__(self, key, bits, size, groups):
        order = np.argsort(key)
        self.key, self.bits = np.asarray(key, np.int64)[order], np.asarray(bits, np.int64)[order]
        self.size, self.groups = np.asarray(size, np.int64)[order], np.asarray(groups, np.int64)[order]
        self.end = np.cumsum(self.size)

    def borders(self, cap: int, shards: int) -> list[int]:
        """Ends (bytes) of up to ``shards`` greedy shards cut between cells
        only; it stops where a cell does not fit."""
        out, at = [], 0
        for _ in range(shards):
            if at >= self.end[-1]:
                break
            i = int(np.searchsorted(self.end, at + cap, side="right"))
            to = int(self.end[i - 1]) if i else 0
            if to <= at:
                break
            out.append(to)
            at = to
        return out

    def loose(self, cap: int, shards: int) -> list[int]:
        """The same where cells of several groups may be cut anywhere."""
        out, at = [], 0
        for _ in range(shards):
            if at >= self.end[-1]:
                break
            i = int(np.searchsorted(self.end, at + cap, side="right"))
            to = at + cap
            if i >= len(self.end):
                to = int(self.end[-1])
            elif self.groups[i] == 1:
                to = int(self.end[i] - self.size[i])
            if to <= at:
                break
            out.append(to)
            at = to
        return out


def _least(fits, low: int, high: int) -> int:
    while low < high:
        mid = (low + high) // 2
        if fits(mid):
            high = mid
        else:
            low = mid + 1
    return low


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """(first keys of the 2nd and later shards, capacity) for a staged table
    of groups (key, size)."""
    total, largest = groups.agg(F.sum("size"), F.max("size")).first()
    if total is None:
        return [], 0
    cells = _collect(groups, BITS - FIRST_BITS)
    low = max(int(largest), -(-int(total) // shards))
    high = -(-int(total) // shards) + int(largest)
    while True:
        end = int(cells.end[-1])
        at_least = _least(lambda c: (cells.loose(c, shards) or [0])[-1] == end, low, high)
        top = int(cells.size.max())
        enough = _least(lambda c: (cells.borders(c, shards) or [0])[-1] == end, at_least, max(high, top + high))
        lo, hi = cells.borders(at_least, shards), cells.loose(min(enough, high), shards)
        unclear = np.zeros(len(cells.key), bool)
        start = cells.end - cells.size
        for j in range(shards):
            a = lo[j] if j < len(lo) else (lo[-1] if lo else 0)
            b = hi[j] if j < len(hi) else end
            if a < end:
                unclear |= (start < b) & (cells.end >= a) & (cells.groups > 1)
        if not unclear.any():
            break
        low, high = at_least, min(enough, high)
        cells = _split(groups, cells, unclear)
    ends = cells.borders(enough, shards)
    first = np.searchsorted(cells.end, ends[:-1], side="left") + 1
    return [int(cells.key[i]) for i in first], enough


def _collect(groups: DataFrame, bits: int) -> _Cells:
    """Cells of 2**bits keys; at most 2**(60 - bits) of them."""
    at = F.shiftleft(F.shiftright("key", bits), bits)
    rows = groups.groupBy(at.alias("at")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    return _Cells([r["at"] for r in rows], [bits] * len(rows), [r["size"] for r in rows], [r["n"] for r in rows])


def _split(groups: DataFrame, cells: _Cells, which: np.ndarray) -> _Cells:
    """Replaces the cells ``which`` by finer ones (those of the widest width,
    if they differ)."""
    bits = int(cells.bits[which].max())
    which = which & (cells.bits == bits)
    finer = max(0, bits - max(1, int(np.log2(max(2, MAX_CELLS // int(which.sum()))))))
    spark = groups.sparkSession
    chosen = spark.createDataFrame([(int(k) >> bits,) for k in cells.key[which]], "_at long")
    part = groups.join(F.broadcast(chosen), F.shiftright("key", bits) == F.col("_at"), "left_semi")
    new = _collect(part, finer)
    keep = ~which
    return _Cells(*(np.concatenate([getattr(cells, n)[keep], getattr(new, n)]) for n in ("key", "bits", "size", "groups")))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 40, extra: int = 16) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size (UTF-8 bytes plus
    ``extra``), text_crc32, law, shard, slot (from 0 in each shard, no gaps),
    grown_shard (null under this law), capacity."""
    text = F.col(text_col).cast("string")
    rows = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                             (F.coalesce(F.octet_length(text), F.lit(0)) + extra).cast("long").alias("size"),
                             F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
                             order_key(text).alias("key")), "shard-sizes")
    groups = stage(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    cuts, capacity = minimax_cuts(groups, shards)
    to = F.lit(0)
    for k in cuts:
        to = to + (F.col("key") >= k).cast("int")
    put = rows.withColumn("law", F.lit("bytes")).withColumn("shard", to.cast("int"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("~"))
    put = number_rows(put, "shard", key, ["doc_id", "key"], "slot")
    return put.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
                      F.lit(capacity).cast("long").alias("capacity"))
