"""Packing by optimal length buckets (operator 5).

Texts longer than ``max_len`` tokens are cut into pieces of it. The global
histogram of piece lengths (at most ``max_len`` numbers, however many texts)
goes to a dynamic program that chooses the ``buckets`` lengths to pad to with
the least padding in total. Inside each bucket pieces are numbered in a
seeded order and cut into batches of at most ``batch_tokens`` padded tokens;
the numbering is done in cuts, so no task holds a bucket.

Defined cases: texts without tokens (null, empty) give one row with piece 0,
0 tokens and no bucket or batch; rows without doc_id are packed like others;
repeated rows are packed as separate rows; an empty table gives an empty
result. A histogram with fewer lengths than buckets gives a bucket for each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.tables import count_words, number_rows, stage


def choose_lengths(hist: dict[int, int], buckets: int) -> list[int]:
    """The lengths to pad to (ascending, the last is the longest) that make
    the total padding of ``hist`` (length -> count) least; of equal choices
    the one whose boundaries are smaller from the top down."""
    sizes = np.array(sorted(hist), np.int64)
    if len(sizes) == 0:
        return []
    n = np.array([hist[int(s)] for s in sizes], np.int64)
    m = len(sizes)
    rows, mass = np.r_[0, np.cumsum(n)], np.r_[0, np.cumsum(n * sizes)]
    inf = np.iinfo(np.int64).max // 4
    best = np.full(m + 1, inf, np.int64)
    best[0] = 0
    back = []
    for _ in range(min(buckets, m)):
        now, came = np.full(m + 1, inf, np.int64), np.zeros(m + 1, np.int64)
        for j in range(1, m + 1):  # lengths i+1..j padded to the j-th
            cost = best[:j] + sizes[j - 1] * (rows[j] - rows[:j]) - (mass[j] - mass[:j])
            came[j] = int(cost.argmin())
            now[j] = cost[came[j]]
        best = now
        back.append(came)
    out, j = [], m
    for came in reversed(back):
        if j == 0:
            break
        out.append(int(sizes[j - 1]))
        j = int(came[j])
    return out[::-1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 16, max_len: int = 2048,
         batch_tokens: int = 65_536, seed: int = 1) -> DataFrame:
    """One row for each piece: doc_id, piece, start (its first token),
    n_tokens, bucket, bucket_len, padding, batch (numbered in its bucket) and
    slot in the batch."""
    tokens = docs.select(F.col(id_col).cast("long").alias("doc_id"), count_words(F.col(text_col)).alias("_all"))
    last = F.expr(f"greatest((_all - 1) div {max_len}, 0)")
    pieces = stage(tokens.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
                   .withColumn("start", F.col("piece") * max_len)
                   .select("doc_id", "piece", "start", F.least(F.lit(max_len).cast("long"), F.col("_all") - F.col("start")).alias("n_tokens")), "pieces")
    hist = {r["n_tokens"]: r["count"] for r in pieces.where("n_tokens > 0").groupBy("n_tokens").count().collect()}
    lengths = choose_lengths(hist, buckets)
    bucket, size, each = F.lit(None).cast("int"), F.lit(None).cast("long"), F.lit(None).cast("long")
    for i, length in reversed(list(enumerate(lengths))):
        fits = (F.col("n_tokens") <= length) & (F.col("n_tokens") > 0)
        bucket = F.when(fits, i).otherwise(bucket)
        size = F.when(fits, F.lit(length).cast("long")).otherwise(size)
        each = F.when(fits, F.lit(max(1, batch_tokens // length)).cast("long")).otherwise(each)
    rows = pieces.withColumn("bucket", bucket).withColumn("bucket_len", size).withColumn("_each", each)
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), F.col("piece").cast("string"))
    put = number_rows(rows.where("bucket is not null"), "bucket", key, ["doc_id", "piece", "n_tokens"], "_i")
    cols = ["doc_id", "piece", "start", "n_tokens", "bucket", "bucket_len"]
    put = put.select(*cols, (F.col("bucket_len") - F.col("n_tokens")).alias("padding"),
                     F.expr("_i div _each").alias("batch"), (F.col("_i") % F.col("_each")).alias("slot"))
    none = F.lit(None).cast("long")
    return put.unionByName(rows.where("bucket is null").select(*cols, none.alias("padding"), none.alias("batch"), none.alias("slot")))
