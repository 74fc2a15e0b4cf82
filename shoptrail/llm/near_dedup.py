"""MinHash near-dedup (operator 8): SuperMinHash, banding, verification and
union-find grouping over distributed tables.

1. Every whole text becomes its set of distinct five-word shingles, the
   SuperMinHash signature of that set and its band keys. Texts with equal
   sets are one class, stood for by the smallest doc_id.
2. Class representatives that share a band key form a bucket. Each member is
   compared with the bucket's smallest member on full sets (a star, so a
   group of copies makes as many pairs as members, not all pairs).
3. Confirmed links are grouped. Only buckets that still hold several groups
   go on: small ones try the pairs across groups; in large ones only pairs
   across groups are tried whose rarest shingles meet (prefix and position
   bounds of set similarity joins, which lose no pair).
   Nothing is capped: each band pair is confirmed, implied by a chain of
   confirmed links, or excluded by an exact bound.
4. Groups that links of the second round join are grouped once more: only
   these links, between the first round's groups, give the components.

With 32 bands of 4 ranks a pair of similarity 0.75 shares no band with
probability 5e-6.

Defined cases: null or wordless texts have an empty set, link with nothing
and are kept; rows without doc_id likewise (their component is null); rows
that repeat a doc_id are one document, each row is returned; an empty table
gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoptrail.llm.components import components
from shoptrail.llm.superminhash import band_keys, signatures
from shoptrail.llm.tables import narrow, stage, text_batches
from shoptrail.llm.text import U, WordHashes, chunks, mix, shingle_set, signed, words

SIGNED = "doc_id long, n_shingles long, class string, bands array<long>"
CELLS = 1 << 20  # of the table that orders shingles by how many sets hold them
SLICE = 4_096  # cells that one group adds up


def _signer(k: int, ranks: int, band_rows: int):
    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wh = WordHashes()
        for pdf in frames:
            texts = pdf["text"].tolist()
            for a, b in chunks([len(t or "") for t in texts], 300_000):
                sets = [shingle_set(wh.of(words(t, lower=True)), k) for t in texts[a:b]]
                n = np.array([len(s) for s in sets], np.int64)
                sig = signatures(np.concatenate(sets), np.repeat(np.arange(len(sets)), n), len(sets), ranks)
                keys = signed(band_keys(sig, band_rows))
                yield pd.DataFrame({
                    "doc_id": pdf["doc_id"].iloc[a:b].to_numpy(), "n_shingles": n,
                    "class": [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets],
                    "bands": [row if len(s) else row[:0] for row, s in zip(keys, sets)]})
    return sign


def _setter(k: int):
    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wh = WordHashes()
        for pdf in frames:
            for a, b in chunks([len(t or "") for t in pdf["text"]], 300_000):
                part = pdf.iloc[a:b]
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "shingles": [
                    signed(shingle_set(wh.of(words(t, lower=True)), k)) for t in part["text"]]})
    return sets


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets reach the similarity."""
    a = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("su"))
    b = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("sv"))
    both = F.size(F.array_intersect("su", "sv"))
    return (pairs.join(a, "u").join(b, "v")
            .select("u", "v", both.alias("both"), (F.size("su") + F.size("sv")).alias("total"))
            .where(100 * F.col("both") >= percent * (F.col("total") - F.col("both"))).select("u", "v"))


def _fits(percent: int):
    """Sizes alone must allow the similarity (an exact bound)."""
    return 100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv")


def _across(left: DataFrame, key: str, percent: int) -> DataFrame:
    """Pairs u < v of small buckets that lie in different groups."""
    a = left.select(key, F.col("doc_id").alias("u"), F.col("n").alias("nu"), F.col("group").alias("gu"))
    b = left.select(key, F.col("doc_id").alias("v"), F.col("n").alias("nv"), F.col("group").alias("gv"))
    return a.join(b, key).where((F.col("u") < F.col("v")) & (F.col("gu") != F.col("gv")) & _fits(percent)).select("u", "v")


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (mix(shingles.view(np.uint64) ^ U(0x6A09E667F3BCC909)) % U(CELLS)).astype(np.int64)


def _tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many sets of a task hold a shingle of each hash cell, in slices."""
    counts = np.zeros(CELLS, np.int64)
    for pdf in frames:
        for s in pdf["shingles"]:
            counts[np.unique(_cells(s))] += 1
    out = []
    for i, part in enumerate(counts.reshape(-1, SLICE)):
        at = np.flatnonzero(part)
        if len(at):
            out.append((i, at.astype(np.uint16).tobytes(), part[at].astype(np.uint32).tobytes()))
    yield pd.DataFrame(out, columns=["slice", "cells", "counts"])


def _levels(pdf: pd.DataFrame) -> pd.DataFrame:
    """A slice's counts over all tasks on a scale of eight steps a doubling;
    0 for a cell that one set holds."""
    counts = np.zeros(SLICE, np.int64)
    for cells, more in zip(pdf["cells"], pdf["counts"]):
        counts[np.frombuffer(cells, np.uint16)] += np.frombuffer(more, np.uint32)
    levels = np.minimum(255, 8 * np.log2(np.maximum(counts, 1))).astype(np.uint8)
    return pd.DataFrame({"slice": pdf["slice"].iloc[:1].to_numpy(), "levels": [levels.tobytes()]})


def _prefixes(levels: np.ndarray, percent: int):
    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for a, b in chunks([len(s) for s in pdf["shingles"]], 300_000):
                part, met, places = pdf.iloc[a:b], [], []
                for s, n in zip(part["shingles"], part["n"]):
                    level = levels[_cells(s)]
                    first = np.lexsort((s, level))[:n + -n * percent // 100 + 1]
                    shared = np.flatnonzero(level[first])
                    met.append(s[first[shared]])
                    places.append(shared + 1)
                made = [len(x) for x in met]
                yield pd.DataFrame({"shingle": np.concatenate(met), "place": np.concatenate(places)} | {
                    c: np.repeat(part[c].to_numpy(), made) for c in ("doc_id", "n", "group")})[["shingle", "doc_id", "n", "group", "place"]]
    return place


def _rare(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs across groups of large buckets that can still be similar.

    A document's shingles stand in one global order, rarest first: by the
    number of documents that hold a shingle of the same hash cell, a table of
    CELLS bytes whatever the input. Only the shingles that the bounds ask for
    become rows, less those that no other document holds. For a pair
    of this similarity the larger set's first n - ceil(p n) + 1 shingles and
    the smaller one's first n - ceil(2p/(1+p) n) + 1 must meet, and the first
    one they share must leave room for the overlap that the sizes ask for.
    Passages that many texts share stand at the end of that order, so they
    bring no pairs together. Both bounds are exact."""
    ids = members.select("doc_id", "n", "group").distinct()
    rows = ids.join(sets, "doc_id").select("doc_id", "n", "group", "shingles")
    tallied = (rows.mapInPandas(_tally, "slice int, cells binary, counts binary").groupBy("slice")
               .applyInPandas(_levels, "slice int, levels binary").collect())
    levels = np.zeros(CELLS, np.uint8)
    for r in tallied:
        levels[r["slice"] * SLICE:(r["slice"] + 1) * SLICE] = np.frombuffer(r["levels"], np.uint8)
    placed = stage(rows.mapInPandas(_prefixes(levels, percent), "shingle long, doc_id long, n long, group long, place long"), "rare")
    a = placed.select("shingle", F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("group").alias("ga"), F.col("place").alias("pa"))
    b = (placed.where(F.col("place") <= F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent)) + 1)
         .select("shingle", F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("group").alias("gb"), F.col("place").alias("pb")))
    larger = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") > F.col("b")))
    room = 1 + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    fits = (100 + percent) * room >= percent * (F.col("na") + F.col("nb"))
    return (a.join(b, "shingle").where(larger & (F.col("ga") != F.col("gb")) & (100 * F.col("nb") >= percent * F.col("na")) & fits)
            .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, k: int = 5,
                    ranks: int = 128, band_rows: int = 4, small_bucket: int = 32) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id
    (smallest doc_id reachable over links of Jaccard >= percent/100), kept."""
    text_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = stage(src.mapInPandas(_signer(k, ranks, band_rows), SIGNED), "signed")

    usable = table.where("n_shingles > 0 and doc_id is not null")
    classes = stage(usable.groupBy("class").agg(F.min("doc_id").alias("rep")), "classes")
    reps = usable.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    banded = reps.select("doc_id", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    shared = (banded.groupBy("band").agg(F.min(F.struct("doc_id", "n")).alias("c"), F.count(F.lit(1)).alias("size"))
              .where("size > 1").select("band", "size", F.col("c.doc_id").alias("u"), F.col("c.n").alias("nu")))
    members = stage(banded.join(shared, "band"), "members")

    ids = stage(members.select("doc_id").distinct(), "candidates")
    sets = stage(src.join(narrow(ids), "doc_id", "left_semi").mapInPandas(_setter(k), "doc_id long, shingles array<long>")
                 .dropDuplicates(["doc_id"]), "sets")
    star = stage(members.where("doc_id <> u").select("u", F.col("doc_id").alias("v"), "nu", F.col("n").alias("nv"))
                 .where(_fits(percent)).select("u", "v").distinct(), "star")
    links = stage(_confirmed(star, sets, percent), "links")
    groups = stage(components(links), "groups")

    labelled = members.join(groups, members["doc_id"] == groups["node"], "left").select(
        "band", "size", "doc_id", "n", F.coalesce("component", "doc_id").alias("group"))
    mixed = labelled.groupBy("band").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo < hi").select("band")
    left = stage(labelled.join(mixed, "band", "left_semi"), "left")
    few, many = left.where(F.col("size") <= small_bucket), left.where(F.col("size") > small_bucket)
    more = _across(few, "band", percent).unionByName(_rare(many, sets, percent))
    more = stage(more.distinct().join(star, ["u", "v"], "left_anti"), "across")
    of_u, of_v = (groups.select(F.col("node").alias(x), F.col("component").alias(g)) for x, g in (("u", "gu"), ("v", "gv")))
    bridges = (_confirmed(more, sets, percent).join(of_u, "u", "left").join(of_v, "v", "left")
               .select(F.coalesce("gu", "u").alias("u"), F.coalesce("gv", "v").alias("v")))
    joined = components(bridges).select(F.col("node").alias("group"), F.col("component").alias("whole"))

    found = (table.select("doc_id", "n_shingles", "class").join(classes, "class", "left")
             .join(groups, F.col("rep") == F.col("node"), "left")
             .withColumn("group", F.coalesce("component", "rep")).join(joined, "group", "left"))
    component = F.when(F.col("n_shingles") > 0, F.coalesce("whole", "group", "doc_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id")).select(
        "*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
