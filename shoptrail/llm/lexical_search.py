"""Ranked lexical search (operator 12): an Aho-Corasick automaton of all item
terms scans the documents; no index of the documents is built.

1. The items' terms are dealt to shards by item, as many as keep a shard near
   ``shard_terms`` distinct terms, so what a task holds is bounded whatever
   the number of items. Each shard makes its own scan.
2. A task builds the shard's automaton from terms guarded by a boundary on
   both sides and streams every whole text through it, cut down to terms
   between single boundaries: each hit is one occurrence of one term. A
   document gives its number of terms and its (term, tf) outputs.
3. N and L come from the term counts, df from the outputs. The outputs map to
   items; a task keeps the ``top`` best documents of each item and Spark
   merges the tasks' lists.

Defined cases: a null text has no term and does not count for N; a document
that holds no term of any item is in no list; equal scores rank by doc_id, a
document without one after the others; every row of a repeated document is
one document. Rows that share an item_id (null included) are one item with
the terms of all of them; an item without terms has no list. Empty tables
give an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import floor, log

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoptrail.llm.tables import stage, text_batches
from shoptrail.llm.text import chunks

# Every ASCII byte that no term holds reads as one blank; A-Z in lower case;
# bytes of other code points stay.
_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or c in _KEEP else 0x20 for c in range(256))
RANKED = "item long, no_id boolean, doc_id long, score long"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in their order, A-Z lower-cased; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def _automaton(vocabulary: list[bytes]) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for i, term in enumerate(vocabulary):
        made.add_word(f" {term.decode('latin-1')} ", i)
    made.make_automaton()
    return made


def _scanner(vocabulary: list[bytes]):
    """(doc_id, n, terms, tfs) of every text: one walk of the automaton."""
    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(vocabulary) if vocabulary else None
        for pdf in frames:
            texts = pdf["text"].tolist()
            for a, b in chunks([len(t or "") for t in texts], 2_000_000):
                n, ids, tfs = [], [], []
                for text in texts[a:b]:
                    ws = terms(text)
                    n.append(len(ws))
                    guarded = f" {b' '.join(ws).decode('latin-1')} "
                    hits = np.fromiter((i for _, i in automaton.iter(guarded)), np.int32) if ws and automaton else np.empty(0, np.int32)
                    found, times = np.unique(hits, return_counts=True)
                    ids.append(found)
                    tfs.append(times.astype(np.int64))
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[a:b].to_numpy(), "no_id": pdf["no_id"].iloc[a:b].to_numpy(), "n": np.array(n, np.int64), "terms": ids, "tfs": tfs})
    return scan


def _ranker(weights: np.ndarray, start: np.ndarray, items: np.ndarray, n_items: int, n_docs: int, n_terms: int, top: int):
    """Each item's best documents of a task. ``items[start[t]:start[t + 1]]``
    are the items of term t."""
    def best(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        both = pd.concat([old, new]).sort_values(["item", "score", "no_id", "doc_id"], ascending=[True, False, True, True])
        return both.groupby("item", sort=False).head(top)

    def rank(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = pd.DataFrame({"item": np.empty(0, np.int64), "no_id": np.empty(0, bool), "doc_id": np.empty(0, np.int64),
                             "score": np.empty(0, np.int64)})
        floor_of = np.zeros(n_items, np.int64)  # a lower score than the last of a full list is out
        for pdf in frames:
            sizes = [len(t) for t in pdf["terms"]]
            for a, b in chunks([s * 8 for s in sizes], 400_000):
                part = pdf.iloc[a:b]
                doc = np.repeat(np.arange(b - a), sizes[a:b])
                if not len(doc):
                    continue
                term = np.concatenate(part["terms"].to_list()).astype(np.int64)
                tf = np.concatenate(part["tfs"].to_list()).astype(np.int64)
                m = 50 + (50 * part["n"].to_numpy(np.int64) * n_docs) // n_terms
                gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
                fan = start[term + 1] - start[term]
                place = np.arange(fan.sum()) - np.repeat(np.cumsum(fan) - fan, fan)
                cell = np.repeat(doc, fan) * n_items + items[np.repeat(start[term], fan) + place]
                cells, at = np.unique(cell, return_inverse=True)
                score = np.zeros(len(cells), np.int64)
                np.add.at(score, at, np.repeat(gain, fan))
                item = cells % n_items
                good = (score > 0) & (score >= floor_of[item])
                row = (cells // n_items)[good]
                kept = best(kept, pd.DataFrame({"item": item[good], "no_id": part["no_id"].to_numpy()[row],
                                                "doc_id": part["doc_id"].to_numpy()[row], "score": score[good]}))
                counts = kept.groupby("item")["score"].agg(["size", "min"])
                full = counts[counts["size"] >= top]
                floor_of[full.index.to_numpy()] = full["min"].to_numpy()
        yield kept
    return rank


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, term): one row for each distinct term of an item."""
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            found = [(i, t) for i, text in zip(pdf["item_id"], pdf["text"]) for t in set(terms(text))]
            yield pd.DataFrame(found, columns=["item_id", "term"])
    src = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    cut_up = src.mapInPandas(cut, "item_id string, term binary").distinct()
    return cut_up.select(F.col("item_id").cast("long").alias("item_id"), "term")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", top: int = 50, shard_terms: int = 20_000) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``top`` documents."""
    spark = docs.sparkSession
    text_batches(spark)
    wanted = stage(_item_terms(items, item_col, item_text_col), "item-terms")
    shards = max(1, -(-wanted.count() // shard_terms))
    found = F.col(id_col).cast("long")
    src = docs.select(F.coalesce(found, F.lit(0)).alias("doc_id"), found.isNull().alias("no_id"), F.col(text_col).cast("string").alias("text"))
    ranked = [_search_shard(src, wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == s), top) for s in range(shards)]
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (reduce(DataFrame.unionByName, ranked).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))


def _search_shard(src: DataFrame, wanted: DataFrame, top: int) -> DataFrame:
    rows = wanted.collect()  # about shard_terms rows
    vocabulary = sorted({bytes(r["term"]) for r in rows})
    number = {t: i for i, t in enumerate(vocabulary)}
    ids = list(dict.fromkeys(r["item_id"] for r in rows))
    place = {v: i for i, v in enumerate(ids)}
    pairs = np.array(sorted((number[bytes(r["term"])], place[r["item_id"]]) for r in rows), np.int64).reshape(-1, 2)
    start = np.searchsorted(pairs[:, 0], np.arange(len(vocabulary) + 1))

    scanned = stage(src.mapInPandas(_scanner(vocabulary), "doc_id long, no_id boolean, n long, terms array<int>, tfs array<long>"), "scanned")
    n_docs, n_terms = scanned.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = scanned.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # one row a term of the shard
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in held:
        weights[term] = floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))
    rank = _ranker(weights, start, pairs[:, 1].copy(), len(ids), n_docs, max(1, n_terms), top)
    found = scanned.where(F.size("terms") > 0).mapInPandas(rank, RANKED)
    names = src.sparkSession.createDataFrame(list(enumerate(ids)), "item long, item_id long")  # as many as the shard's items
    return found.join(F.broadcast(names), "item").select(
        "item_id", F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score")
