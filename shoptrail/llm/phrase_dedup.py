"""Substring dedup with repeated-phrase automata (operator 3).

A window is ``width`` consecutive words of one document. Words covered by a
window that also starts in a document with a smaller doc_id are removed.

1. Blocks of documents send the least five-word hash of every window (its
   anchor, about a fifth as many as words) to hash buckets; anchors seen in two documents
   come back. Two equal windows have equal anchors, so all other windows are
   unique and go no further.
2. Blocks send the 128-bit hashes of the remaining windows with their
   smallest doc_id; confirmed recurring windows come back with the smallest
   doc_id of the corpus.
3. Each block compiles its recurring passages (maximal runs of removable
   windows) into an Aho-Corasick automaton over coded words and streams every
   document of the block through it to locate each occurrence. The automata
   are sharded by block, so one holds at most a block's own words.

All three steps read one shuffle of the texts by block; packed exchanges in
between carry hashes only. Hot windows are reduced inside each block first.

Defined cases: null texts have no words (n_words 0, the sha256 of the empty
string); rows without doc_id neither lose words nor count as an earlier
document; rows that repeat a doc_id do not remove each other's words; an
empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.exchange import buckets_for, deal, joined, lengths, parts
from shoptrail.llm.tables import blocks, text_bytes
from shoptrail.llm.text import WordHashes, windows, words

BLOCK_BYTES = 4_000_000
GRAM = 5
OUT = "doc_id long, known boolean, n_words long, n_removed long, kept_sha256 string, kept_text string"
SENT = "bucket int, block int, h binary, g binary, d binary, c binary"
CAME = "block int, h binary, g binary, d binary"


class _Block:
    """The words of a block's documents on one line, with their hashes."""

    def __init__(self, pdf: pd.DataFrame, width: int):
        self.ids = pdf["doc_id"].to_numpy(np.int64)
        self.known = pdf["known"].to_numpy(bool)
        self.words = [words(t) for t in pdf["text"]]
        self.n = np.array([len(w) for w in self.words], np.int64)
        wh = WordHashes()
        self.h = np.concatenate([wh.of(w) for w in self.words]) if len(pdf) else np.empty(0, np.uint64)
        doc = np.repeat(np.arange(len(self.n)), self.n)
        m = max(0, len(self.h) - width + 1)
        same = doc[:m] == doc[width - 1:width - 1 + m]
        self.at = np.flatnonzero(same & self.known[doc[:m]]) if m else np.empty(0, np.int64)
        self.doc = doc
        self.width = width

    def anchors(self) -> np.ndarray:
        """Of each window in ``at``: the least hash of its five-word grams."""
        if len(self.at) == 0:
            return np.empty(0, np.uint64)
        least = np.lib.stride_tricks.sliding_window_view(windows(self.h, GRAM), self.width - GRAM + 1)
        out = least[:, 0].copy()
        for i in range(1, least.shape[1]):
            np.minimum(out, least[:, i], out=out)
        return out[self.at]

    def keys(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return windows(self.h, self.width, salt=1)[at], windows(self.h, self.width, salt=2)[at]


def _least_of_groups(h, g, d, c):
    """Distinct (h, g) with the least d and the sum of c; inputs may repeat."""
    order = np.lexsort((d, g, h))
    h, g, d, c = h[order], g[order], d[order], c[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])] if len(h) else np.empty(0, bool)
    start = np.flatnonzero(new)
    total = np.add.reduceat(c, start) if len(start) else c
    return h[start], g[start], d[start], total, order, np.cumsum(new) - 1


def _send_anchors(width: int, n_buckets: int):
    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        b = _Block(pdf, width)
        a, doc = b.anchors(), b.doc[b.at]
        if len(a):
            first = np.r_[True, (a[1:] != a[:-1]) | (doc[1:] != doc[:-1])]
            a, doc = a[first], doc[first]
            order = np.lexsort((doc, a))
            a, doc = a[order], doc[order]
            first = np.r_[True, (a[1:] != a[:-1]) | (doc[1:] != doc[:-1])]
            a = a[first]
        h, count = np.unique(a, return_counts=True)
        c = np.minimum(count, 2).astype(np.uint8)
        block = int(pdf["block"].iloc[0])
        return pd.DataFrame([(k, block, h[i].tobytes(), b"", b"", c[i].tobytes()) for k, i in deal(h, n_buckets)],
                            columns=["bucket", "block", "h", "g", "d", "c"])
    return send


def _shared_anchors(pdf: pd.DataFrame) -> pd.DataFrame:
    h, c = joined(pdf["h"], np.uint64), joined(pdf["c"], np.uint8)
    _, which = np.unique(h, return_inverse=True)
    ok = np.bincount(which, weights=c)[which] >= 2
    rows = [(block, hs[keep].tobytes(), b"", b"") for block, hs, keep in
            zip(pdf["block"], parts(h, lengths(pdf["h"], 8)), parts(ok, lengths(pdf["h"], 8))) if keep.any()]
    return pd.DataFrame(rows, columns=["block", "h", "g", "d"])


def _send_windows(width: int, n_buckets: int):
    def send(pdf: pd.DataFrame, came: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(pdf) and len(came):
            b = _Block(pdf, width)
            shared = np.unique(joined(came["h"], np.uint64))
            a = b.anchors()
            pos = np.searchsorted(shared, a)
            hit = shared[np.minimum(pos, len(shared) - 1)] == a
            at = b.at[hit]
            h, g = b.keys(at)
            d, one = b.ids[b.doc[at]], np.ones(len(at), np.int64)
            order = np.lexsort((d, g, h))
            h, g, d = h[order], g[order], d[order]
            new = np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1]) | (d[1:] != d[:-1])] if len(h) else np.empty(0, bool)
            h, g, d, c, _, _ = _least_of_groups(h[new], g[new], d[new], one[:int(new.sum())])
            c = np.minimum(c, 2).astype(np.uint8)
            block = int(pdf["block"].iloc[0])
            out = [(k, block, h[i].tobytes(), g[i].tobytes(), d[i].tobytes(), c[i].tobytes()) for k, i in deal(h, n_buckets)]
        return pd.DataFrame(out, columns=["bucket", "block", "h", "g", "d", "c"])
    return send


def _recurring_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    h, g, d, c = (joined(pdf[n], t) for n, t in (("h", np.uint64), ("g", np.uint64), ("d", np.int64), ("c", np.uint8)))
    uh, ug, ud, total, order, group = _least_of_groups(h, g, d, c.astype(np.int64))
    where = np.empty(len(h), np.int64)
    where[order] = group
    ok, least = total[where] >= 2, ud[where]
    size = lengths(pdf["h"], 8)
    rows = [(block, x[keep].tobytes(), y[keep].tobytes(), z[keep].tobytes()) for block, x, y, z, keep in
            zip(pdf["block"], parts(h, size), parts(g, size), parts(least, size), parts(ok, size)) if keep.any()]
    return pd.DataFrame(rows, columns=["block", "h", "g", "d"])


class _Code:
    """Words of the patterns as three symbols of separate ranges, so a match
    starts and ends on word borders; any other word is a break."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.ids = vocabulary
        self.base = max(2, int(np.ceil(len(vocabulary) ** (1 / 3))) + 1)

    def __call__(self, ws: list[bytes]) -> str:
        get, b = self.ids.get, self.base
        i = np.fromiter((get(w, -1) for w in ws), np.int64, len(ws))
        s = np.stack([1 + i % b, 1 + b + i // b % b, 1 + 2 * b + i // b // b], axis=1)
        s[i < 0] = 3 * b + 2
        return s.astype(np.uint32).tobytes().decode("utf-32-le")


def _locate(width: int, with_text: bool):
    def locate(pdf: pd.DataFrame, came: pd.DataFrame) -> pd.DataFrame:
        b = _Block(pdf, width)
        passages: dict[tuple[bytes, ...], int] = {}
        if len(came) and len(b.at):
            h, g, d = (joined(came[n], t) for n, t in (("h", np.uint64), ("g", np.uint64), ("d", np.int64)))
            order = np.lexsort((g, h))
            h, g, d = h[order], g[order], d[order]
            wh, wg = b.keys(b.at)
            pos = np.minimum(np.searchsorted(h, wh), len(h) - 1)
            least = d[pos]
            hit = (h[pos] == wh) & (g[pos] == wg) & (least < b.ids[b.doc[b.at]])
            at, least = b.at[hit], least[hit]
            if len(at):
                start = np.flatnonzero(np.r_[True, np.diff(at) != 1])
                stop = np.r_[start[1:], len(at)] - 1
                limit = np.maximum.reduceat(least, start)
                offset = np.cumsum(b.n) - b.n
                for s, e, m in zip(at[start], at[stop], limit):
                    doc = b.doc[s]
                    a = s - offset[doc]
                    passages[tuple(b.words[doc][a:e - offset[doc] + width])] = int(m)
        vocabulary: dict[bytes, int] = {}
        for p in passages:
            for w in p:
                vocabulary.setdefault(w, len(vocabulary))
        code, automaton = _Code(vocabulary), ahocorasick.Automaton()
        for p, m in passages.items():
            automaton.add_word(code(list(p)), (len(p), m))
        if passages:
            automaton.make_automaton()
        rows = []
        for i, ws in enumerate(b.words):
            kept = ws
            if passages and b.known[i] and len(ws) >= width:
                edge = np.zeros(len(ws) + 1, np.int64)
                for end, (length, m) in automaton.iter(code(ws)):
                    if m < b.ids[i]:
                        stop = (end + 1) // 3
                        edge[stop - length] += 1
                        edge[stop] -= 1
                if edge.any():
                    covered = np.cumsum(edge[:-1]) > 0
                    kept = [w for w, c in zip(ws, covered.tolist()) if not c]
            text = b" ".join(kept)
            rows.append((int(b.ids[i]), bool(b.known[i]), len(ws), len(ws) - len(kept), hashlib.sha256(text).hexdigest(),
                         text.decode("utf-8", "surrogatepass") if with_text else None))
        return pd.DataFrame(rows, columns=["doc_id", "known", "n_words", "n_removed", "kept_sha256", "kept_text"])
    return locate


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13,
                             with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and (unless ``with_text`` is
    False) kept_text: the kept words joined by one space."""
    if width < GRAM:
        raise ValueError(f"width must be at least {GRAM}")
    _, size = text_bytes(docs, text_col)
    n_buckets = buckets_for(size)
    base, _ = blocks(docs, id_col, text_col, BLOCK_BYTES)
    base = base.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("known"), "text", "block")
    by_block = base.groupBy("block")
    anchors = by_block.applyInPandas(_send_anchors(width, n_buckets), SENT)
    shared = anchors.groupBy("bucket").applyInPandas(_shared_anchors, CAME)
    sent = by_block.cogroup(shared.groupBy("block")).applyInPandas(_send_windows(width, n_buckets), SENT)
    recurring = sent.groupBy("bucket").applyInPandas(_recurring_windows, CAME)
    found = by_block.cogroup(recurring.groupBy("block")).applyInPandas(_locate(width, with_text), OUT)
    cols = ["n_words", "n_removed", "kept_sha256"] + (["kept_text"] if with_text else [])
    return found.select(F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), *cols)
