"""LM scoring with a hierarchical Pitman-Yor model (operator 7).

Restaurants: one for each previous word seen in training (the end token is
the context of a text's first word), with the words that followed it as
dishes; all of them share one parent restaurant over the whole vocabulary.
Its base is even over the seen words and one outcome more, "a word not seen",
the outcomes of the add-one base: a context's probabilities of the seen words
and of that outcome sum to one. ``score`` is over these outcomes. For
``open_score`` an unseen word is also spelled: a chain of bytes, each given the
one before it, learned from the training tokens, whose probabilities of all
words sum to one; so those of all texts sum to at most one.

Seating is sampled by Gibbs sweeps: a sweep seats the customers of each
(previous word, word) cell again, one after the other, given the tables that
all other cells had after the sweep before (long queues in growing steps, each
a binomial draw). Tables of the context restaurants are the customers of the
parent. After ``burn`` sweeps the predictive probabilities of the next ones
are averaged. Draws are seeded by bucket, so a lost task is redone alike.

Texts are read in blocks and coded once: each task cuts its input into blocks
and writes a block's words as positions in its own list of words, so whole
texts are never shuffled. Word buckets (by hash) count words over all blocks
and number them, the frequent ones first; blocks learn the numbers and send
their pairs to pair buckets as sorted numbers (see exchange.py). A pair bucket
holds cells, dealt by context; a context is cut by word into as many parts as
its count asks for, so those of a frequent context are spread. A cell with one
customer has one table in every sweep; only words of cells with more are
exchanged in a sweep, as positions in their word bucket. Vocabulary and cells
grow with the corpus and stay distributed; the driver sees a few totals a
sweep and the 256 x 256 counts of the spelling.

Words are 64-bit xxh64 hashes of lower-cased (A-Z) words. Defined cases: null
and empty texts are the end token alone; rows without doc_id are held out
False but are not learned from; with no training text every probability comes
from the base, which then has the one outcome; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.exchange import buckets_for, deal, joined, lengths, parts
from shoptrail.llm.tables import crc_mod, stage, text_batches, text_bytes
from shoptrail.llm.text import U, chunks, mix, words

BLOCK_CHARS = 8_000_000
END = xxhash.xxh64_intdigest(b" ")  # no word holds a space


class _Seats:
    """Discounts and strengths, with the sampler of table counts."""

    def __init__(self, discount: float, strength: float):
        self.d, self.theta = discount, strength

    def tables(self, customers: np.ndarray, new: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Tables of each cell after seating its customers in turn; ``new``
        is the weight of opening one ((theta + d T) times the parent's
        probability)."""
        t = np.minimum(customers, 1).astype(np.int64)
        live = np.flatnonzero(customers > 1)
        i = 1
        while len(live):
            step = max(1, i // 8)
            c, tt, w = customers[live], t[live], new[live]
            todo = np.minimum(c - i, step)
            p = w / (w + np.maximum(i + (todo - 1) / 2 - self.d * tt, 1e-9))
            t[live] = tt + (rng.random(len(live)) < p if step == 1 else rng.binomial(todo, p))
            i += step
            live = live[customers[live] > i]
        return np.minimum(t, customers)


class _Spelling:
    """Log10 probability of a word as a chain of bytes with a space before and
    after it. Counts get ``add`` for each possible byte, so every word has a
    probability, and those of all words sum to one."""

    def __init__(self, pairs: np.ndarray, add: float = 0.1):
        n = pairs.reshape(256, 256) + add
        n[:, 9:14] = 0  # white space other than the closing one
        n[32, 32] = 0  # the empty word
        with np.errstate(divide="ignore"):
            self.log = np.log10(n / n.sum(axis=1, keepdims=True)).astype(np.float32)

    def of(self, ws: list[bytes]) -> np.ndarray:
        if not ws:
            return np.zeros(0)
        x = np.frombuffer(b" " + b" ".join(ws) + b" ", np.uint8)
        size = np.fromiter(map(len, ws), np.int64, len(ws)) + 1
        return np.add.reduceat(self.log[x[:-1], x[1:]], np.cumsum(size) - size, dtype=np.float64)


def _byte_pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of adjacent bytes in the words, each between two spaces."""
    total = np.zeros(256 * 256, np.int64)
    for pdf in frames:
        texts = pdf["text"].tolist()
        for a, b in chunks([len(t) for t in texts], 300_000):
            x = np.frombuffer(b" " + b" ".join(words(" ".join(texts[a:b]), lower=True)) + b" ", np.uint8).astype(np.int32)
            total += np.bincount(x[:-1] * 256 + x[1:], minlength=len(total))
    at = np.flatnonzero(total)
    yield pd.DataFrame({"pair": at, "n": total[at]})


def _learn_spelling(texts: DataFrame) -> _Spelling:
    """From a column of texts; at most 256 x 256 sums come to the driver."""
    rows = texts.mapInPandas(_byte_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    pairs = np.zeros(256 * 256)
    for r in rows:
        pairs[r["pair"]] = r["n"]
    return _Spelling(pairs)


class _Ids(dict):
    def __missing__(self, w: bytes) -> int:
        i = self[w] = len(self)
        return i


def _tokens(texts, spelling: _Spelling) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes with END last, all texts' words as positions in them
    with END after each text, tokens of each text, log10 probability of each
    distinct word's spelling, 0 for END)."""
    ids = _Ids()
    rows = [np.fromiter(map(ids.__getitem__, words(t, lower=True)), np.int64) for t in texts]
    size = np.array([len(r) + 1 for r in rows], np.int64)
    own = np.append(np.fromiter((xxhash.xxh64_intdigest(w) for w in ids), np.uint64, len(ids)), np.uint64(END))
    every = np.full(int(size.sum()), len(ids), np.int64)
    inner = np.ones(len(every), bool)
    inner[np.cumsum(size) - 1] = False
    every[inner] = np.concatenate(rows)
    return own, every, size, np.append(spelling.of(list(ids)), 0.0)


def _pairs(n: int, every: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (previous, word) of ``n`` words in rising order, and each
    token's pair. ``end`` is before the first word of every text."""
    code, which = np.unique(np.r_[end, every[:-1]] * n + every, return_inverse=True)
    return code // n, code % n, which


def _deal_pairs(u: np.ndarray, w: np.ndarray, cuts: np.ndarray, n: int):
    """Pairs by context; one with ``cuts`` above 1 is cut by word."""
    part = mix(w.astype(np.uint64)) % cuts.astype(np.uint64)
    return deal(mix(u.astype(np.uint64) * U(0x9E3779B97F4A7C15) ^ part), n)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]]) if len(sorted_values) else np.empty(0, np.int64)


def _pack(x: np.ndarray) -> bytes:
    """Non-negative integers as byte planes of the least width that holds them
    all, compressed where there are many."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    if len(planes) < 200:
        return bytes([width]) + planes
    return bytes([width + 8]) + zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(raw: bytes | None) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.int64)
    width, planes = raw[0], raw[1:]
    if width > 8:
        width, planes = width - 8, zstandard.ZstdDecompressor().decompress(planes)
    out = np.zeros((len(planes) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, -1).T
    return out.view("<i8")[:, 0].astype(np.int64)


def _pack_rising(x: np.ndarray) -> bytes:
    return _pack(np.diff(x, prepend=0))


def _unpack_rising(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw))


_CODED = ("kind int, bucket int, block long, h binary, c binary, every binary, often binary, size binary, doc_id binary, "
          "flags binary, spelled binary, end long")
_CODED_COLUMNS = [x.split()[0] for x in _CODED.split(", ")]
_KNOWN, _HELD, _LEARN = 1, 2, 4
_BLOCK = ["block", "every", "often", "size", "doc_id", "flags", "spelled", "end"]


def _encode(n_buckets: int, spelling: _Spelling):
    """Cuts a task's rows into blocks. Kind 0: a block's words for each word
    bucket, with their counts in training texts. Kind 1: the block itself;
    its words are in the order of (bucket, hash), its tokens refer to them by
    how often they come in the block (``often``)."""
    def block_rows(block: int, pdf: pd.DataFrame) -> pd.DataFrame:
        own, every, size, spelled = _tokens(pdf["text"], spelling)
        by = list(deal(own, n_buckets))
        order = np.concatenate([i[np.argsort(own[i])] for _, i in by])
        place = np.empty(len(own), np.int64)
        place[order] = np.arange(len(own))
        own, every, spelled = own[order], place[every], spelled[order]
        c = np.bincount(every[np.repeat(pdf["learn"].to_numpy(bool), size)], minlength=len(own))
        rows, at = [], 0
        for k, i in by:
            rows.append((0, k, block, own[at:at + len(i)].tobytes(), _pack(c[at:at + len(i)]), *[b""] * 6, 0))
            at += len(i)
        often = np.argsort(-np.bincount(every, minlength=len(own)), kind="stable")
        place[often] = np.arange(len(own))
        flags = sum(bit * pdf[x].to_numpy(bool).astype(np.uint8) for bit, x in ((_KNOWN, "known"), (_HELD, "held_out"), (_LEARN, "learn")))
        rows.append((1, -1, block, b"", b"", _pack(place[every]), _pack(often), _pack(size), pdf["doc_id"].to_numpy(np.int64).tobytes(),
                     flags.astype(np.uint8).tobytes(), spelled.astype(np.float32).tobytes(), int(np.flatnonzero(own == U(END))[0])))
        return pd.DataFrame(rows, columns=_CODED_COLUMNS)

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, held, chars = TaskContext.get().partitionId() << 32, [], 0
        for pdf in frames:
            sizes = [len(t or "") + 1 for t in pdf["text"]]
            for a, b in chunks(sizes, BLOCK_CHARS):
                held.append(pdf.iloc[a:b])
                chars += sum(sizes[a:b])
                if chars >= BLOCK_CHARS:
                    yield block_rows(block, pd.concat(held))
                    block, held, chars = block + 1, [], 0
        if held:
            yield block_rows(block, pd.concat(held))
    return encode


def _number(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """A word bucket. Kind 0: the counts of its words, the frequent first,
    with their sum and the number of words seen in training. Kind 1: for each
    block the positions and counts of the words it sent, in their order."""
    h, which = np.unique(joined(pdf["h"], np.uint64), return_inverse=True)
    c = np.zeros(len(h), np.int64)
    np.add.at(c, which, np.concatenate([_unpack(x) for x in pdf["c"]]))
    order = np.argsort(-c, kind="stable")
    place = np.empty(len(h), np.int64)
    place[order] = np.arange(len(h))
    rows = [(0, int(key[0]), -1, b"", _pack(c[order]), int(c.sum()), int((c > 0).sum()))]
    for block, x in zip(pdf["block"], parts(which, lengths(pdf["h"], 8))):
        rows.append((1, int(key[0]), int(block), _pack(place[x]), _pack(c[x]), 0, 0))
    return pd.DataFrame(rows, columns=["kind", "bucket", "block", "pos", "c", "n", "v"])


_NUMBERED = "kind int, bucket int, block long, pos binary, c binary, n long, v long"


class _Block:
    """A block whose words have their numbers: position in the word bucket
    times the number of buckets, plus the bucket. ``told`` has a row for each
    of its word buckets with (bucket, pos, c)."""

    def __init__(self, pdf: pd.DataFrame, told: pd.DataFrame, n_buckets: int, n: int):
        row = pdf.iloc[0]
        order = {k: i for i, k in enumerate(sorted(told["bucket"]))}
        self.told = sorted(told.itertuples(index=False), key=lambda r: order[r.bucket])
        number = np.concatenate([_unpack(r.pos) * n_buckets + r.bucket for r in self.told])
        rising = np.argsort(number)
        place = np.empty(len(number), np.int64)
        place[rising] = np.arange(len(number))
        self.row, self.size, self.rising, self.number = row, _unpack(row["size"]), rising, number[rising]
        self.count = np.concatenate([_unpack(r.c) for r in self.told])[rising]
        self.every = place[_unpack(row["often"])[_unpack(row["every"])]]
        self.u, self.w, self.which = _pairs(len(number), self.every, int(place[row["end"]]))
        # a context has a part for each eighth of a bucket's share of the tokens
        self.cuts = 1 + 8 * n_buckets * self.count[self.u] // max(n, 1)

    def dealt(self, n_buckets: int):
        return _deal_pairs(self.number[self.u], self.number[self.w], self.cuts, n_buckets)


def _ask(n_buckets: int, n: int):
    """A block's pairs for each pair bucket, with their counts in training
    texts: distinct contexts (u), how many words follow each (n), the words."""
    def ask(pdf: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        b = _Block(pdf, told, n_buckets, n)
        taught = np.repeat((np.frombuffer(b.row["flags"], np.uint8) & _LEARN) > 0, b.size)
        c = np.bincount(b.which[taught], minlength=len(b.u))
        rows = []
        for k, i in b.dealt(n_buckets):
            u, at = b.number[b.u[i]], _runs(b.u[i])
            rows.append((k, int(b.row["block"]), _pack_rising(u[at]), _pack(np.diff(np.r_[at, len(i)])), _pack(b.number[b.w[i]]), _pack(c[i])))
        return pd.DataFrame(rows, columns=["bucket", "block", "u", "n", "w", "c"])
    return ask


_GATHERED = "kind int, bucket int, source long, pos binary, c binary, su binary, sw binary, lu binary, lw binary"
_GATHERED_COLUMNS = [x.split()[0] for x in _GATHERED.split(", ")]


def _gather(n_buckets: int):
    """Sums the counts of a pair bucket (kind 1); kind 3: the positions of
    every block's pairs among its own.

    Kind 4: the cells with more than one customer as positions of their
    context (su) and word (sw). Kind 5: the bucket's words for each word
    bucket: their cells with one customer as context and as dish (su, sw) and
    with more (lu, lw). The positions of kind 4 count the words that have
    cells with more, word bucket after word bucket."""
    def gather(key, pdf: pd.DataFrame) -> pd.DataFrame:
        me = int(key[0])
        asked_u = np.concatenate([np.repeat(_unpack_rising(x), _unpack(n)) for x, n in zip(pdf["u"], pdf["n"])])
        by_block = [_unpack(x) for x in pdf["w"]]
        sizes, asked_w = [len(x) for x in by_block], np.concatenate(by_block)
        order = np.lexsort((asked_w, asked_u))
        u, w = asked_u[order], asked_w[order]
        del asked_u, asked_w, by_block
        new = np.r_[True, (u[1:] != u[:-1]) | (w[1:] != w[:-1])]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        u, w = u[new], w[new]
        del order, new
        c = np.zeros(len(u), np.int64)
        np.add.at(c, which, np.concatenate([_unpack(x) for x in pdf["c"]]))
        rows = [(3, me, int(b), _pack_rising(x), *[b""] * 5) for b, x in zip(pdf["block"], parts(which, sizes))]
        rows.append((1, me, me, b"", _pack(c), *[b""] * 4))
        u, w, c = u[c > 0], w[c > 0], c[c > 0]
        own = np.unique(np.r_[u, w])
        ui, wi, more = np.searchsorted(own, u), np.searchsorted(own, w), c > 1
        used = [np.bincount(i[m], minlength=len(own)) for m in (~more, more) for i in (ui, wi)]
        place, at = np.zeros(len(own), np.int64), 0
        to = own % n_buckets
        by = np.argsort(to, kind="stable")
        for i in np.split(by, _runs(to[by])[1:]) if len(own) else []:
            rows.append((5, int(to[i[0]]), me, _pack_rising(own[i] // n_buckets), b"", *[_pack(x[i]) for x in used]))
            live = i[(used[2][i] + used[3][i]) > 0]
            place[live] = np.arange(at, at + len(live))
            at += len(live)
        rows.append((4, me, me, b"", _pack(c[more]), _pack(place[ui[more]]), _pack(place[wi[more]]), b"", b""))
        return pd.DataFrame(rows, columns=_GATHERED_COLUMNS)
    return gather


_STATE = ("kind int, bucket int, source long, pos binary, su binary, sw binary, t_u binary, served binary, t1 binary, t binary, "
          "served_n long, t1_n long")
_STATE_COLUMNS = [x.split()[0] for x in _STATE.split(", ")]


def _state_row(bucket: int, su, sw, T, served, t1, t: bytes) -> tuple:
    return (0, bucket, -1, b"", *[_pack(x) for x in (su, sw, T, served, t1)], t, int(served.sum()), int(t1.sum()))


def _held(state: pd.DataFrame, column: str) -> np.ndarray:
    return _unpack(state[column].iloc[0]) if len(state) else np.zeros(0, np.int64)


def _open(vocab: pd.DataFrame, came: pd.DataFrame) -> pd.DataFrame:
    """A word bucket before the first sweep (kind 0; one table a cell) and
    the positions that each pair bucket asks for in a sweep (kind 1)."""
    size = len(_held(vocab, "c"))
    total = [np.zeros(size, np.int64) for _ in range(4)]
    bucket = int((vocab if len(vocab) else came)["bucket"].iloc[0])
    rows = []
    for r in came.itertuples(index=False):
        pos = _unpack_rising(r.pos)
        used = [_unpack(x) for x in (r.su, r.sw, r.lu, r.lw)]
        for x, y in zip(total, used):
            x[pos] += y
        live = pos[(used[2] + used[3]) > 0]
        if len(live):
            rows.append((1, bucket, r.source, _pack_rising(live), *[b""] * 6, 0, 0))
    su, sw, lu, lw = total
    rows.append(_state_row(bucket, su, sw, su + lu, sw + lw, np.minimum(sw + lw, 1), b""))
    return pd.DataFrame(rows, columns=_STATE_COLUMNS)


class _Parent:
    """The parent restaurant's predictive probabilities under its totals."""

    def __init__(self, seats: _Seats, served: int, tables: int, even: float):
        self.d, self.denom = seats.d, seats.theta + served
        self.unseen = (seats.theta + seats.d * tables) / self.denom * even

    def of(self, served: np.ndarray, t1: np.ndarray) -> np.ndarray:
        return np.maximum(served - self.d * t1, 0) / self.denom + self.unseen


def _tell(parent: _Parent):
    """Gives the pair buckets their words' tables as context and probability
    as dish."""
    def tell(asks: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        T, p = _held(state, "t_u"), parent.of(_held(state, "served"), _held(state, "t1"))
        rows = []
        for r in asks.itertuples(index=False):
            pos = _unpack_rising(r.pos)
            rows.append((r.source, r.bucket, r.pos, _pack(T[pos]), p[pos].tobytes()))
        return pd.DataFrame(rows, columns=["bucket", "source", "pos", "t_u", "p"])
    return tell


def _seat(seats: _Seats, seed: int, sweep: int):
    """Seats a pair bucket's cells: rows with the tables by context and by
    dish for the word buckets, and one with the tables of the cells."""
    def seat(live: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(live) and len(told):
            told = told.sort_values("source")
            me = int(live["bucket"].iloc[0])
            u, w, c = (_unpack(live[x].iloc[0]) for x in ("su", "sw", "c"))
            T, p = np.concatenate([_unpack(x) for x in told["t_u"]]), joined(told["p"], np.float64)
            t = seats.tables(c, (seats.theta + seats.d * T[u]) * p[w], np.random.default_rng([seed, sweep, me]))
            size = lengths(told["p"], 8)
            by_u, by_w = (parts(np.bincount(i, t, len(T)).astype(np.int64), size) for i in (u, w))
            rows = [(int(k), pos, _pack(a), _pack(b), b"") for k, pos, a, b in zip(told["source"], told["pos"], by_u, by_w)]
            rows.append((me, b"", b"", b"", _pack(t)))
        return pd.DataFrame(rows, columns=["bucket", "pos", "by_u", "by_w", "t"])
    return seat


def _close(root: _Seats, seed: int, sweep: int, new: float):
    """A word bucket after a sweep; the parent's customers are seated again.
    The tables of the pair bucket of the same number ride along."""
    def close(key, sums: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        su, sw = _held(state, "su"), _held(state, "sw")
        T, served, cells = su.copy(), sw.copy(), b""
        for pos, a, b, t in zip(sums["pos"], sums["by_u"], sums["by_w"], sums["t"]):
            if t:
                cells = t
                continue
            at = _unpack_rising(pos)
            T[at] += _unpack(a)
            served[at] += _unpack(b)
        t1 = root.tables(served, np.full(len(served), new), np.random.default_rng([seed, sweep, int(key[0])]))
        return pd.DataFrame([_state_row(int(key[0]), su, sw, T, served, t1, cells)], columns=_STATE_COLUMNS)
    return close


_REPLY = "block long, kind int, bucket int, pos binary, c binary, t_u binary, p binary"
_REPLY_COLUMNS = [x.split()[0] for x in _REPLY.split(", ")]


def _answer_words(parents: list[_Parent]):
    """Tells each block its words' counts and, for each sample, their tables
    as context and (in single precision) probability as dish, in the order
    they were asked. An unseen word has the probability of that outcome."""
    def answer(asked: pd.DataFrame, came: pd.DataFrame) -> pd.DataFrame:
        c = _held(came[came["sample"] < 0], "c")
        states = came[came["sample"] >= 0].sort_values("sample")
        T = [_unpack(x) for x in states["t_u"]]
        p = [np.where(c > 0, q.of(_unpack(s), _unpack(t)), q.unseen) for q, s, t in zip(parents, states["served"], states["t1"])]
        rows = []
        for r in asked.itertuples(index=False):
            pos = _unpack(r.pos)
            rows.append((r.block, 0, r.bucket, r.pos, r.c, _pack(np.concatenate([x[pos] for x in T])),
                         np.concatenate([x[pos] for x in p]).astype(np.float32).tobytes()))
        return pd.DataFrame(rows, columns=_REPLY_COLUMNS)
    return answer


def _answer_pairs(d: float, samples: int):
    """Tells each block its pairs' customers (2 stands for more) and, where
    they are more than one, those less the discounts of their mean tables, in
    the order they were asked."""
    def answer(asked: pd.DataFrame, came: pd.DataFrame) -> pd.DataFrame:
        c = _held(came[came["sample"] < 0], "c")
        left = c.astype(np.float32)
        if (c > 1).any():
            left[c > 1] = c[c > 1] - d * sum(_unpack(t) for t in came.loc[came["sample"] >= 0, "t"]) / samples
        few, rows = np.minimum(c, 2), []
        for r in asked.itertuples(index=False):
            pos = _unpack_rising(r.pos)
            rows.append((r.source, 1, r.bucket, b"", _pack(few[pos]), b"", left[pos[few[pos] > 1]].tobytes()))
        return pd.DataFrame(rows, columns=_REPLY_COLUMNS)
    return answer


def _score(seats: _Seats, n_buckets: int, samples: int, n: int, v: int):
    """Scores a block's texts from the answers. Spellings are added as
    logarithms, so a very long word cannot underflow."""
    def score(pdf: pd.DataFrame, came: pd.DataFrame) -> pd.DataFrame:
        b = _Block(pdf, came[came["kind"] == 0], n_buckets, n)
        pairs = {r.bucket: r for r in came[came["kind"] == 1].itertuples(index=False)}
        T = np.concatenate([_unpack(r.t_u).reshape(samples, -1) for r in b.told], axis=1)[:, b.rising]
        p = np.concatenate([np.frombuffer(r.p, np.float32).reshape(samples, -1) for r in b.told], axis=1)[:, b.rising]
        model = np.zeros(len(b.u))
        for k, i in b.dealt(n_buckets):
            few = _unpack(pairs[k].c)
            left = np.where(few > 0, 1 - seats.d, 0.0)
            left[few > 1] = np.frombuffer(pairs[k].p, np.float32)
            model[i] = left
        for s in range(samples):
            model += (seats.theta + seats.d * T[s, b.u]) * p[s, b.w].astype(np.float64) / samples
        model = np.log10(model / (seats.theta + b.count)[b.u])
        spelled = np.where(b.count > 0, 0.0, np.frombuffer(b.row["spelled"], np.float32)[b.rising])
        base = np.log10((b.count + 1) / (n + v + 1))
        start, flags = np.cumsum(b.size) - b.size, np.frombuffer(b.row["flags"], np.uint8)
        return pd.DataFrame({
            "doc_id": np.frombuffer(b.row["doc_id"], np.int64), "known": (flags & _KNOWN) > 0, "held_out": (flags & _HELD) > 0,
            "n_tokens": b.size, "n_known": np.add.reduceat((b.count[b.every] > 0).astype(np.int64), start),
            "train_tokens": n, "base_score": np.add.reduceat(base[b.every], start), "score": np.add.reduceat(model[b.which], start),
            "open_score": np.add.reduceat(model[b.which] + spelled[b.every], start)})
    return score


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held: int = 2,
                contexts: tuple[float, float] = (0.75, 5.0), parent: tuple[float, float] = (0.5, 5.0),
                burn: int = 2, samples: int = 4, seed: int = 7) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out (crc32 of the id as
    text, modulo ``modulus``, is ``held``; such texts are not learned from),
    n_tokens, n_known, train_tokens, base_score (add-one unigram), score (the
    model's log10 probability of the text), perplexity (of its tokens) and
    open_score (log10 probability with unseen words spelled out).

    ``contexts`` and ``parent``: discount and strength.
    """
    text_batches(docs.sparkSession)
    _, n_bytes = text_bytes(docs, text_col)
    n_buckets = buckets_for(2 * n_bytes)  # of half the usual size: pairs are many
    doc_id = F.col(id_col).cast("long")
    out = F.coalesce(crc_mod(doc_id, modulus) == held, F.lit(False))
    base = docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNotNull().alias("known"), out.alias("held_out"),
                       (doc_id.isNotNull() & ~out).alias("learn"), F.col(text_col).cast("string").alias("text"))
    spelling = _learn_spelling(base.where("learn and text is not null").select("text"))
    coded = stage(base.mapInPandas(_encode(n_buckets, spelling), _CODED), "lm-blocks")
    block = coded.where("kind = 1").select(*_BLOCK).groupBy("block")
    numbered = stage(coded.where("kind = 0").select("bucket", "block", "h", "c").groupBy("bucket").applyInPandas(_number, _NUMBERED), "lm-words")
    vocab, numbers = numbered.where("kind = 0"), numbered.where("kind = 1").select("bucket", "block", "pos", "c")
    n, v = (int(x or 0) for x in vocab.agg(F.sum("n"), F.sum("v")).first())
    pairs = block.cogroup(numbers.groupBy("block")).applyInPandas(
        _ask(n_buckets, n), "bucket int, block long, u binary, n binary, w binary, c binary")
    gathered = stage(pairs.groupBy("bucket").applyInPandas(_gather(n_buckets), _GATHERED), "lm-cells")
    live = gathered.where("kind = 4").select("bucket", "su", "sw", "c")
    opened = stage(vocab.select("bucket", "c").groupBy("bucket").cogroup(
        gathered.where("kind = 5").select("bucket", "source", "pos", "su", "sw", "lu", "lw").groupBy("bucket")).applyInPandas(_open, _STATE), "lm-tables")
    asks = opened.where("kind = 1").select("bucket", "source", "pos")
    state = opened.where("kind = 0")

    ctx, root, even = _Seats(*contexts), _Seats(*parent), 1 / (v + 1)

    def totals(state: DataFrame) -> tuple[int, int]:
        served, t1 = state.agg(F.sum("served_n"), F.sum("t1_n")).first()
        return int(served or 0), int(t1 or 0)
    (served_n, t1_n), kept, parents = totals(state), [], []
    for s in range(1, burn + samples + 1):
        told = (asks.groupBy("bucket").cogroup(state.select("bucket", "t_u", "served", "t1").groupBy("bucket")).applyInPandas(
            _tell(_Parent(root, served_n, t1_n, even)), "bucket int, source long, pos binary, t_u binary, p binary"))
        sums = live.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInPandas(
            _seat(ctx, seed, s), "bucket int, pos binary, by_u binary, by_w binary, t binary")
        new = (root.theta + root.d * t1_n) * even
        state = stage(sums.groupBy("bucket").cogroup(state.select("bucket", "su", "sw").groupBy("bucket")).applyInPandas(
            _close(root, seed + 1, s, new), _STATE), "lm-tables")
        served_n, t1_n = totals(state)
        if s > burn:
            kept.append(state.select("bucket", F.lit(s).alias("sample"), "t_u", "served", "t1", "t"))
            parents.append(_Parent(root, served_n, t1_n, even))

    none, first = F.lit(None).cast("binary"), F.lit(-1).alias("sample")
    known = vocab.select("bucket", first, "c", none.alias("t_u"), none.alias("served"), none.alias("t1"))
    seated = gathered.where("kind = 1").select("bucket", first, "c", none.alias("t"))
    for x in kept:
        known = known.unionByName(x.drop("t"), allowMissingColumns=True)
        seated = seated.unionByName(x.select("bucket", "sample", "t"), allowMissingColumns=True)
    told = (numbers.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInPandas(_answer_words(parents), _REPLY)
            .unionByName(gathered.where("kind = 3").select("bucket", "source", "pos").groupBy("bucket").cogroup(seated.groupBy("bucket"))
                         .applyInPandas(_answer_pairs(ctx.d, samples), _REPLY)))
    scored = block.cogroup(told.groupBy("block")).applyInPandas(
        _score(ctx, n_buckets, samples, n, v),
        "doc_id long, known boolean, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, open_score double")
    return scored.select(F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens",
                         "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"), "open_score")
