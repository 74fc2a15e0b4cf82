"""Language ID with interpolated Kneser-Ney character models (operator 2).

For each language an n-gram model over letters (lower-cased; any run of other
characters is one space), interpolated Kneser-Ney with one discount an order,
learned from at most ``sample`` distinct labelled texts a language (the
smallest hashes among the eligible ones; whole texts). Models are kept as sorted hash
arrays. For speed the n-grams that any language has seen are also merged into
one sorted array with a row of log-probabilities, one for each language; the
rest goes down the orders one by one.

A text gets the language of the lowest cross-entropy a character (bits). It
is rejected if that exceeds its language's limit for texts as long: on pieces
of calibration texts of that length, the mean plus the larger of ``slack``
times the distance to the 99th percentile and half the way to random letters
with room for one identifier of 40 of them (a key in a short text is no other
language), at most nine tenths of that way. Lengths between those measured are
interpolated. Calibration texts are other labelled texts (at most
``calibration`` a language); languages without any go by all languages'.

The models' size is bounded by the sample; scoring is one pass over all whole
texts, without a shuffle. Neither lang, source nor doc_id is looked at in a
prediction.

Defined cases: null texts and texts without a letter get ``und``, score 0,
not rejected; rows without doc_id are not learned from; rows that repeat a
text are learned from once a language; ties go to the first
language by name; without labelled texts every text is ``und``; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoptrail.llm.tables import crc_mod, narrow, stage, text_batches
from shoptrail.llm.text import U, chunks, mix

ORDER = 5
LENGTHS = (25, 50, 100, 200, 400, 800)  # characters, at which limits are measured
SCORED = "lang_pred string, score double, rejected boolean, cross_entropy double, n_letters long"


def _letters() -> np.ndarray:
    """For each code of the basic plane, whether it is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x10000)], bool)


class _Reader:
    """Texts as codes: letters, single spaces between them, one in front."""

    def __init__(self):
        self.is_letter = _letters()

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(codes of all texts in a row, each text's codes, each text's letters)"""
        joined = "".join(f"\x00{(t or '').lower()}".replace("\x00", " ") for t in texts)
        starts = np.cumsum([0] + [1 + len((t or "").lower()) for t in texts])
        c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        low = c < 0x10000
        letter = np.zeros(len(c), bool)
        letter[low] = self.is_letter[c[low]]
        for i in np.flatnonzero(~low):
            letter[i] = chr(c[i]).isalpha()
        first = np.zeros(len(c) + 1, bool)
        first[starts] = True
        first = first[:-1]
        keep = letter | first | np.r_[False, letter[:-1]]
        codes = np.where(letter, c, np.uint32(32))[keep]
        owner = np.repeat(np.arange(len(texts)), np.diff(starts))
        return (codes, np.bincount(owner[keep], minlength=len(texts)),
                np.bincount(owner[letter], minlength=len(texts)))


def _weight(j: int) -> np.uint64:
    return mix(np.array([j + 1], np.uint64) * U(0x9E3779B97F4A7C15))[0] | U(1)


def grams(codes: np.ndarray, sizes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n codes that end at each position and whether they all lie
    in one text."""
    wide = codes.astype(np.uint64)
    h = np.full(len(codes), n, np.uint64)
    for j in range(n):
        h[j:] += wide[:len(codes) - j] * _weight(j)
    ok = np.ones(len(codes), bool)
    starts = np.cumsum(sizes) - sizes
    for j in range(n - 1):
        ok[np.minimum(starts + j, len(codes) - 1)[sizes > j]] = False
    return mix(h), ok


def _near(codes: np.ndarray, sizes: np.ndarray, at: np.ndarray, order: int) -> list[tuple]:
    """For n = 1..order at the positions ``at`` only: hash of the n-gram that
    ends there, hash of its first n - 1 codes, whether it lies in one text."""
    ends = np.cumsum(sizes)
    room = at - (ends - sizes)[np.searchsorted(ends, at, side="right")]
    x = [codes[np.maximum(at - j, 0)].astype(np.uint64) for j in range(order)]
    whole, tail, out = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64), []
    for n in range(1, order + 1):
        whole = whole + x[n - 1] * _weight(n - 1)
        if n > 1:
            tail = tail + x[n - 1] * _weight(n - 2)
        out.append((mix(whole + U(n)), mix(tail + U(n - 1)), room >= n - 1))
    return out


def _find(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pos = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
    return pos, (keys[pos] == h) if len(keys) else np.zeros(len(h), bool)


def learn(codes: np.ndarray, sizes: np.ndarray, order: int = ORDER) -> list[dict[str, np.ndarray]]:
    """For n = 1..order: sorted n-gram hashes with their discounted ratio, and
    sorted context hashes with the weight that goes to the order below."""
    distinct = []
    for n in range(1, order + 1):
        h, ok = grams(codes, sizes, n)
        at = np.flatnonzero(ok)
        key, first, count = np.unique(h[at], return_index=True, return_counts=True)
        distinct.append((key, at[first], count))
    model = []
    for n in range(1, order + 1):
        key, end, count = distinct[n - 1]
        if n < order:  # how many different characters stand before it
            longer_end = distinct[n][1]
            tails, preceded = np.unique(grams(codes, sizes, n)[0][longer_end], return_counts=True)
            pos, ok = _find(tails, key)
            count = np.where(ok, preceded[pos], 1)
        ones, twos = (count == 1).sum(), (count == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        ctx = grams(codes, sizes, n - 1)[0][end - 1] if n > 1 else np.zeros(len(end), np.uint64)
        if n > 1:
            ctx[end == 0] = U(0)
        contexts, which, kinds = np.unique(ctx, return_inverse=True, return_counts=True)
        total = np.bincount(which, weights=count)
        model.append({"key": key, "ratio": (count - discount) / total[which], "end": end,
                      "ctx": contexts, "below": discount * kinds / total})
    return model


def probabilities(model: list[dict], near: list[tuple], base: float) -> np.ndarray:
    """Of the code at each position of ``near``, given the codes before it."""
    p = base
    for n, (level, (h, ctx, ok)) in enumerate(zip(model, near), start=1):
        if n > 1:
            pos, seen = _find(level["ctx"], ctx)
            known, below = ok & seen, level["below"][pos]
        else:
            known, below = ok, level["below"][0] if len(level["below"]) else 1.0
        pos, seen = _find(level["key"], h)
        p = np.where(known, np.where(seen, level["ratio"][pos], 0.0) + below * p, p)
    return p


def _train(order: int):
    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        codes, sizes, _ = _Reader()(pdf["text"].tolist())
        model = learn(codes, sizes, order)
        end = model[-1]["end"]
        context = np.stack([codes[end - order + 1 + j] for j in range(order)], axis=1) if len(end) else np.empty((0, order), np.uint32)
        pack = {"alphabet": np.unique(codes).tobytes(), "top": context.astype(np.uint32).tobytes()}
        rows = [(pdf["lang"].iloc[0], 0, pack["alphabet"], pack["top"], b"", b"")]
        rows += [(pdf["lang"].iloc[0], n, m["key"].tobytes(), m["ratio"].tobytes(), m["ctx"].tobytes(), m["below"].tobytes())
                 for n, m in enumerate(model, start=1)]
        return pd.DataFrame(rows, columns=["lang", "n", "a", "b", "c", "d"])
    return train


class Models:
    """The languages' models and the merged array of their top n-grams."""

    def __init__(self, rows: list, order: int = ORDER):
        self.order = order
        self.langs = sorted({r["lang"] for r in rows})
        by = {(r["lang"], r["n"]): r for r in rows}
        alphabet = set()
        tops = []
        self.models = []
        for lang in self.langs:
            alphabet.update(np.frombuffer(by[lang, 0]["a"], np.uint32).tolist())
            tops.append(np.frombuffer(by[lang, 0]["b"], np.uint32).reshape(-1, order))
            self.models.append([{"key": np.frombuffer(r["a"], np.uint64), "ratio": np.frombuffer(r["b"], np.float64),
                                 "ctx": np.frombuffer(r["c"], np.uint64), "below": np.frombuffer(r["d"], np.float64)}
                                for r in (by[lang, n] for n in range(1, order + 1))])
        self.base = 1.0 / (len(alphabet) + 1)
        top = np.concatenate(tops) if tops else np.empty((0, order), np.uint32)
        flat, sizes = top.ravel(), np.full(len(top), order, np.int64)
        last = np.arange(len(top)) * order + order - 1
        h = grams(flat, sizes, order)[0][last] if len(top) else np.empty(0, np.uint64)
        self.key, first = np.unique(h, return_index=True)
        near = _near(flat, sizes, last[first], order) if len(top) else []
        self.log = np.stack([np.log2(probabilities(m, near, self.base)).astype(np.float32) for m in self.models],
                            axis=1) if len(top) else np.empty((0, len(self.langs)), np.float32)
        self.random_bits = float(-np.log2(self.base))

    def entropies(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """(texts, languages): bits a character, the space in front aside."""
        h, ok = grams(codes, sizes, self.order)
        pos, seen = _find(self.key, h)
        seen &= ok
        bits = self.log[pos] if len(self.log) else np.zeros((len(codes), len(self.langs)), np.float32)
        bits[~seen] = 0
        starts = np.cumsum(sizes) - sizes
        front = np.zeros(len(codes), bool)
        front[starts] = True
        rest = np.flatnonzero(~seen & ~front)
        if len(rest):
            near = _near(codes, sizes, rest, self.order)
            for i, m in enumerate(self.models):
                bits[rest, i] = np.log2(probabilities(m, near, self.base))
        total = np.add.reduceat(bits, starts, axis=0, dtype=np.float64) if len(starts) else np.empty((0, len(self.langs)))
        return -total / np.maximum(sizes - 1, 1)[:, None]


def _score(models: Models, limits: dict[str | None, list[float]] | None, evidence: int):
    def score(texts: pd.Series) -> pd.DataFrame:
        read = _Reader()
        out = []
        rows = texts.tolist()
        for a, b in chunks([len(t or "") for t in rows], 400_000):
            codes, sizes, letters = read(rows[a:b])
            bits = models.entropies(codes, sizes)
            best = bits.argmin(axis=1) if models.langs else np.zeros(b - a, np.int64)
            for i in range(b - a):
                if letters[i] == 0 or not models.langs:
                    out.append(("und", 0.0, False, None, int(letters[i])))
                    continue
                x, lang = bits[i], models.langs[best[i]]
                n = min(int(sizes[i]) - 1, evidence)
                p = 1.0 / float(np.exp2(np.minimum((x[best[i]] - x) * n, 0.0)).sum())
                of_lang = limits.get(lang, limits[None]) if limits else [np.inf] * len(LENGTHS)
                limit = np.interp(np.log2(max(1, int(sizes[i]) - 1)), np.log2(LENGTHS), of_lang)
                out.append((lang, p, bool(x[best[i]] > limit), float(x[best[i]]), int(letters[i])))
        return pd.DataFrame(out, columns=["lang_pred", "score", "rejected", "cross_entropy", "n_letters"])
    return score


def predictor(models: Models, limits: dict[str | None, list[float]] | None = None, evidence: int = 40):
    """A column function: text -> struct of ``SCORED``. ``score`` is the
    posterior of the language under equal priors, counting at most
    ``evidence`` characters."""
    fn = _score(models, limits, evidence)

    def predict(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in series:
            yield fn(s)
    predict.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(predict, SCORED)


def held_out(id_col: Column, modulus: int = 4, held: int = 2) -> Column:
    return F.coalesce(crc_mod(id_col.cast("long"), modulus) == held, F.lit(False))


def _smallest_hashes(ids: DataFrame, n: int) -> DataFrame:
    """(doc_id, lang, place) of the ``n`` rows with the smallest id hashes of
    each language. Only hashes under a bound, set by the language's count for
    about 2n + 200 rows, go on to the ranking: what a task ranks does not grow
    with the input. With distinct ids fewer than n under it would be over 20
    deviations off."""
    counts = narrow(stage(ids.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")), "lid-counts"))
    share = (F.xxhash64("doc_id").cast("double") + 2.0 ** 63) / 2.0 ** 64
    near = ids.join(counts, "lang").where(share * F.col("_n") <= 2 * n + 200).drop("_n")
    pick = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    return near.withColumn("place", F.row_number().over(pick)).where(F.col("place") <= n)


def _sample(able: DataFrame, n: int) -> DataFrame:
    """(lang, text, place) of ``n`` distinct texts of each language, those
    with the smallest hashes, however often a text is repeated."""
    keyed = able.select("lang", "text", F.xxhash64("text").alias("doc_id"))
    distinct = stage(keyed.select("doc_id", "lang").distinct(), "lid-texts")
    ids = stage(_smallest_hashes(distinct, n), "lid-places")
    return keyed.join(narrow(ids), ["lang", "doc_id"]).groupBy("lang", "place").agg(F.min("text").alias("text"))


def _limits(texts: DataFrame, plain: Column, random_bits: float, slack: float) -> dict[str | None, list[float]]:
    """The cross-entropy up to which a text of each length of ``LENGTHS``
    passes, by predicted language; under None that of all languages together.
    Measured on pieces of ``texts`` of those lengths: the mean and ``slack``
    times the way to the 99th percentile, at least half the way to ``random_bits``
    and what 40 random letters add, at most nine tenths of that way."""
    pieces = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.substring("text", 1 + i * n, n).alias("piece"))
                                 for n in LENGTHS for i in range(4)]))
    cut = texts.select(pieces.alias("p")).select("p.*").where(F.length("piece") == F.col("n"))
    tested = cut.select("n", plain.alias("p")).where("p.cross_entropy is not null").select("n", "p.lang_pred", "p.cross_entropy")
    mean, far = F.avg("cross_entropy").alias("mean"), F.percentile("cross_entropy", 0.99).alias("far")
    rows = tested.rollup("n", "lang_pred").agg(mean, far).where("n is not null").collect()

    def limit(r):
        way = random_bits - r["mean"]
        return r["mean"] + min(max(slack * (r["far"] - r["mean"]), (0.5 + 20 / r["n"]) * way), 0.9 * way)
    found = {(r["lang_pred"], r["n"]): limit(r) for r in rows}
    out = {}
    for lang in {lang for lang, _ in found} | {None}:
        last, out[lang] = random_bits, []
        for n in LENGTHS:  # a length without pieces: as all languages, else as the length before
            last = found.get((lang, n), found.get((None, n), last))
            out[lang].append(last)
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 400,
        calibration: int = 200, order: int = ORDER, slack: float = 3.0, modulus: int = 4, held: int = 2):
    """Learns the models and their limits from labelled, not held-out rows and
    returns the predictor. Of a language's sampled texts every
    (``sample`` / ``calibration`` + 1)th is kept out of training and sets the limits."""
    text_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.col(lang_col).cast("string").alias("lang"))
    able = src.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), modulus, held) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    chosen = stage(_sample(able, sample + calibration), "lid-sample")
    kept_out = F.pmod(F.col("place"), F.lit(sample // calibration + 1)) == 0
    rows = (chosen.where(~kept_out).groupBy("lang")
            .applyInPandas(_train(order), "lang string, n int, a binary, b binary, c binary, d binary").collect())
    models = Models(rows, order)
    return predictor(models, _limits(chosen.where(kept_out), predictor(models)("piece"), models.random_bits, slack))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, lang_pred, score,
    rejected, cross_entropy, n_letters."""
    predict = fit(docs, id_col, text_col, lang_col, **options)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).select(
        "doc_id", held_out(F.col("doc_id"), options.get("modulus", 4), options.get("held", 2)).alias("held_out"),
        predict("text").alias("p")).select("doc_id", "held_out", "p.*")
