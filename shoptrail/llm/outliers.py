"""Quality rules with robust multivariate outliers (operator 6).

Texts that fail a base rule (too few words, mostly repeated words) are out.
The others are compared with texts of their own language and source: a
minimum-covariance-determinant estimate of six transformed statistics (mean
word length, and the shares of symbols, repeated lines, repeated words, upper
case and digits) and the Mahalanobis distance to it.

The estimate is made over all rows by distributed concentration steps: from
medians and median deviations, each step takes the ``support`` share of a
group's rows with the smallest distances (cut on a fine histogram of
distances) and computes their mean and covariance as sums. No group is
gathered anywhere, so a source with a third of all rows is like any other.
Small groups use the estimate of their language, small languages that of all
rows; all three levels are estimated alike.

Most texts have no symbols or repeated lines at all, and a zero variance would
reject any text with one. So the variance of a statistic is for each text at
least that text's own counting error, 1/4 over the units counted (the variance
of an arcsine share): characters for symbols and upper case, words for word
length and for digits (they come as numbers), lines for repeated lines, and
six words for repeats (the least repeat is two runs of three words). One
repeated line among three is thus no outlier, twelve among thirty are.
``cutoff`` is in standard normal quantiles of the distance's chi-square law.

Defined cases: null and wordless texts fail the base rule; null lang and
source are groups of their own; a value that is undefined for a text (no
lines) counts as 0; rows are judged one by one, so repeats agree; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoptrail.llm.tables import stage, text_batches

FEATURES = ["word_length", "symbols", "dup_lines", "repeats", "upper", "digits"]
P = len(FEATURES)
STATS = ("n_words long, word_chars long, n_lines long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         + ", ".join(f"{f} double" for f in FEATURES))
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
_SPACE = [9, 10, 11, 12, 13, 32]
# The characters that the base rule counts as symbols.
_SYMBOLS = [ord(c) for c in "#*$%&|<>"]


# For each of FEATURES what its counting error is counted in, and how many make a unit.
_UNITS = [("n_words", 1), ("word_chars", 1), ("n_lines", 1), ("n_words", 6), ("word_chars", 1), ("n_words", 1)]
_COUNTS = ["n_words", "word_chars", "n_lines"]


def _share(a: int, b: int) -> float:
    """Variance-stabilised share."""
    return float(np.arcsin(np.sqrt(min(1.0, a / b)))) if b else 0.0


def text_stats(text: str | None) -> tuple:
    """The values of ``STATS`` for one whole text."""
    if text is None:
        text = ""
    raw = text.encode("utf-8", "surrogatepass")
    n_by = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    ws = raw.split()
    n = len(ws)
    chars = len(text) - int(n_by[_SPACE].sum())
    symbols = int(n_by[_SYMBOLS].sum())
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    dup = len(lines) - len(set(lines))
    repeated = 0
    if n >= 3:
        tri = list(zip(ws, ws[1:], ws[2:]))
        if len(set(tri)) < len(tri):
            count = Counter(tri)
            covered = bytearray(n)
            for i, t in enumerate(tri):
                if count[t] > 1:
                    covered[i] = covered[i + 1] = covered[i + 2] = 1
            repeated = sum(covered)
    length = float(np.log(chars / n)) if n else 0.0
    return (n, chars, len(lines), symbols, dup, repeated, length, _share(symbols, chars), _share(dup, len(lines)),
            _share(repeated, n), _share(int(n_by[65:91].sum()), chars), _share(int(n_by[48:58].sum()), chars))


def _stats(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in STATS.split(", ")]
    for series in texts:
        yield pd.DataFrame([text_stats(t) for t in series], columns=names)


_stats.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}


def chi_square(p: int, z: float) -> float:
    """The quantile of chi-square with p degrees at a normal quantile
    (Wilson and Hilferty)."""
    return p * (1 - 2 / (9 * p) + z * (2 / (9 * p)) ** 0.5) ** 3


def _consistency(support: float) -> float:
    """Scale that makes a covariance over the inner ``support`` share of
    normal rows estimate the whole one: support / P(chi2(p+2) <= q)."""
    grid = np.linspace(1e-9, 80, 400_001)

    def cdf(p: int) -> np.ndarray:
        density = grid ** (p / 2 - 1) * np.exp(-grid / 2)
        return np.cumsum(density) / density.sum()
    q = np.searchsorted(cdf(P), support)
    return support / cdf(P + 2)[min(q, len(grid) - 1)]


def _estimated(scale: float):
    """Mean and the scaled covariance of a group."""
    def estimate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for r in pdf.itertuples(index=False):
                mean = np.array(r.s) / r.n
                cov = [scale * (v / r.n - mean[i] * mean[j]) for (i, j), v in zip(PAIRS, r.q)]
                rows.append((r.level, r.g1, r.g2, mean.tolist(), [float(v) for v in cov]))
            yield pd.DataFrame(rows, columns=["level", "g1", "g2", "mean", "cov"])
    return estimate


_PARAMS = "level int, g1 string, g2 string, mean array<double>, cov array<double>"
_ROWS = 10_000  # matrices solved at once


def distances(x: np.ndarray, counts: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
    """Squared Mahalanobis distances of the rows of ``x`` to ``mean`` under
    ``cov`` (PAIRS), each variance at least the row's own counting error."""
    full = np.empty((len(x), P, P))
    for k, (i, j) in enumerate(PAIRS):
        full[:, i, j] = full[:, j, i] = cov[:, k]
    for i, (unit, size) in enumerate(_UNITS):
        error = size / (4 * np.maximum(counts[:, _COUNTS.index(unit)], 1))
        full[:, i, i] = np.maximum(full[:, i, i], error) + 1e-9
    dev = x - mean
    return np.maximum(np.einsum("ij,ij->i", dev, np.linalg.solve(full, dev[:, :, None])[:, :, 0]), 0.0)


def _far(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    for mean, cov, *columns in batches:
        out = np.full(len(mean), np.nan)  # rows without an estimate
        known = np.flatnonzero(mean.notna().to_numpy())
        values = np.column_stack([c.to_numpy(float) for c in columns])
        for at in range(0, len(known), _ROWS):
            i = known[at:at + _ROWS]
            out[i] = distances(values[i, :P], values[i, P:], np.stack(mean.iloc[i].to_list()), np.stack(cov.iloc[i].to_list()))
        yield pd.Series(out)


_far.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series]}


def _distance() -> Column:
    """Squared Mahalanobis distance of the feature columns to (mean, cov)."""
    return F.pandas_udf(_far, "double")("mean", "cov", *FEATURES, *_COUNTS)


def _concentrate(rows: DataFrame, params: DataFrame, support: float, scale: float) -> DataFrame:
    """One concentration step: params of the closest ``support`` share."""
    keys = ["level", "g1", "g2"]
    far = rows.join(params, keys).withColumn("bin", F.floor(F.log1p(_distance()) * 50).cast("int"))
    hist = far.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    up = Window.partitionBy(*keys).orderBy("bin")
    cut = (hist.withColumn("upto", F.sum("n").over(up)).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
           .where(F.col("upto") >= F.col("all") * support).groupBy(*keys).agg(F.min("bin").alias("cut")))
    near = far.join(cut, keys).where(F.col("bin") <= F.col("cut"))
    sums = near.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(f) for f in FEATURES]).alias("s"),
        F.array(*[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])) for i, j in PAIRS]).alias("q"))
    return stage(sums.mapInPandas(_estimated(scale), _PARAMS), "mcd")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_words: int = 50, max_repeat_percent: int = 50, support: float = 0.75, steps: int = 3,
          cutoff: float = 4.0, min_group: int = 100) -> DataFrame:
    """One row for each row of ``docs``: doc_id, the base statistics,
    base_failed, kept, distance2 (null if base_failed) and the level of the
    estimate used (0 source, 1 language, 2 all)."""
    text_batches(docs.sparkSession)
    measure = F.pandas_udf(_stats, STATS)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.coalesce(F.concat(F.lit("="), F.col(lang_col).cast("string")), F.lit("null")).alias("g1"),
                      F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null")).alias("g2"))
    bad = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    table = stage(src.withColumn("m", measure("text")).select("doc_id", "g1", "g2", "m.*").withColumn("base_failed", bad), "text-stats")

    good = table.where("not base_failed")
    levels = F.array(F.struct(F.lit(0).alias("level"), F.col("g1"), F.col("g2")),
                     F.struct(F.lit(1).alias("level"), F.col("g1"), F.lit("*").alias("g2")),
                     F.struct(F.lit(2).alias("level"), F.lit("*").alias("g1"), F.lit("*").alias("g2")))
    rows = good.select(*FEATURES, *_COUNTS, F.explode(levels).alias("k")).select("k.*", *FEATURES, *_COUNTS)
    keys = ["level", "g1", "g2"]
    mid = stage(rows.groupBy(*keys).agg(F.array(*[F.percentile_approx(f, 0.5, 1000) for f in FEATURES]).alias("mean"),
                                        F.count(F.lit(1)).alias("n")), "medians")
    big = mid.where((F.col("n") >= min_group) | (F.col("level") == 2)).select(*keys, "mean")
    mad = rows.join(big, keys).groupBy(*keys, "mean").agg(F.array(*[
        F.percentile_approx(F.abs(F.col(f) - F.col("mean")[i]), 0.5, 1000) for i, f in enumerate(FEATURES)]).alias("mad"))
    cov = F.array(*[F.pow(F.col("mad")[i] * 1.4826, 2.0) if i == j else F.lit(0.0) for i, j in PAIRS])
    params = stage(mad.select(*keys, "mean", cov.alias("cov")), "mcd")
    rows = rows.join(params.select(*keys), keys, "left_semi")
    for _ in range(steps):
        params = _concentrate(rows, params, support, _consistency(support))

    def level(n: int, on: list[str]) -> DataFrame:
        p = params.where(F.col("level") == n)
        return p.select(*on, F.struct("mean", "cov").alias(f"p{n}"))
    whole = params.where("level = 2").first()  # one row of 27 numbers
    p2 = F.lit(None)
    if whole is not None:
        p2 = F.struct(F.array(*map(F.lit, whole["mean"])).alias("mean"), F.array(*map(F.lit, whole["cov"])).alias("cov"))
    judged = (table.join(level(0, ["g1", "g2"]), ["g1", "g2"], "left").join(level(1, ["g1"]), "g1", "left")
              .withColumn("p2", p2.cast("struct<mean:array<double>,cov:array<double>>")))
    judged = judged.withColumn("level", F.when(F.col("p0").isNotNull(), 0).when(F.col("p1").isNotNull(), 1).otherwise(2))
    judged = judged.withColumn("p", F.coalesce("p0", "p1", "p2")).withColumn("mean", F.col("p.mean")).withColumn("cov", F.col("p.cov"))
    d2 = F.when(~F.col("base_failed"), _distance())
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & (d2 <= chi_square(P, cutoff))).alias("kept"), d2.alias("distance2"), "level")
