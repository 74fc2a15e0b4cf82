"""N-gram Jaccard join (operator 13) by partitioning the universe of shingles.

Sets are banded by size so that a set's partners lie in its own band or the
one below. Band k has ``m = H + 1`` segments, H being the largest symmetric
difference that the similarity allows its sets; a hash deals every shingle to
a segment. Two similar sets differ by at most H shingles, so by the pigeonhole

    sum over segments of (v_i + 1) >= H + 1  =>  some segment differs by at most v_i

for any v_i in {-1 skipped, 0 equal, 1 one deletion apart}. Every set is indexed
in its band by the hash of each segment's subset, and in the first ``q``
segments by its one-deletion neighbourhood too; it looks its segments up in
its own band and in the one below.

1. Equal sets are one class, stood for by the smallest doc_id. All sets start
   with v = 0. Members that share a quarter of their segments with a pivot of
   those (the smallest holder; of a hot subset the one with most hot subsets)
   are confirmed first; groups of copies end here, with as many pairs as
   members.
2. Only subsets that then lie in several groups cost anything: as much as sets
   hold them. The allocation skips a set's costliest ones, as many as its own
   size allows a smaller difference than its band does. What is left is looked
   up across groups; but subsets that more than ``hot`` sets hold are skipped
   as well, each paid for with one of the first q segments raised to v = 1:
   its deletions look up equal subsets, its subset looks up deletions.
3. What no allocation can skip (more hot subsets than segments to raise), or
   what raises a hot neighbourhood, goes to the prefix bounds of
   ``near_dedup._rare``: no hot subset is paired whole, and none is cut.
4. A candidate is confirmed by its number of equal segments and, across groups,
   by the parities of its shingles in hash cells (exact bounds on the
   difference), then on the full sets. Links give the components.

Defined cases: null or wordless texts have an empty set and link with nothing;
rows without doc_id likewise (their component is null); rows that share a
doc_id and differ in text are one document, linked by the set of least hash
among them; each row is returned. An empty table gives an empty result. Other
columns are not looked at.
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
from shoptrail.llm.near_dedup import _rare
from shoptrail.llm.tables import narrow, stage, text_batches
from shoptrail.llm.text import U, WordHashes, chunks, mix, shingle_set, signed, words

LEAST_RAISED = 3  # shingles in a segment that is raised: its deletions hold two


_KNOWN: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def bands(percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(smallest size, largest size) of each band; worked out once a task."""
    if percent not in _KNOWN:
        low, high = [], []
        size = 1
        while size < 2_000_000_000:
            low.append(size)
            high.append(size * 100 // percent)
            size = high[-1] + 1
        _KNOWN[percent] = np.array(low), np.array(high)
    return _KNOWN[percent]


def segments(percent: int, band: int) -> int:
    """H + 1 of a band."""
    return int(bands(percent)[1][band]) * (100 - percent) // percent + 1


def raisable(m: int) -> int:
    """How many of m segments have a neighbourhood index."""
    return min(m, 2 + -(-m // 16))


def keys(sets: list[np.ndarray], band: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each set in a band: the keys of its segments, the keys of the one-
    deletion neighbourhood of the first q, and the sizes of those."""
    for s, b in zip(sets, band):
        if b < 0 or not len(s):
            yield (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),)
            continue
        m = segments(percent, int(b))
        code = mix(s ^ U(0xA5A5A5A5DEADBEEF))
        seg = (((mix(s + U(0x51ED27)) >> U(32)) * U(m)) >> U(32)).astype(np.int64)
        sums = np.zeros(m, np.uint64)
        np.add.at(sums, seg, code)
        tag = mix((U(int(b)) << U(32)) + np.arange(m, dtype=np.uint64))
        q = raisable(m)
        first = np.flatnonzero(seg < q)
        first = first[np.argsort(seg[first], kind="stable")]
        at = seg[first]
        yield mix(sums + tag), mix(sums[at] - code[first] + tag[at]), np.bincount(at, minlength=q)


def sketch(s: np.ndarray) -> np.ndarray:
    """The parities of how many shingles fall into each of at least four hash
    cells a shingle, a power of two of words. A shingle that one of two sets
    has turns one cell, so as many cells differ as shingles at the most; the
    words of a wider sketch fold onto those of a narrower one."""
    cells = 64
    while cells < 4 * len(s):
        cells *= 2
    at = (mix(s + U(0x3C6EF372)) & U(cells - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=cells) & 1).astype(np.uint8), bitorder="little").view(np.uint64)


def _sets(texts: list[str | None], wh: WordHashes, k: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    for a, b in chunks([len(t or "") for t in texts], 300_000):
        yield a, b, [shingle_set(wh.of(words(t, lower=True)), k) for t in texts[a:b]]


def _places(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Each set's own band, and the one below if a partner can lie there."""
    low, high = bands(percent)
    n = np.array([len(s) for s in sets], np.int64)
    own = np.searchsorted(low, n, side="right") - 1
    below = own - 1
    below[(below < 0) | (-(-n * percent // 100) > high[np.maximum(below, 0)])] = -1
    return own, below


def _slack(n: np.ndarray, where: np.ndarray, own: np.ndarray, percent: int) -> np.ndarray:
    """Segments of that band that a set of size n may skip for nothing: its
    own size may allow a smaller difference than the band does."""
    _, high = bands(percent)
    top = high[np.maximum(where, 0)]
    partner = np.where(where == own, np.minimum(top, n * 100 // percent), top)
    return top * (100 - percent) // percent - (n + partner) * (100 - percent) // (100 + percent)


def _signer(k: int, percent: int):
    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wh = WordHashes()
        for pdf in frames:
            for a, b, sets in _sets(pdf["text"].tolist(), wh, k):
                part = pdf.iloc[a:b]
                n = np.array([len(s) for s in sets], np.int64)
                own, below = _places(sets, percent)
                made = list(keys(sets, own, percent))
                yield pd.DataFrame({
                    "doc": part["doc"].to_numpy(), "th": part["th"].to_numpy(), "n": n, "m": [len(x[0]) for x in made],
                    "class": [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets],
                    "own_slack": _slack(n, own, own, percent), "low_slack": _slack(n, below, own, percent),
                    "own": [signed(x[0]) for x in made], "low": [signed(x[0]) for x in keys(sets, below, percent)],
                    "near": [signed(x[1][np.repeat(x[2] > LEAST_RAISED, x[2])]) for x in made]})
    return sign


SIGNED = ("doc string, th long, n long, m int, class string, own_slack long, low_slack long, own array<long>, low array<long>, "
          "near array<long>")


def _allocator(k: int, percent: int):
    """A set with the hot keys, hottest first, of its own band and of the one
    below that its slack does not cover. Gives the raised look-ups (kind A: a
    deletion for equal subsets, B: the subset for deletions) and the hot keys
    that stay (kind H)."""
    def allocate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wh = WordHashes()
        for pdf in frames:
            for a, b, sets in _sets(pdf["text"].tolist(), wh, k):
                out = []
                for where, column in zip(_places(sets, percent), ("hot_own", "hot_low")):
                    probe = column == "hot_low"
                    part = zip(pdf["doc"].iloc[a:b], pdf[column].iloc[a:b], pdf[column.replace("hot", "covered")].iloc[a:b],
                               keys(sets, where, percent))
                    for doc, hot, covered, (full, dels, sizes) in part:
                        if hot is None or not len(hot):
                            continue
                        full, dels = signed(full), signed(dels)
                        skipped, ends = {int(h) for h in hot}, np.cumsum(sizes)
                        hot = [int(h) for h in hot[int(covered):]]
                        free = [i for i in range(len(sizes)) if int(full[i]) not in skipped and sizes[i] >= LEAST_RAISED]
                        for i in free[:len(hot)]:
                            out.append((int(full[i]), doc, probe, "B"))
                            out.extend((int(x), doc, probe, "A") for x in dels[ends[i] - sizes[i]:ends[i]])
                        out.extend((h, doc, probe, "H") for h in hot[len(free):])
                yield pd.DataFrame(out, columns=["key", "doc", "probe", "kind"])
    return allocate


def _setter(k: int):
    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wh = WordHashes()
        for pdf in frames:
            for a, b, sets in _sets(pdf["text"].tolist(), wh, k):
                yield pd.DataFrame({"doc_id": pdf["doc"].iloc[a:b].to_numpy(), "shingles": [signed(s) for s in sets],
                                    "sketch": [signed(sketch(s)) for s in sets]})
    return emit


SETS = "doc_id long, shingles array<long>, sketch array<long>"


def _sized(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Adds both sizes and the smaller set's segments, where sizes fit."""
    u = reps.select(F.col("doc").alias("u"), F.col("n").alias("nu"), F.col("m").alias("mu"))
    v = reps.select(F.col("doc").alias("v"), F.col("n").alias("nv"), F.col("m").alias("mv"))
    return (pairs.join(u, "u").join(v, "v").where(100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv"))
            .withColumn("m", F.least("mu", "mv")))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("su"))
    b = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("sv"))
    met = F.size(F.array_intersect("su", "sv"))
    return (pairs.join(a, "u").join(b, "v").select("u", "v", met.alias("met"), (F.size("su") + F.size("sv")).alias("total"))
            .where(100 * F.col("met") >= percent * (F.col("total") - F.col("met"))).select("u", "v"))


def _differ(x: str, y: str):
    """Cells in which two sketches differ; 0 where one is over twice as wide."""
    width = F.least(F.size(x), F.size(y))

    def xor(p, q):
        return p.bitwiseXOR(q)

    def folded(c: str):
        return F.when(F.size(c) > width, F.zip_with(F.slice(c, F.lit(1), width), F.slice(c, width + 1, width), xor)).otherwise(F.col(c))
    turned = F.zip_with(folded(x), folded(y), lambda p, q: F.bit_count(xor(p, q)))
    return F.when(F.greatest(F.size(x), F.size(y)) <= 2 * width, F.aggregate(turned, F.lit(0), lambda t, c: t + c)).otherwise(0)


def _close(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches allow the similarity (an exact bound): a pair
    sends a sketch, a sixteenth of its set, and only what is left the set."""
    a = sets.select(F.col("doc_id").alias("u"), F.size("shingles").alias("nu"), F.col("sketch").alias("ku"))
    b = sets.select(F.col("doc_id").alias("v"), F.size("shingles").alias("nv"), F.col("sketch").alias("kv"))
    return (pairs.join(a, "u").join(b, "v").where((100 + percent) * _differ("ku", "kv") <= (100 - percent) * (F.col("nu") + F.col("nv")))
            .select("u", "v"))


def _pair(a: str, b: str):
    return F.least(a, b).alias("u"), F.greatest(a, b).alias("v")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, k: int = 5,
                 hot: int = 64) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id
    (smallest doc_id reachable over links of Jaccard >= percent/100)."""
    text_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"),
                      F.xxhash64(F.col(text_col).cast("string")).alias("th"))
    table = (src.withColumn("doc", F.col("doc").cast("string"))  # pandas would make nullable longs floats
             .mapInPandas(_signer(k, percent), SIGNED))
    table = stage(table.withColumn("doc", F.col("doc").cast("long")), "sets")
    usable = table.where("n > 0 and doc is not null")
    kept = ["th", "n", "m", "own_slack", "low_slack"]
    main = stage(usable.groupBy("doc").agg(F.min(F.struct("class", *kept)).alias("a")).select("doc", "a.*"), "documents")
    reps = stage(main.groupBy("class").agg(F.min(F.struct("doc", *kept)).alias("a")).select("class", "a.*"), "classes")
    texts = src.join(narrow(reps.select("doc", "th")), ["doc", "th"], "left_semi").select("doc", "text")
    index = table.join(narrow(reps.select("doc", "th")), ["doc", "th"], "left_semi")

    same = Window.partitionBy("key")
    rows = (index.select("doc", F.explode("own").alias("key"), F.lit(False).alias("probe"))
            .unionByName(index.select("doc", F.explode("low").alias("key"), F.lit(True).alias("probe"))))
    members = (rows.withColumn("size", F.count(F.lit(1)).over(same)).withColumn("pivot", F.min(F.when(~F.col("probe"), F.col("doc"))).over(same))
               .where("size > 1 and pivot is not null"))
    members = stage(members, "segments")

    def sets_of(pairs: DataFrame, name: str) -> DataFrame:
        ids = stage(pairs.select(F.col("u").alias("doc")).unionByName(pairs.select(F.col("v").alias("doc"))).distinct(), f"{name}-ids")
        made = texts.join(narrow(ids), "doc", "left_semi").mapInPandas(_setter(k), SETS)
        return stage(made.dropDuplicates(["doc_id"]), f"{name}-sets")

    # of a hot subset the pivot is the set with most hot subsets: edits that only few copies have are far from it
    warm = members.where(F.col("size") > hot)
    holders = warm.where("not probe")
    central = holders.groupBy("doc").agg(F.count(F.lit(1)).alias("shared"))
    best = holders.join(central, "doc").groupBy("key").agg(F.max_by("doc", F.struct("shared", -F.col("doc"))).alias("pivot"))
    star = (members.where(F.col("size") <= hot).select("doc", "pivot")
            .unionByName(warm.drop("pivot").join(best, "key").select("doc", "pivot")).where("doc <> pivot")
            .groupBy(*_pair("doc", "pivot")).agg(F.count(F.lit(1)).alias("equal")))
    star = stage(_sized(star, reps, percent).where("4 * equal >= m").select("u", "v"), "star")
    links = stage(_confirmed(star, sets_of(star, "star"), percent), "links")
    groups = components(links)

    labelled = members.join(groups, members["doc"] == groups["node"], "left").select(
        "key", "doc", "probe", "size", F.coalesce("component", "doc").alias("group"))
    mixed = labelled.groupBy("key").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo < hi").select("key")
    left = stage(labelled.join(mixed, "key", "left_semi"), "mixed")
    cheapest = Window.partitionBy("doc", "probe")
    slack = F.greatest(F.lit(0), F.when(F.col("probe"), F.col("low_slack")).otherwise(F.col("own_slack")))
    asked = (left.join(reps.select("doc", "own_slack", "low_slack"), "doc").withColumn("slack", slack)
             .withColumn("place", F.row_number().over(cheapest.orderBy(F.desc("size"), F.desc("key"))))
             .withColumn("skipped", F.greatest(F.least("slack", F.count(F.lit(1)).over(cheapest)), F.count_if(F.col("size") > hot).over(cheapest)))
             .where("place > slack"))
    asked = stage(asked.select("key", "doc", "probe", "size", "group", "skipped", "slack"), "asked")
    few, many = asked.where(F.col("size") <= hot), asked.where(F.col("size") > hot)
    a = few.select("key", F.col("doc").alias("a"), F.col("group").alias("ga"), "skipped")
    b = left.where(F.col("size") <= hot).where("not probe").select("key", F.col("doc").alias("b"), F.col("group").alias("gb"))
    met = (a.join(b, "key").where("ga <> gb").groupBy("a", "b").agg(F.count(F.lit(1)).alias("equal"), F.max("skipped").alias("skipped"))
           .select(*_pair("a", "b"), "equal", "skipped"))
    most = F.floor((100 - percent) * (F.col("nu") + F.col("nv")) / (100 + percent))
    cross = _sized(met, reps, percent).where(F.col("equal") + F.col("skipped") >= F.col("m") - most).select("u", "v")
    if many.limit(1).count():
        cross = cross.unionByName(_raised(texts, index, reps, left, many, groups, percent, k, hot))
    cross = stage(cross.distinct().join(star, ["u", "v"], "left_anti"), "cross")
    whole = sets_of(cross, "cross")
    close = stage(_close(cross, whole, percent), "close")
    final = components(links.unionByName(_confirmed(close, whole, percent)))

    found = (table.select("doc", "n").join(main.select("doc", "class"), "doc", "left").join(reps.select("class", F.col("doc").alias("rep")), "class", "left")
             .join(final, F.col("rep") == F.col("node"), "left"))
    return found.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc").alias("component_id"))


def _raised(texts: DataFrame, index: DataFrame, reps: DataFrame, left: DataFrame, many: DataFrame, groups: DataFrame, percent: int,
            k: int, hot: int) -> DataFrame:
    """Pairs across groups that hot segments would bring: by raised segments,
    or by the prefix bounds where these do not suffice."""
    order = F.sort_array(F.collect_set(F.struct(F.col("size").alias("size"), F.col("key").alias("key"))), asc=False)["key"]
    hottest = left.where(F.col("size") > hot).join(many.select("doc").distinct(), "doc", "left_semi")  # what is skipped too must not be raised
    sides = hottest.groupBy("doc", "probe").agg(order.alias("hot")).join(
        many.groupBy("doc", "probe").agg(F.first("slack").alias("covered")), ["doc", "probe"])

    def side(column: str, probe: bool):
        return F.first(F.when(F.col("probe") == probe, F.col(column)), ignorenulls=True)
    costly = stage(sides.groupBy("doc").agg(
        side("hot", False).alias("hot_own"), F.coalesce(side("covered", False), F.lit(0)).alias("covered_own"),
        side("hot", True).alias("hot_low"), F.coalesce(side("covered", True), F.lit(0)).alias("covered_low")), "costly")
    raised = stage(texts.join(costly, "doc").mapInPandas(_allocator(k, percent), "key long, doc long, probe boolean, kind string").distinct(), "raised")

    def labelled(df: DataFrame) -> DataFrame:
        return df.join(groups, df["doc"] == groups["node"], "left").select(*df.columns, F.coalesce("component", "doc").alias("group"))
    asked = narrow(raised.where("kind <> 'H'").select("key", "kind").distinct())
    first = F.slice("own", 1, F.least(F.col("m"), 2 + F.ceil(F.col("m") / 16).cast("int")))  # as in raisable
    looked = (index.select("doc", F.explode(first).alias("key"), F.lit("A").alias("kind"))
              .unionByName(index.select("doc", F.explode("near").alias("key"), F.lit("B").alias("kind"))))
    hits = stage(labelled(looked.join(asked, ["key", "kind"], "left_semi").distinct()), "hits")
    sizes = hits.groupBy("key", "kind").agg(F.count(F.lit(1)).alias("size"))
    askers = labelled(raised).select("key", "kind", "probe", F.col("doc").alias("asker"), F.col("group").alias("own")).join(sizes, ["key", "kind"])
    near = (askers.where(F.col("size") <= hot).join(hits, ["key", "kind"]).where(F.col("own") != F.col("group"))
            .select(*_pair("asker", "doc")).distinct())
    near = _sized(near, reps, percent).select("u", "v")

    # A pair of one band is looked up from both sides, so it is open only if both sets could not be allocated; a pair
    # of two bands is looked up by the larger set alone, so all holders of what that could not skip stay in.
    crowded = askers.where(F.col("size") > hot).select("key", "kind", "probe", F.col("asker").alias("doc"))
    stuck = raised.where("kind = 'H'").select("key", "kind", "probe", "doc").unionByName(crowded)
    held = left.where("not probe").join(stuck.where("probe and kind = 'H'").select("key").distinct(), "key", "left_semi").select("doc")
    met = hits.join(crowded.where("probe").select("key", "kind").distinct(), ["key", "kind"], "left_semi").select("doc")
    ids = stuck.select("doc").unionByName(held).unionByName(met).distinct()
    ids = stage(labelled(ids), "crowded")
    if not ids.limit(1).count():
        return near
    rest = ids.join(reps.select("doc", "n"), "doc").select(F.col("doc").alias("doc_id"), "n", "group")
    made = texts.join(ids.select("doc"), "doc", "left_semi").mapInPandas(_setter(k), SETS)
    return near.unionByName(_rare(rest, stage(made.dropDuplicates(["doc_id"]), "crowded-sets"), percent))
