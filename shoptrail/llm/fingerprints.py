"""Document fingerprints by a threshold-scaled sketch (operator 4).

A text's words are hashed (xxhash64) and every five-word shingle of word
hashes again; the sketch keeps each distinct shingle hash below a fixed
fraction ``1/scale`` of the hash range, and in any case the least one, so a
text with words never has an empty sketch. Sketches merge: the sketch of a
union is the union of the sketches, cut the same way. Two texts are compared
by the containment of the smaller sketch in the other, which stays meaningful
for texts of very unequal length.

Built-in functions only; nothing leaves the JVM.

``with_neighbour`` puts beside each row the next one in descending doc_id
order (after the last: the first). Rows are dealt into ranges of ids of equal
width, at most ``MAX_RANGES``; each range also gets a copy of the first row
of the next non-empty range, so no window spans more than a range.

Defined cases: null texts count as empty; texts without words have an empty
sketch, equal to each other (likeness 1) and unlike any other (0); with fewer
than five words the whole sequence is the one shingle; rows without doc_id
come last, in an order of their text's hash; rows that repeat a doc_id follow
each other; a single row is its own neighbour; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoptrail.llm.tables import WORD

MAX_RANGES = 20_000
RANGE_ROWS = 256


def with_sketch(df: DataFrame, text_col: str, out: str, k: int = 5, scale: int = 8) -> DataFrame:
    """Adds the sketch (sorted array of longs) of a text column."""
    below = -(1 << 63) + (1 << 64) // scale
    df = df.withColumn("_words", F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), F.lit(0)))
    df = df.withColumn("_wh", F.transform("_words", lambda w: F.xxhash64(w)))
    shingle = F.transform(F.sequence(F.lit(1), F.size("_wh") - (k - 1)),
                          lambda i: F.xxhash64(*[F.element_at(F.col("_wh"), i + j) for j in range(k)]))
    whole = F.array(F.xxhash64(F.lit("short"), F.col("_wh")))
    df = df.withColumn("_all", F.when(F.size("_wh") >= k, shingle).when(F.size("_wh") > 0, whole)
                       .otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_low", F.filter("_all", lambda h: h < F.lit(below)))
    least = F.when(F.size("_all") > 0, F.array(F.array_min("_all"))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(out, F.array_sort(F.array_distinct(F.when(F.size("_low") > 0, F.col("_low")).otherwise(least)))).drop(
        "_words", "_wh", "_all", "_low")


def likeness(a: Column | str, b: Column | str) -> Column:
    """Estimated containment of the smaller of two sketches in the other."""
    least = F.least(F.size(a), F.size(b))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when(least == 0, F.lit(0.0))
            .otherwise(F.size(F.array_intersect(a, b)) / least))


def as_text(sketch: Column | str) -> Column:
    """A sketch as text: 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def _ranges(docs: DataFrame) -> tuple[Column, int]:
    """The range of a row's id; ranges without an id lie below 0."""
    lo, hi, rows = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    n = min(MAX_RANGES, max(1, rows // RANGE_ROWS))
    none = -1 - F.pmod(F.xxhash64("text"), F.lit(n))
    if lo is None:
        return none.cast("long"), n
    width = -(-(hi - lo + 1) // n)
    big = "decimal(38,0)"
    at = F.floor((F.col("doc_id").cast(big) - F.lit(lo).cast(big)) / F.lit(width).cast(big)).cast("long")
    return F.when(F.col("doc_id").isNotNull(), at).otherwise(none).cast("long"), n


def with_neighbour(docs: DataFrame, prepare) -> DataFrame:
    """(doc_id, text, ...) with the next row's columns as ``next_...``.
    ``prepare`` adds columns to (doc_id, text) that the neighbour is asked
    for too."""
    at, _ = _ranges(docs)
    rows = docs.withColumn("_range", at).withColumn("_th", F.xxhash64("text"))
    order = [F.desc_nulls_last("doc_id"), F.desc("_th")]
    # one row for each range: its first row, wanted by the range above it
    first = rows.groupBy("_range").agg(F.max(F.struct("doc_id", "_th")).alias("first"))
    down = Window.partitionBy(F.lit(0)).orderBy(F.desc("_range"))
    top = F.first("first").over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    wanted = first.select(F.col("_range").alias("_for"), F.coalesce(F.lead("first").over(down), top).alias("w"))
    wanted = F.broadcast(wanted.select("_for", F.col("w.doc_id").alias("_wid"), F.col("w._th").alias("_wth")))  # at most 2 x MAX_RANGES
    copies = (rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["_wid"]) & (rows["_th"] == wanted["_wth"]))
              .dropDuplicates(["_for"]).select("doc_id", "text", F.col("_for").alias("_range"), "_th", F.lit(1).alias("_copy")))
    base = rows.select("doc_id", "text", "_range", "_th", F.lit(0).alias("_copy"))
    both = prepare(base.unionByName(copies))
    asked = [c for c in both.columns if c not in ("_range", "_th", "_copy")]
    w = Window.partitionBy("_range").orderBy("_copy", *order)
    return (both.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in asked]).where("_copy = 0")
            .drop("_range", "_th", "_copy"))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, scale: int = 8) -> DataFrame:
    """doc_id and the sketch of each row's text, for mergeable uses."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return with_sketch(src, "text", "sketch", k, scale).drop("text")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, scale: int = 8) -> DataFrame:
    """Fingerprints each text and its edited text: the last third of its code
    points (rounded down) replaced by the first as many of its neighbour."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    pairs = with_neighbour(src, lambda df: with_sketch(df, "text", "sketch", k, scale))
    pairs = pairs.withColumn("n_chars", F.length("text").cast("long"))
    third = F.expr("cast(n_chars div 3 as int)")
    pairs = pairs.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - third).cast("int")),
                                                F.substring("next_text", F.lit(1), third)))
    pairs = with_sketch(pairs.drop("text", "next_text"), "edited", "edited_sketch", k, scale)
    return pairs.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                        as_text("sketch").alias("fingerprint"), as_text("edited_sketch").alias("edited_fingerprint"),
                        likeness("sketch", "edited_sketch").alias("near_edited"),
                        likeness("sketch", "next_sketch").alias("near_next"), F.col("next_doc_id").alias("next_id"))
