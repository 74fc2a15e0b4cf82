"""Secret scans with corpus-wide ownership frequency (operator 9).

Candidates are the matches of the base patterns and, beyond them, long mixed
tokens (letters and digits, 20 characters or more) that no base match covers.
Each candidate's value is hashed, and over the whole corpus it is counted in
how many distinct repositories and owners the hash occurs. Values that at
least ``copied_owners`` owners hold are examples that people copy; the others
belong to few owners and look live. Live mixed tokens are added to the spans;
base spans always stay.

Built-in functions only. The texts are read once; what is shuffled are the
candidates, first reduced to one row a (hash, owner, repository).

Defined cases: null texts have no spans; a null owner or repository is one of
its own; rows that repeat a doc_id are scanned as separate rows; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.tables import BROADCAST_ROWS, stage

# The base patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ["assign", "access", "hex", "mixed"]
# Matches shorter than this are dropped; longer runs only need looking for.
_LEAST = {"assign": 8, "access": 16, "hex": 32}
_SEARCH = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}",
           "mixed": r"[A-Za-z0-9+/_=-]{20,}"}
_ALSO = {"mixed": " and y.value rlike '[0-9]' and y.value rlike '[A-Za-z]'"}
_FOUND = "array<struct<start:int,end:int,value:string>>"


def _quoted(pattern: str) -> str:
    return "r'" + pattern + "'" if "'" not in pattern else 'r"' + pattern.replace('"', r"\x22") + '"'


def matches(text: str, kind: str) -> Column:
    """Leftmost non-overlapping matches of a kind in a column: starts and
    ends in code points and the value. Positions follow from the lengths of
    the pieces between matches."""
    p = _quoted(_SEARCH[kind])
    value = f"regexp_extract(m, {p}, 2)" if kind == "assign" else "m"
    least = _LEAST.get(kind, 0)
    return F.expr(f"""
        if({text} is null or not {text} rlike {p}, cast(array() as {_FOUND}),
        filter(aggregate(
            zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), (g, h) -> struct(g as gap, h as hit)),
            named_struct('at', 0, 'out', cast(array() as {_FOUND})),
            (acc, x) -> named_struct(
                'at', acc.at + char_length(x.gap) + coalesce(char_length(x.hit), 0),
                'out', if(x.hit is null, acc.out, concat(acc.out, transform(array(x.hit), m -> named_struct(
                    'start', acc.at + char_length(x.gap), 'end', acc.at + char_length(x.gap) + char_length(m), 'value', {value}))))),
            acc -> acc.out), y -> char_length(y.value) >= {least}{_ALSO.get(kind, "")}))""")


def candidates(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Columns ``carry`` and ``found``: an array of (kind number, start, end,
    hash of the value) for the column ``text``."""
    df = docs.select(*carry, *[matches("text", k).alias(f"_{k}") for k in KINDS])
    base = ", ".join(f"transform(_{k}, x -> struct({i} as kind, x.start as start, x.end as end, sha2(x.value, 256) as hash))"
                     for i, k in enumerate(KINDS[:3]))
    df = df.withColumn("_base", F.expr(f"concat({base})"))
    extra = F.expr("""transform(filter(_mixed, m -> not exists(_base, b -> b.start < m.end and m.start < b.end)),
        x -> struct(3 as kind, x.start as start, x.end as end, sha2(x.value, 256) as hash))""")
    return df.select(*carry, F.concat("_base", extra).alias("found"))


def ownership(rows: DataFrame) -> DataFrame:
    """(hash, repositories, owners) over rows (found, owner, repository)."""
    each = rows.select(F.explode("found").alias("c"), "owner", "repository").select("c.hash", "owner", "repository").distinct()
    by_owner = each.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("repositories"), F.count(F.lit(1)).alias("owners"))


def _prepared(docs: DataFrame, id_col: str, text_col: str, owner: Column, repository: Column) -> DataFrame:
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      owner.cast("string").alias("owner"), repository.cast("string").alias("repository"))
    src = src.withColumn("row", F.monotonically_increasing_id())
    return stage(candidates(src.withColumn("th", F.xxhash64("text")), ["row", "doc_id", "th", "owner", "repository"]), "secret-candidates")


def _judged(rows: DataFrame, copied_owners: int) -> DataFrame:
    """Each candidate with whether its value is widely copied."""
    seen = stage(ownership(rows), "ownership")
    each = rows.select("row", "doc_id", "th", F.explode("found").alias("c")).select("row", "doc_id", "th", "c.*")
    small = F.broadcast(seen) if seen.count() <= BROADCAST_ROWS // 4 else seen
    return each.join(small, "hash").withColumn("live", F.col("owners") < copied_owners)


def _spans(keep: str) -> Column:
    """The spans of a list as kind:start:end by start, then kind."""
    names = "array('" + "','".join(KINDS) + "')"
    return F.expr(f"""array_join(transform(array_sort(filter(list, x -> {keep})),
        x -> concat({names}[x.kind], ':', x.start, ':', x.end)), ',')""")


def scan(docs: DataFrame, owner: Column, repository: Column, id_col: str = "doc_id", text_col: str = "text",
         copied_owners: int = 3) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_assign, n_access, n_hex,
    base_sha256 (of the base spans), spans (base and added), live_spans,
    n_live, n_copied."""
    rows = _prepared(docs, id_col, text_col, owner, repository)
    lists = _judged(rows, copied_owners).groupBy("row").agg(
        F.collect_list(F.struct("start", "kind", "end", "live")).alias("list"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,live:boolean>>")
    out = rows.select("row", "doc_id").join(lists, "row", "left").select("doc_id", F.coalesce("list", none).alias("list"))

    def count(what: str) -> Column:
        return F.expr(f"cast(size(filter(list, x -> {what})) as bigint)")
    return out.select("doc_id", count("x.kind = 0").alias("n_assign"), count("x.kind = 1").alias("n_access"), count("x.kind = 2").alias("n_hex"),
                      F.sha2(_spans("x.kind < 3").cast("binary"), 256).alias("base_sha256"), _spans("x.kind < 3 or x.live").alias("spans"),
                      _spans("x.live").alias("live_spans"), count("x.live").alias("n_live"), count("not x.live").alias("n_copied"))


def redact(docs: DataFrame, owner: Column, repository: Column, id_col: str = "doc_id", text_col: str = "text",
           copied_owners: int = 3, mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with every live value's span replaced by ``mark``
    in the text column; widely copied examples stay as they are."""
    rows = _prepared(docs, id_col, text_col, owner, repository)
    live = (_judged(rows, copied_owners).where("live").groupBy("row", "doc_id", "th")
            .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans"))
            .select(F.col("doc_id").alias("_sid"), F.col("th").alias("_sth"), "_spans").dropDuplicates(["_sid", "_sth"]))
    live = stage(live, "live-spans")
    small = F.broadcast(live) if live.count() <= BROADCAST_ROWS // 4 else live
    text = F.col(text_col).cast("string")
    joined = docs.join(small, F.col(id_col).cast("long").eqNullSafe(F.col("_sid")) & (F.xxhash64(text) == F.col("_sth")), "left")
    quoted = mark.replace("'", "\\'")
    name = "`" + text_col.replace("`", "``") + "`"
    masked = F.expr(f"""aggregate(_spans, named_struct('at', 0, 'out', ''),
        (acc, s) -> if(s.start < acc.at, named_struct('at', greatest(acc.at, s.end), 'out', acc.out), named_struct('at', s.end,
            'out', concat(acc.out, substring({name}, acc.at + 1, s.start - acc.at), '{quoted}'))),
        acc -> concat(acc.out, substring({name}, acc.at + 1)))""")
    return joined.withColumn(text_col, F.when(F.col("_spans").isNotNull(), masked).otherwise(text)).select(*docs.columns)
