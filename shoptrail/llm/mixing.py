"""Mixing sources to target weights (operator 1).

The corpus is a tree of domains, languages and sources. A token budget goes
down the tree: every node's budget is shared among its children by weight. A
child can take at most what lies under it times ``max_epochs``; what it can't
take goes to its siblings by weight, and leaves the node for the node's own
siblings only when all of them are full (a node's capacity is the sum of its
leaves', so its parent never gives it more than its subtree can take).

Each leaf then takes its budget from seeded epochs: whole passes over its
documents, and of the last pass the prefix, in the order of
md5(seed:epoch:doc_id), that fills the budget to the token; the last document
of a prefix is cut.

Shares are integers: floors by weight, what is left over goes one by one to
the unfilled children in the order of their names.

Defined cases: null lang or source are nodes of their own, named ``~``;
texts without tokens are never taken (they add nothing); rows without doc_id
sort by their other columns; repeated rows are taken as separate rows; an
empty table or a budget of 0 gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoptrail.llm.tables import count_words, number_rows, stage

LEVELS = ["domain", "lang", "source"]


def domain_of(source: Column) -> Column:
    """Default domain of a source: d0 to d2 by its last digit, else d."""
    digit = F.regexp_extract(source, "([0-9])$", 1)
    return F.when(digit != "", F.concat(F.lit("d"), (F.expr("0") + digit.try_cast("int") % 3).cast("string"))).otherwise(F.lit("d"))


def _weight(name: Column, weights: dict[str, int]) -> Column:
    out = F.lit(1).cast("long")
    if weights:
        pairs = [F.lit(x) for k, v in sorted(weights.items()) for x in (k, int(v))]
        out = F.coalesce(F.create_map(*pairs)[name].cast("long"), out)
    return out


def share_out(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds ``share`` to rows (parent..., name, budget of the parent, cap,
    weight): water-filling by weight under the caps, exact in integers."""
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    least = by.orderBy(F.col("cap") / F.col("weight"), name).rowsBetween(Window.unboundedPreceding, -1)
    c = (children.withColumn("_cap", F.coalesce(F.sum("cap").over(least), F.lit(0)))
         .withColumn("_left", F.sum("weight").over(by) - F.coalesce(F.sum("weight").over(least), F.lit(0))))
    big = "decimal(38,0)"
    c = c.withColumn("_full", F.col("cap").cast(big) * F.col("_left") <= (F.col("budget") - F.col("_cap")).cast(big) * F.col("weight"))
    c = (c.withColumn("_rest", F.col("budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(by), F.lit(0)))
         .withColumn("_w", F.sum(F.when(~F.col("_full"), F.col("weight"))).over(by)))
    c = c.withColumn("_share", F.when(F.col("_full"), F.col("cap")).otherwise(
        F.expr("(cast(_rest as decimal(20,0)) * cast(weight as decimal(18,0))) div cast(_w as decimal(20,0))")))
    c = (c.withColumn("_over", F.col("_rest") - F.coalesce(F.sum(F.when(~F.col("_full"), F.col("_share"))).over(by), F.lit(0)))
         .withColumn("_place", F.row_number().over(by.orderBy("_full", name))))
    extra = F.when(~F.col("_full") & (F.col("_place") <= F.col("_over")), 1).otherwise(0)
    return c.withColumn("share", F.col("_share") + extra).drop("_cap", "_left", "_full", "_rest", "_w", "_share", "_over", "_place")


def leaf_budgets(leaves: DataFrame, budget: int, weights: dict[str, dict[str, int]], max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, budget) from (domain, lang, source,
    tokens): the budget goes down one level at a time."""
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    given: DataFrame | None = None
    for depth, level in enumerate(LEVELS):
        parent, keys = LEVELS[:depth], LEVELS[:depth + 1]
        nodes = leaves.groupBy(*keys).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("weight", _weight(F.col(level), weights.get(level, {})))
        if given is None:
            total = F.sum("cap").over(Window.partitionBy(F.lit(0)))
            nodes = nodes.withColumn("budget", F.least(F.lit(int(budget)).cast("long"), total))
        else:
            nodes = nodes.join(given, parent)
        given = share_out(nodes, parent, level).select(*keys, F.col("share").alias("budget"), "tokens")
        if depth < len(LEVELS) - 1:
            given = given.drop("tokens")
    return given


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
        budget_percent: int = 80, budget: int | None = None, weights: dict[str, dict[str, int]] | None = None, max_epochs: int = 2,
        seed: int = 1, domain=domain_of, keep: list[str] | None = None) -> DataFrame:
    """One row for each time a document is taken: doc_id, domain, lang,
    source, n_tokens, epoch, take_tokens and the leaf's budget. ``budget`` in
    tokens, or ``budget_percent`` of all tokens. ``keep``: columns of the
    input to carry along under the names ``c_...``."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(domain(F.col(source_col).cast("string")), F.lit("~")).alias("domain"),
                      F.coalesce(F.col(lang_col).cast("string"), F.lit("~")).alias("lang"),
                      F.coalesce(F.col(source_col).cast("string"), F.lit("~")).alias("source"),
                      count_words(F.col(text_col)).alias("n_tokens"), *[F.col(c).alias(f"c_{c}") for c in keep or []])
    narrow = src if keep else stage(src, "mix-tokens")
    leaves = stage(narrow.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    if budget is None:
        total = leaves.agg(F.sum("tokens")).first()[0] or 0
        budget = int(total) * budget_percent // 100
    budgets = stage(leaf_budgets(leaves, budget, weights or {}, max_epochs), "mix-budgets")
    plan = budgets.where("budget > 0").select(
        *LEVELS, F.col("budget").alias("leaf_budget"), F.expr("cast(budget div tokens as int)").alias("_whole"), (F.col("budget") % F.col("tokens")).alias("_part"))
    rows = narrow.where("n_tokens > 0").join(F.broadcast(plan) if budgets.count() <= 100_000 else plan, LEVELS)
    out = ["doc_id", *LEVELS, "n_tokens", "epoch", "take_tokens", "leaf_budget", *[f"c_{c}" for c in keep or []]]
    whole = rows.where("_whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_whole") - 1))).withColumn(
        "take_tokens", F.col("n_tokens"))
    part = rows.where("_part > 0").withColumn("epoch", F.col("_whole")).withColumn("_leaf", F.struct(*LEVELS))
    key = F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("~")))
    part = number_rows(part, "_leaf", key, ["doc_id", "n_tokens"], "_upto", "n_tokens").where("_upto < _part").withColumn(
        "take_tokens", F.least("n_tokens", F.col("_part") - F.col("_upto")))
    return whole.select(*out).unionByName(part.select(*out))
