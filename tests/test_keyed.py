"""Bucketed joins without a shuffle of the table; look-ups that skip rows."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from shoptrail.operators import variants
from shoptrail.sinks import keyed


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    name = f"bucketed_{uuid.uuid4().hex}"
    rows = spark.range(5000).select(F.concat(F.lit("e"), "id").alias("event_id"), (F.col("id") % 7).cast("string").alias("event_type"))
    keyed.write_bucketed(rows, name, str(tmp_path_factory.mktemp("bucketed")), buckets=16)
    return name


def _side_of(plan: str, table_path: str) -> None:
    """No exchange stands above the table's scan up to the join."""
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Scan parquet" in line and table_path in line)
    depth = re.search(r"[A-Za-z(*]", lines[scan]).start()
    for line in reversed(lines[:scan]):
        at = re.search(r"[A-Za-z(*]", line)
        if at and at.start() < depth:
            depth = at.start()
            if "Join" in line:
                return
            assert "Exchange" not in line, plan
    raise AssertionError(plan)


@pytest.mark.parametrize("partitions", ["8", "200"])
def test_bucketed_joins_do_not_move_the_table(spark, table, partitions):
    source = spark.range(4990, 5020).select(F.concat(F.lit("e"), "id").alias("event_id"), F.lit("new").alias("event_type"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        merged = keyed.merge_bucketed(table, source)
        fresh = keyed.unseen_in_bucketed(source, table)
        for df in (merged, fresh):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1 and plan.count("SortMergeJoin") == 1, plan
            _side_of(plan, f"default.{table}")
        got = {r["event_id"]: r["event_type"] for r in merged.collect()}
        assert len(got) == 5020 and got["e4995"] == "new" and got["e5019"] == "new" and got["e3"] == "3"
        assert {r["event_id"] for r in fresh.collect()} == {f"e{i}" for i in range(5000, 5020)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _rows_scanned(df) -> int:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    todo, total = [plan], 0
    while todo:
        node = todo.pop()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if "Scan parquet" in node.nodeName():
            total += node.metrics().apply("numOutputRows").value()
    return total


@pytest.mark.parametrize("column", ["customer_id", "event_id"])
def test_look_ups_read_a_part_of_the_rows(spark, tmp_path, column):
    rows = spark.range(40_000).select(F.concat(F.lit("c"), F.col("id") % 500).alias("customer_id"), F.md5(F.col("id").cast("string")).alias("event_id"))
    keyed.write_clustered(rows, str(tmp_path / "t"), "customer_id", bloom="event_id", files=4, distinct=2_000, group_rows=1_000)
    value = "c123" if column == "customer_id" else rows.first()["event_id"]
    found = keyed.look_up(spark, str(tmp_path / "t"), column, value)
    scanned = _rows_scanned(found)
    assert found.count() == (80 if column == "customer_id" else 1)
    assert scanned <= 5_000  # of 40,000


def test_variant_extraction(spark):
    texts = ['{"quantity": 2, "product_price": "9.50"}', '{"quantity": "many", "new": [1]}', '{"quantity": null}', "{cut", None, "[1, 2]",
             '{"new": "x", "product_price": {"a": 1}}']
    raw = spark.createDataFrame([(i, t, "PRODUCT_VIEW") for i, t in enumerate(texts)], "id int, event_data string, event_type string")
    got = variants.extract(raw, variants.payload_fields("quantity", "product_price")).orderBy("id").collect()
    assert [(r["quantity"], r["product_price"] and float(r["product_price"]), r["payload_issues"]) for r in got] == [
        (2, 9.5, []), (None, None, ["bad_cast:quantity"]), (None, None, []), (None, None, ["bad_json"]), (None, None, []), (None, None, []),
        (None, None, ["bad_cast:product_price"])]
    assert {(r["path"], r["events"], r["value_type"]) for r in variants.drift(raw).collect()} == {("new", 2, "VARIANT")}
