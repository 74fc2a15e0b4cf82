"""Skew-safe ordered windows equal their single-window forms."""

import random
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from shoptrail.operators.ordered import previous_value, running_count, sequence_number, sessionize


def _events(spark):
    rnd = random.Random(7)
    base = datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        # one hot key with about a third of the rows
        key = "hot" if i % 3 == 0 else f"k{rnd.randint(1, 40)}"
        ts = base + timedelta(minutes=rnd.randint(0, 60 * 24 * 20))
        rows.append((key, ts, i, f"/p{rnd.randint(1, 9)}", rnd.random() < 0.7))
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, url string, ok boolean")


def test_sessionize_matches_plain_window(spark):
    df = _events(spark)
    got = sessionize(df, ["k"], "ts", "id", "12 hours", chunk="day").select("id", "session_no")
    w = Window.partitionBy("k").orderBy("ts", "id")
    prev = F.lag("ts").over(w)
    ref = (df.withColumn("p", prev)
             .withColumn("st", (F.col("p").isNull() | ((F.col("ts") - F.col("p")) > F.expr("INTERVAL 12 HOURS"))).cast("int"))
             .withColumn("session_no", F.sum("st").over(w.rowsBetween(Window.unboundedPreceding, 0)))
             .select("id", "session_no"))
    assert sorted(got.collect()) == sorted(ref.collect())


def test_previous_value_matches_lag(spark):
    df = _events(spark)
    got = previous_value(df, ["k"], "ts", "id", "url", "prev", chunk="hour").select("id", "prev")
    ref = df.select("id", F.lag("url").over(Window.partitionBy("k").orderBy("ts", "id")).alias("prev"))
    assert sorted(got.collect()) == sorted(ref.collect())


def test_sequence_and_running_count(spark):
    df = _events(spark)
    got = sequence_number(df, ["k"], "ts", ["id"], "rn").select("id", "rn")
    ref = df.select("id", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")).alias("rn"))
    assert sorted(got.collect()) == sorted(ref.collect())
    got2 = running_count(df, ["k"], "ts", "id", "ok", "c").select("id", "c")
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    ref2 = df.select("id", F.sum(F.col("ok").cast("long")).over(w).alias("c"))
    assert sorted(got2.collect()) == sorted(ref2.collect())


def test_hot_key_day_and_missing_times_by_the_hour(spark):
    rows = [("~", None if i % 17 == 0 else datetime(2024, 1, 3) + timedelta(seconds=(i * 7919) % 86400), i, i % 3 == 0) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, ok boolean")
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    got = running_count(df, ["k"], "ts", "id", "ok", "c", chunk="hour").select("id", "c")
    assert sorted(got.collect()) == sorted(df.select("id", F.sum(F.col("ok").cast("long")).over(w).alias("c")).collect())
    got = sequence_number(df, ["k"], "ts", ["id"], "n", chunk="hour").select("id", "n")
    last = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_last(), "id")
    assert sorted(got.collect()) == sorted(df.select("id", F.row_number().over(last).alias("n")).collect())
