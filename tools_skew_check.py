"""Local experiment: hot-key behaviour of per-key ordered windows.

Derives a skewed copy of the driver's ``events`` table (every row replicated
N times with shifted times; one user owns a third of all rows), then runs
sessionisation two ways -- a plain ``Window.partitionBy(user)`` and the
two-level ``operators.ordered.sessionize`` -- and reports, from Spark's
event log, the most shuffle records read by any one task (the largest
window partition) for each form. Usage: python tools_skew_check.py [sf_dir] [copies]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

import zstandard


def stage_stats(log_dir: str) -> dict[str, dict]:
    """job group -> number of stages and the most shuffle records any one
    task read (the largest window partition), from the event log."""
    path = glob.glob(os.path.join(log_dir, "*", "events_*"))[0]
    raw = open(path, "rb")
    stream = zstandard.ZstdDecompressor().stream_reader(raw) if path.endswith(".zstd") else raw
    longest: dict[int, int] = {}
    tasks: dict[int, int] = {}
    group_of: dict[int, str] = {}
    for line in io.TextIOWrapper(stream, encoding="utf-8"):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                group_of[sid] = g
        if e["Event"] == "SparkListenerTaskEnd":
            sid = e["Stage ID"]
            metrics = e.get("Task Metrics") or {}
            read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            longest[sid] = max(longest.get(sid, 0), read)
            tasks[sid] = tasks.get(sid, 0) + 1
    out: dict[str, dict] = {}
    for sid, ms in longest.items():
        g = group_of.get(sid)
        if g in ("plain", "two_level", "dedup_window", "dedup_keep_first"):
            cur = out.setdefault(g, {"stages": 0, "max_task_shuffle_records": 0})
            cur["stages"] += 1
            cur["max_task_shuffle_records"] = max(cur["max_task_shuffle_records"], ms)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from shoptrail.operators.dedup import keep_first
    from shoptrail.operators.ordered import sessionize
    from shoptrail.session import get_spark

    work = tempfile.mkdtemp(prefix="skew-")
    logs = os.path.join(work, "events")
    os.makedirs(logs)
    spark = get_spark("local[8]", shuffle_partitions=64,
                      extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
                             "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    skewed = (ev.select("event_id", "ts", "user_id", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("rep"))
                .select((F.col("event_id") * copies + F.col("rep")).alias("event_id"),
                        (F.col("ts") + F.make_interval(secs=F.col("rep"))).alias("ts"),
                        F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("user_id")))
    path = os.path.join(work, "skewed")
    skewed.write.parquet(path)
    d = spark.read.parquet(path)
    total = d.count()
    hot = d.filter("user_id = 0").count()
    sc = spark.sparkContext

    def run(label, df):
        sc.setJobGroup(label, label)
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    plain = (d.withColumn("p", F.lag("ts").over(w))
              .withColumn("s", (F.col("p").isNull() | ((F.col("ts") - F.col("p")) > F.expr("INTERVAL 12 HOURS"))).cast("int"))
              .withColumn("session_no", F.sum("s").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    t_plain = run("plain", plain)
    t_two = run("two_level", sessionize(d, ["user_id"], "ts", "event_id", "12 hours", chunk="day"))
    # de-duplication where one event id carries a third of all rows as copies
    copies_df = d.select(F.when(F.col("user_id") == 0, F.lit(-1)).otherwise(F.col("event_id")).alias("event_id"),
                         "ts", "user_id", F.lit(0).alias("source_rank"), F.col("event_id").alias("offset_id"))
    wd = Window.partitionBy("event_id").orderBy("source_rank", "offset_id")
    t_dw = run("dedup_window", copies_df.withColumn("rn", F.row_number().over(wd)).filter("rn = 1"))
    t_dm = run("dedup_keep_first", keep_first(copies_df, order=[F.col("source_rank"), F.col("offset_id")]))
    spark.stop()
    stats = stage_stats(logs)
    print(json.dumps({"rows": total, "hot_key_rows": hot, "plain_seconds": round(t_plain, 2),
                      "two_level_seconds": round(t_two, 2), "dedup_window_seconds": round(t_dw, 2),
                      "dedup_keep_first_seconds": round(t_dm, 2),
                      "by_run": stats}))


if __name__ == "__main__":
    main()
