"""Late events (X5): rows behind the watermark are routed and counted, not
dropped.

A stateful operator drops what is older than its watermark without a trace.
Here a micro-batch is split before any state: ``on_time``, ``late`` (older
than the latest time of the batches before less the delay), ``future`` (more
than an hour ahead; such a stamp moves no watermark) and ``undated``. The four
routes are all rows.

Each batch id writes its own folders in overwrite mode and its mark is read
from the batch before, so a replayed batch replaces itself with the same
split. State is one row a batch; rows are neither collected nor shuffled.

Defined cases: the first batch has nothing late; a batch without a usable time
leaves the mark where it was; an event exactly at the mark is on time.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

ROUTES = ("on_time", "late", "future", "undated")
PROGRESS = "latest timestamp"


def _latest_before(spark: SparkSession, path: str, batch_id: int):
    """The latest usable time of all batches before; None at the start."""
    if batch_id == 0:
        return None
    return spark.read.schema(PROGRESS).parquet(os.path.join(path, "progress", f"batch_id={batch_id - 1}")).first()["latest"]


def route_arrivals(path: str, delay: str, as_of=None, hours: int = 1, time_col: str = "event_time"):
    """``foreachBatch`` writer of the four routes under ``path``; ``delay`` is
    an interval such as ``7 days``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = F.lit(_latest_before(spark, path, batch_id)).cast("timestamp")
        now = F.lit(str(as_of)).cast("timestamp") if as_of is not None else F.current_timestamp()
        t = F.col(time_col)
        route = (F.when(t.isNull(), "undated").when(t > now + F.expr(f"INTERVAL {int(hours)} HOURS"), "future")
                 .when(t < before - F.expr(f"INTERVAL {delay}"), "late").otherwise("on_time"))
        rows = os.path.join(path, "rows", f"batch_id={batch_id}")
        batch.withColumn("route", route).write.mode("overwrite").partitionBy("route").parquet(rows)
        schema = T.StructType([*batch.schema.fields, T.StructField("route", T.StringType())])  # an empty batch has no files
        usable = spark.read.schema(schema).parquet(rows).where("route IN ('on_time', 'late')")
        (usable.agg(F.max(time_col).alias("latest")).select(F.greatest("latest", before).alias("latest")).coalesce(1)
         .write.mode("overwrite").parquet(os.path.join(path, "progress", f"batch_id={batch_id}")))
    return write


def observed(events: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Counts the rows that reach the routes, as the stream's own metrics."""
    return events.observe("arrivals", F.count(F.lit(1)).alias("arrived"), F.count(time_col).alias("dated"))


class ArrivalCounts(StreamingQueryListener):
    """Adds up the observed counts of a session's streams by batch, so that a
    repeated batch counts once."""

    def __init__(self):
        self.batches: dict[tuple[str, int], tuple[int, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get("arrivals")
        if row is not None:
            self.batches[str(event.progress.id), event.progress.batchId] = (row["arrived"], row["dated"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def arrived(self) -> int:
        return sum(n for n, _ in self.batches.values())


def start_routing(events: DataFrame, path: str, checkpoint: str, delay: str, as_of=None, time_col: str = "event_time"):
    """Drains what has arrived into the routes and stops; called again, it goes
    on with the next batch id."""
    return (observed(events, time_col).writeStream.foreachBatch(route_arrivals(path, delay, as_of, time_col=time_col))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_routes(spark: SparkSession, path: str, schema) -> DataFrame:
    """All routed rows with their ``route`` and ``batch_id``."""
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields] + ["batch_id int", "route string"])
    return spark.read.schema(fields).parquet(os.path.join(path, "rows"))
