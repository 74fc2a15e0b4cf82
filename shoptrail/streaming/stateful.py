"""Keyed state with timers: sessions by id (X7), the last N rows of a key (T5)
and running quality in event-time order (W3), with ``transformWithState``.

State lives in RocksDB under the checkpoint. Event-time operators drop rows
later than the watermark, as every stateful operator does, and release their
state when the watermark passes it. Event times travel as microseconds since
1970 (UTC), so that state and rows compare exactly.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have the package on their path
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MINUTE_MS, DAY_MS = 60_000, 86_400_000


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state with timers needs this provider; it holds for the queries
    that start afterwards. State is kept on disk, and a trigger uploads its
    changes, not all of the state."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _in_time(events: DataFrame, watermark: str, time_col: str) -> DataFrame:
    return (events.where(F.col(time_col).isNotNull()).withWatermark(time_col, watermark)
            .withColumn("micros", F.unix_micros(F.col(time_col))))


def _blocks(rows: list[tuple]) -> tuple:
    """Rows as one state value: an array for each column."""
    return tuple(list(column) for column in zip(*rows))


def _rows(blocks: Iterator[tuple]) -> list[tuple]:
    return [row for block in blocks for row in zip(*block)]


def _grouped(column, shards: int | None):
    """The id itself, or the shard that holds its state."""
    return column if shards is None else F.pmod(F.xxhash64(column), F.lit(shards)).cast("string")


# ---- X7: sessions by id ----

STRETCH = ("session_id array<string>, start array<long>, end array<long>, events array<long>, page_views array<long>, "
           "last_page array<string>, page_at array<long>, page_id array<string>")
SESSIONS = "session_id string, start long, end long, events long, page_views long, last_page string"
LEAST_MERGED = 1024  # stretches of a key that wait to be merged


def merge_stretches(parts: list[tuple], gap_us: int) -> list[tuple]:
    """Stretches (start, end, events, views, page, page time, page id) of a
    session in time order; those less than the gap apart are one. The last page
    is that of the newest view, ties by id."""
    out: list[tuple] = []
    for p in sorted(parts, key=lambda p: p[:2]):
        if out and p[0] - out[-1][1] < gap_us:
            a = out.pop()
            page = max((x for x in (a, p) if x[5] is not None), key=lambda x: (x[5], x[6] or ""), default=a)
            p = (a[0], max(a[1], p[1]), a[2] + p[2], a[3] + p[3], *page[4:7])
        out.append(p)
    return out


def merge_sessions(rows: list[tuple], gap_us: int) -> list[tuple]:
    """Stretches, led by their session id, merged by session."""
    by_id: dict[str, list[tuple]] = {}
    for row in rows:
        by_id.setdefault(row[0], []).append(row[1:])
    return [(i, *p) for i, parts in by_id.items() for p in (merge_stretches(parts, gap_us) if len(parts) > 1 else parts)]


class SessionState(StatefulProcessor):
    """The open stretches of one session id, or of a shard of them. A stretch is
    given out and forgotten once the watermark is past its last event by the
    gap. New stretches are appended, and merged with the others when a timer
    fires or when as many came as there were; each key has one timer at a time,
    that of the first expiry."""

    def __init__(self, gap_seconds: int):
        self.gap_us = gap_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", STRETCH)
        self.held = handle.getValueState("held", "stretches long, most long, timer long")

    def expiry(self, part: tuple) -> int:
        return -(-(part[2] + self.gap_us) // 1000)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        parts = []
        for r in rows:
            view = r["event_type"] == "PAGE_VIEW"
            page = (r["page_url"], r["micros"], r["event_id"]) if view else (None, None, None)
            parts.append((r["session_id"], r["micros"], r["micros"], 1, int(view), *page))
        parts = merge_sessions(parts, self.gap_us)
        held, most, timer = self.held.get() if self.held.exists() else (0, LEAST_MERGED, None)
        first = min(self.expiry(p) for p in parts)
        if timer is None or first < timer:
            self.handle.registerTimer(first)
            timer = first
        held += len(parts)
        if held > most:
            parts = merge_sessions(_rows(self.open.get()) + parts, self.gap_us)
            held, most = len(parts), max(LEAST_MERGED, 2 * len(parts))
            self.open.put([_blocks(parts)])
        else:
            self.open.appendList([_blocks(parts)])
        self.held.update((held, most, timer))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        if not self.held.exists() or self.held.get()[2] > now:
            return  # another timer of the key gave out what was due
        parts = merge_sessions(_rows(self.open.get()), self.gap_us)
        kept = [p for p in parts if self.expiry(p) > now]  # later events may have moved the end
        if kept:
            timer = min(self.expiry(p) for p in kept)
            self.handle.registerTimer(timer)
            self.open.put([_blocks(kept)])
            self.held.update((len(kept), max(LEAST_MERGED, 2 * len(kept)), timer))
        else:
            self.open.clear()
            self.held.clear()
        for p in parts:
            if self.expiry(p) <= now:
                yield Row(session_id=p[0], start=p[1], end=p[2], events=p[3], page_views=p[4], last_page=p[5])


def session_state(events: DataFrame, gap_seconds: int, watermark: str, time_col: str = "event_time",
                  shards: int | None = None) -> DataFrame:
    """Page views and last page by session id, one row for each stretch of
    activity, given out when it expires. Events: session_id, event_id,
    event_type, page_url and the event time; rows without id or time are left
    out. Each key costs a trigger some calls between Python and the state: with
    ``shards`` the sessions of a shard are one key (the number stays as long as
    the checkpoint)."""
    rows = _in_time(events.where("session_id is not null"), watermark, time_col)
    if shards is not None:
        rows = rows.withColumn("shard", _grouped(F.col("session_id"), shards))
    columns = ["session_id", "event_id", "event_type", "page_url", "micros", time_col]
    out = (rows.select(*columns, *([] if shards is None else ["shard"])).groupBy("session_id" if shards is None else "shard")
           .transformWithState(SessionState(gap_seconds), SESSIONS, "Append", "EventTime"))
    return out.select("session_id", F.timestamp_micros("start").alias("session_start"), F.timestamp_micros("end").alias("session_end"),
                      "events", "page_views", "last_page")


# ---- T5: the last N rows of a key ----

RECENT_ROW = "micros long, event_id string"


class RecentRows(StatefulProcessor):
    """The newest ``n`` rows of a key, rows without a time last, ties by id.
    Every trigger that brings rows gives the whole list, under its version."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("recent", RECENT_ROW)
        self.version = handle.getValueState("version", "version long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = [tuple(r) for r in self.rows.get()]
        for r in rows:
            kept.append((r["micros"], r["event_id"]))
            if len(kept) >= 4 * self.n:
                kept = self.newest(kept)
        kept = self.newest(kept)
        version = (self.version.get()[0] if self.version.exists() else 0) + 1
        self.rows.put(kept)
        self.version.update((version,))
        for i, (micros, event_id) in enumerate(kept):
            yield Row(key=key[0], event_id=event_id, micros=micros, rank=i + 1, version=version)

    def newest(self, rows: list[tuple]) -> list[tuple]:
        return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))[:self.n]


def recent_rows(events: DataFrame, key: str, time_col: str, n: int) -> DataFrame:
    """T5 on a stream: key (as text), event_id, micros, rank, version; a key's
    list is that of its greatest version."""
    rows = events.select(F.col(key).cast("string").alias("key"), "event_id", F.unix_micros(F.col(time_col)).alias("micros"))
    return rows.groupBy("key").transformWithState(
        RecentRows(n), "key string, event_id string, micros long, rank long, version long", "Update", "None")


# ---- W3: running quality ----

class RunningQuality(StatefulProcessor):
    """A day's rows of a customer, or of a shard of them, wait in a buffer until
    the watermark is past them; then they are counted, customer by customer, in
    the order of time and id. When the day is over its counts are forgotten.
    Each key has one timer at a time, that of its first waiting minute, besides
    the day's."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "customer array<string>, micros array<long>, event_id array<string>, ok array<boolean>")
        self.counts = handle.getValueState("counts", "customer array<string>, processed array<long>, valid array<long>")
        self.due = handle.getValueState("due", "timer long")

    def day_over(self, key) -> int:
        day = datetime.strptime(str(key[1])[:10], "%Y-%m-%d").replace(tzinfo=timezone.utc)
        return int(day.timestamp()) * 1000 + DAY_MS + MINUTE_MS

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [(r["customer"], r["micros"], r["event_id"], bool(r["ok"])) for r in rows]
        self.waiting.appendList([_blocks(new)])
        timer = (min(r[1] for r in new) // 1000 // MINUTE_MS + 1) * MINUTE_MS
        pending = self.due.get()[0] if self.due.exists() else None
        if pending is None:
            self.handle.registerTimer(self.day_over(key))
        if pending is None or timer < pending:
            self.handle.registerTimer(timer)
            self.due.update((timer,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() // MINUTE_MS * MINUTE_MS
        if self.due.exists() and self.due.get()[0] <= now:  # else another timer of the key gave out what was due
            rows = sorted(_rows(self.waiting.get()), key=lambda r: (r[1], r[2] is None, r[2] or "", r[3]))
            counts = {c: (n, ok) for c, n, ok in zip(*self.counts.get())} if self.counts.exists() else {}
            end = bisect_left(rows, now * 1000, key=lambda r: r[1])
            for customer, _, event_id, ok in rows[:end]:
                processed, valid = counts.get(customer, (0, 0))
                counts[customer] = processed, valid = processed + 1, valid + int(ok)
                yield Row(event_id=event_id, running_processed=processed, running_valid=valid)
            if end < len(rows):
                timer = (rows[end][1] // 1000 // MINUTE_MS + 1) * MINUTE_MS
                self.handle.registerTimer(timer)
                self.due.update((timer,))
                self.waiting.put([_blocks(rows[end:])])
            else:
                self.due.clear()
                self.waiting.clear()
            if now < self.day_over(key):
                self.counts.update(_blocks([(c, *n) for c, n in counts.items()]))
        if now >= self.day_over(key) and self.counts.exists():
            self.counts.clear()


def running_quality(flagged: DataFrame, watermark: str, key: str = "customer_id", time_col: str = "event_time",
                    valid_col: str = "is_valid_event", shards: int | None = None) -> DataFrame:
    """W3 on a stream: processed and valid events of a customer's day up to
    each event, in event-time order whatever order they arrive in; given out
    when the watermark has passed the event. ``shards`` as in ``session_state``;
    a shard's days are keys of their own."""
    customer = F.coalesce(F.col(key), F.lit("~"))
    rows = _in_time(flagged, watermark, time_col).select(
        _grouped(customer, shards).alias("key"), F.date_format(F.col(time_col), "yyyy-MM-dd").alias("day"), customer.alias("customer"), "micros",
        "event_id", F.coalesce(F.col(valid_col), F.lit(False)).alias("ok"), time_col)
    return rows.groupBy("key", "day").transformWithState(
        RunningQuality(), "event_id string, running_processed long, running_valid long", "Append", "EventTime")
