"""Keyed-state streams over small files, trigger by trigger."""

import json
import os
import random
import tempfile
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shoptrail.streaming import stateful

EVENT = "session_id string, event_id string, event_type string, page_url string, customer_id string, is_valid_event boolean, event_time timestamp"


@pytest.fixture()
def feed(spark):
    stateful.use_rocksdb(spark)
    base = tempfile.mkdtemp(prefix="shoptrail-stream-")
    os.mkdir(f"{base}/in")

    def run(batches, build, mode="append"):
        """One file, and one trigger, for each batch; the rows given out with
        their batch, and the checkpoint."""
        for i, rows in enumerate(batches):
            path = f"{base}/in/{i}.json"
            with open(path, "w") as f:
                f.write("\n".join(json.dumps(r) for r in rows))
            os.utime(path, (time.time() + i, time.time() + i))
        source = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).json(f"{base}/in")
        q = (build(source).writeStream.outputMode(mode).option("checkpointLocation", f"{base}/ckpt")
             .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{base}/out/batch_id={i}")).trigger(availableNow=True).start())
        q.awaitTermination()
        return spark.read.parquet(f"{base}/out").collect(), f"{base}/ckpt"
    return run


def event(session, eid, at, kind="PAGE_VIEW", page="/a", **more):
    return {"session_id": session, "event_id": eid, "event_type": kind, "page_url": page, "event_time": at} | more


def test_session_state_expires_and_is_forgotten(spark, feed):
    day = "2024-01-01T"
    batches = [
        [event("s1", "e2", day + "00:10:00", page="/b"), event("s1", "e1", day + "00:00:00"), event("s2", "e3", day + "00:00:00", "SEARCH"),
         event(None, "x", day + "00:00:00"), event("s1", "y", None)],
        [event("s1", "e5", day + "02:00:00", page="/again"), event("s1", "e4", day + "00:05:00", page="/c"), event("end", "z", "2024-01-02T00:00:00")],
        [event("end", "z1", "2024-01-02T00:00:00")],  # a row is late by the watermark of the trigger before
        [event("s1", "e9", day + "00:06:00", page="/late"), event("end", "z2", "2024-01-03T00:00:00")]]
    rows, checkpoint = feed(batches, lambda s: stateful.session_state(s, 1800, "1 hour"))
    got = {(r["session_id"], str(r["session_start"])[11:16], str(r["session_end"])[11:16], r["events"], r["page_views"], r["last_page"]) for r in rows}
    assert {g for g in got if g[0] != "end"} == {
        ("s1", "00:00", "00:10", 3, 3, "/b"), ("s1", "02:00", "02:00", 1, 1, "/again"), ("s2", "00:00", "00:00", 1, 0, None)}
    left = spark.read.format("statestore").option("stateVarName", "open").load(checkpoint)
    assert {r[0] for r in left.select("key.session_id").collect()} == {"end"}  # the expired sessions left no state


def test_sessions_merge_when_a_late_event_closes_the_gap():
    us = 1_000_000
    apart = [(0, 0, 1, 1, "/a", 0, "e1"), (50 * us, 50 * us, 1, 1, "/b", 50 * us, "e2")]
    assert len(stateful.merge_stretches(apart, 30 * us)) == 2
    assert stateful.merge_stretches([*apart, (25 * us, 25 * us, 1, 0, None, None, None)], 30 * us) == [(0, 50 * us, 3, 2, "/b", 50 * us, "e2")]


def test_recent_keeps_n_rows_a_key(spark, feed):
    rng = random.Random(3)
    rows = [event("s", f"e{i:03}", f"2024-01-01T00:{i % 60:02}:00" if i % 7 else None, customer_id=f"c{i % 3}") for i in range(90)]
    rng.shuffle(rows)
    out, checkpoint = feed([rows[:30], rows[30:60], rows[60:]], lambda s: stateful.recent_rows(s, "customer_id", "event_time", 5), "update")
    newest = {}
    for r in out:
        newest[r["key"]] = max(newest.get(r["key"], 0), r["version"])
    got = sorted((r["key"], r["rank"], r["event_id"]) for r in out if r["version"] == newest[r["key"]])
    want = []
    for c in ("c0", "c1", "c2"):
        own = sorted((r for r in rows if r["customer_id"] == c), key=lambda r: r["event_id"])
        own.sort(key=lambda r: r["event_time"] or "", reverse=True)
        want += [(c, i + 1, r["event_id"]) for i, r in enumerate(own[:5])]
    assert got == want
    state = spark.read.format("statestore").option("stateVarName", "recent").load(checkpoint)
    assert state.groupBy("key").count().agg(F.max("count")).first()[0] == 5


def test_running_quality_in_event_time_order(spark, feed):
    rng = random.Random(4)
    rows = [event("s", f"e{i:03}", f"2024-01-0{1 + i % 2}T{i % 24:02}:{i % 60:02}:00", customer_id=rng.choice(["a", None]), is_valid_event=i % 5 > 0)
            for i in range(80)]
    shuffled = rng.sample(rows, len(rows))
    closing = event("s", "end", "2024-03-01T00:00:00", customer_id="~end", is_valid_event=True)
    out, checkpoint = feed([shuffled[:30], shuffled[30:], [closing]], lambda s: stateful.running_quality(s, "10 days"))
    want, counts = {}, {}
    for r in sorted(rows, key=lambda r: (r["event_time"], r["event_id"])):
        key = r["customer_id"], r["event_time"][:10]
        n, ok = counts.get(key, (0, 0))
        counts[key] = want[r["event_id"]] = (n + 1, ok + r["is_valid_event"])
    assert {r["event_id"]: (r["running_processed"], r["running_valid"]) for r in out} == want
    state = spark.read.format("statestore").option("stateVarName", "counts").load(checkpoint)
    assert {r[0] for r in state.select("key.key").collect()} <= {"~end"}  # days that are over left no counts


def state_keys(spark, checkpoint, variable, batch):
    state = spark.read.format("statestore").option("stateVarName", variable).option("batchId", batch).load(checkpoint)
    return state.select("key").distinct().count()


def test_sharded_quality_equals_plain_with_few_keys(spark, feed):
    rng = random.Random(5)
    rows = [event("s", f"e{i:03}", f"2024-01-0{1 + i % 2}T{i % 24:02}:{i % 60:02}:00", customer_id=f"c{i % 40}" if i % 9 else None,
                  is_valid_event=i % 5 > 0) for i in range(200)]
    rows += [dict(rows[3]), event("s", None, rows[3]["event_time"], customer_id=rows[3]["customer_id"], is_valid_event=None)]
    shuffled = rng.sample(rows, len(rows))
    closing = event("s", "end", "2024-03-01T00:00:00", customer_id="~end", is_valid_event=True)
    out, checkpoint = feed([shuffled[:100], shuffled[100:], [closing]], lambda s: stateful.running_quality(s, "10 days", shards=3))
    want, counts = [], {}
    for r in sorted(rows, key=lambda r: (r["event_time"], r["event_id"] is None, r["event_id"] or "")):
        key = r["customer_id"], r["event_time"][:10]
        n, ok = counts.get(key, (0, 0))
        counts[key] = (n + 1, ok + bool(r["is_valid_event"]))
        want.append((r["event_id"] or "", *counts[key]))
    assert sorted((r["event_id"] or "", r["running_processed"], r["running_valid"]) for r in out) == sorted(want)
    assert 2 < state_keys(spark, checkpoint, "waiting", 1) <= 6  # three shards of two days, not customers
    left = spark.read.format("statestore").option("stateVarName", "counts").load(checkpoint)
    assert left.count() == 0


def test_sharded_sessions_equal_plain_with_few_keys(spark, feed, monkeypatch):
    monkeypatch.setattr(stateful, "LEAST_MERGED", 20)  # merging while rows arrive too
    rng = random.Random(6)
    start = 1704067200
    rows = [event(f"s{rng.randrange(60)}", f"e{i:03}", time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(start + rng.randrange(86400))),
                  rng.choice(["PAGE_VIEW", "SEARCH"]), f"/{i % 7}") for i in range(400)]
    closing = [event("end", f"z{i}", "2024-03-01T00:00:00") for i in range(2)]
    batches = [rows[i::4] for i in range(4)] + [[closing[0]], [closing[1]]]
    out, checkpoint = feed(batches, lambda s: stateful.session_state(s, 1800, "2 days", shards=5))
    want = set()
    for sid in {r["session_id"] for r in rows}:
        own = sorted((r["event_time"], r["event_id"], r["event_type"], r["page_url"]) for r in rows if r["session_id"] == sid)
        parts = []
        for r in own:
            if parts and stamp(r[0]) - stamp(parts[-1][-1][0]) < 1800:
                parts[-1].append(r)
            else:
                parts.append([r])
        for p in parts:
            views = [r for r in p if r[2] == "PAGE_VIEW"]
            want.add((sid, p[0][0], p[-1][0], len(p), len(views), views[-1][3] if views else None))
    got = [(r["session_id"], *(r[c].strftime("%Y-%m-%dT%H:%M:%S") for c in ("session_start", "session_end")), r["events"], r["page_views"],
            r["last_page"]) for r in out]
    assert len(got) == len(set(got)) and set(got) == want
    assert state_keys(spark, checkpoint, "open", 3) <= 5  # shards, not sessions


def stamp(text):
    return datetime.strptime(text, "%Y-%m-%dT%H:%M:%S").timestamp()
