"""Session ids and histories on the events of a stream, whatever the batches."""

import json
import random
from datetime import UTC, datetime, timedelta
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from clicktide.session import scratch
from clicktide.sources import readers
from clicktide.streaming import event_sessions, ordered_state, run, windows

START = datetime(2024, 3, 1, tzinfo=UTC)
FAR = {"event_time": "2100-01-01 00:00:00.000", "behavior_type": "view"}
TIMEOUT = 600


def made_events(seed, users=9, each=45):
    """(ms, user, behaviour, item); gaps lie around the time-out and hit it exactly at times."""
    rng = random.Random(seed)
    out = []
    for user in range(users):
        ms = rng.randrange(600_000)
        for _ in range(each):
            out.append((ms, user, rng.choice(["view", "cart", "fav"]), rng.randrange(50)))
            ms += rng.choice([0, 1, 30_000, 200_000, TIMEOUT * 1000, TIMEOUT * 1000 + 1, 900_000])
    return out


def line(event):
    ms, user, behavior, item = event
    time = (START + timedelta(milliseconds=ms)).strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]
    return json.dumps({"event_time": time, "user_id": user, "behavior_type": behavior, "item_id": item})


def plain(events, keep=10):
    """One event after the other, in the order of time."""
    base, state, out = int(START.timestamp() * 1000), {}, []
    for ms, user, behavior, item in sorted(events, key=lambda e: (e[0], e[2], e[3])):
        start, last, recent = state.get(user, (None, None, []))
        if last is None or ms - last > TIMEOUT * 1000:
            start, last, recent = ms, None, []
        recent = [*recent, behavior][-keep:]
        before = None if last is None else base + last
        sid = event_sessions.session_id(user, base + start)
        out.append((user, base + ms, behavior, item, sid, before, tuple(recent)))
        state[user] = (start, ms, recent)
    return sorted(out, key=str)


def stream(spark, batches, lateness="10 minutes"):
    """Rows that left the stream, one file a batch, and the progress reports."""
    path, out, state = (scratch(spark, n) for n in ("event-lines", "event-out", "event-state"))
    for batch in batches:
        values = spark.createDataFrame([(v,) for v in batch], "value string")
        values.coalesce(1).write.mode("append").text(path)
    events = windows.timed_events(readers.read_event_stream(spark, path, 1), ["item_id"])
    plan = event_sessions.event_sessions(
        events, ["item_id"], ("ms", "behavior_type", "item_id"), TIMEOUT, lateness=lateness
    )
    with run.rocksdb_state(spark):
        query = run.start(plan, out, state)
    query.awaitTermination()
    rows = [(*r[:6], tuple(r[6])) for r in run.read_batches(spark, out).drop("batch_id").collect()]
    return sorted(rows, key=str), query.recentProgress


@pytest.mark.parametrize("batches", [1, 5])
def test_equal_to_the_order_of_time_in_any_batches(spark, batches):
    events = made_events(batches)
    rng = random.Random(9)
    # Up to nine minutes out of order, which is within the lateness.
    arrival = sorted(events, key=lambda e: e[0] + rng.randrange(540_000))
    size = -(-len(arrival) // batches)
    files = [[line(e) for e in arrival[i : i + size]] for i in range(0, len(arrival), size)]
    found, progress = stream(spark, [*files, [json.dumps(FAR)]])
    assert found == plain(events)
    operator = progress[-1]["stateOperators"][0]
    assert operator["numRowsTotal"] == 0, "the state of idle users is dropped"
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress) == 0


def test_odd_rows(spark):
    events = [(0, 1, "view", 1), (1000, 1, "cart", 2), (7_200_000, 2, "view", 3)]
    after = (7_200_001, 3, "view", 3)
    late = (500, 1, "fav", 9)  # hours behind the watermark, which a batch later counts
    odd = ["no json", "{}", json.dumps({"user_id": 5, "behavior_type": "view"}),
           json.dumps({"event_time": "2024-03-01 00:00:00.000"})]
    found, progress = stream(spark, [[line(e) for e in events] + odd, [line(after)], [line(late)], [json.dumps(FAR)]])
    assert found == plain([*events, after])
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress) == 1


def test_users_share_groups_of_state(spark):
    """The work of a batch is that of its buckets, not of its users."""
    events = made_events(3, users=60, each=4)
    path, out, state = (scratch(spark, n) for n in ("event-lines", "event-out", "event-state"))
    spark.createDataFrame([(line(e),) for e in events], "value string").coalesce(1).write.text(path)
    timed = windows.timed_events(readers.read_event_stream(spark, path, 1), ["item_id"])
    plan = event_sessions.event_sessions(
        timed, ["item_id"], ("ms", "behavior_type", "item_id"), TIMEOUT, buckets=3
    )
    with run.rocksdb_state(spark):
        query = run.start(plan, out, state)
    query.awaitTermination()
    assert query.recentProgress[0]["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] <= 3


class Handle:
    """State of one key in memory."""

    def __init__(self):
        self.value, self.map, self.timers = {}, {}, set()
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

    def getMapState(self, name, *_):
        m = self.map
        return SimpleNamespace(updateValue=m.__setitem__, getValue=m.__getitem__, removeKey=m.pop)

    def getValueState(self, name, *_):
        v = self.value
        return SimpleNamespace(
            exists=lambda: name in v, get=lambda: v[name], update=lambda x: v.__setitem__(name, x),
            clear=lambda: v.pop(name, None),
        )


def test_a_timer_holds_only_pieces_that_overlap(monkeypatch):
    monkeypatch.setattr(ordered_state, "SORTED_ROWS", 40)
    monkeypatch.setattr(ordered_state, "PIECE_ROWS", 5)
    waiting = T.StructType().add("k", "string").add("ms", "long").add("v", "long")
    taken = []

    def step(rows, starts, states):
        taken.append(rows.num_rows)
        sums, total = [], dict(enumerate(s or 0 for s in states))
        group = np.repeat(np.arange(len(starts)), np.diff(starts, append=rows.num_rows))
        for g, v in zip(group.tolist(), rows["v"].to_pylist()):
            total[g] += v
            sums.append(total[g])
        return list(total.values()), [pa.array(sums)]

    out = T.StructType([*waiting.fields, T.StructField("sum", T.LongType())])
    made, handle = ordered_state.InTimeOrder(["k"], waiting, out, ["ms", "v"], step, None), Handle()
    made.init(handle)
    rng, found, sums = random.Random(2), [], {}
    rows = [(rng.choice(["a", "b", None]), rng.randrange(5000), i) for i in range(1000)]
    for part in (rows[:700], rows[700:]):
        low = 0 if part[0] is rows[0] else 2500
        frames = [pd.DataFrame(part[i : i + 9], columns=["k", "ms", "v"]) for i in range(0, len(part), 9)]
        late = [r for r in part if r[1] < low]
        frames = [f[f["ms"] >= low] for f in frames]
        list(made.handleInputRows(None, iter(frames), None))
        rows = [r for r in rows if r not in late]
        now = 2499 if low == 0 else 9999
        assert len(handle.timers) == 1
        handle.timers.clear()
        for frame in made.handleExpiredTimer(None, SimpleNamespace(getCurrentWatermarkInMs=lambda: now), None):
            found += [tuple(None if v is pd.NA else v for v in r) for r in frame.itertuples(index=False)]
    expected = []
    for k, ms, v in sorted(rows, key=lambda r: (r[1], r[2])):
        sums[k] = sums.get(k, 0) + v
        expected.append((k, ms, v, sums[k]))
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert not handle.map and max(taken) < 200
