"""A session id and recent history on every event of a stream."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.streaming.ordered_state import BUCKETS, in_time_order
from clicktide.streaming.sessions import has_user

_ADDED = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("last_active_ms", T.LongType()),
        T.StructField("history", T.ArrayType(T.StringType())),
    ]
)


def session_id(user_id, start_ms: int) -> str:
    """Twelve hex digits that a user and the session's first time determine."""
    return hashlib.sha256(f"{user_id}:{start_ms}".encode()).hexdigest()[:12]


def event_sessions(
    events: DataFrame,
    carry: Sequence[str] = (),
    order: Sequence[str] = ("ms", "behavior_type"),
    timeout: int = 1800,
    keep: int = 10,
    lateness: str = "10 minutes",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Every event with ``session_id``, ``last_active_ms`` and ``history``, in append mode.

    ``events`` has user_id, event_ts, behavior_type and the columns ``carry``. An event leaves when
    the watermark has passed it, so the result does not depend on batches. A gap of exactly
    ``timeout`` seconds stays in the session. ``last_active_ms`` is the time of the session's event
    before this one, null for its first; ``history`` has the session's last ``keep`` behaviours, this
    event's included. Events at one time are taken by ``order``. Rows without a time or a user are left
    out, the latter's time counts for the watermark; rows later than ``lateness`` are dropped by
    Spark and counted in its progress. The state of users idle for longer than ``timeout`` is dropped.
    Users share ``buckets`` groups of state (see ``in_time_order``).
    """
    gap = timeout * 1000

    def step(rows, starts, states):
        n, ms = rows.num_rows, rows["ms"].to_numpy()
        users, sizes = rows["user_id"].take(starts).to_pylist(), np.diff(starts, append=n)
        first = np.zeros(n, dtype=bool)
        first[starts] = True
        # The time before each row, of the same user; the first row's is in the state.
        known = np.array([s is not None for s in states])
        before = np.append(ms[:1], ms[:-1])
        before[starts] = [0 if s is None else s[1] for s in states]
        opens = ms - before > gap
        opens[starts[~known]] = True

        # One session per opening row, and one per user whose session goes on.
        heads = np.flatnonzero(opens | first)
        session = np.cumsum(opens | first) - 1
        begun = ms[heads].tolist()
        goes_on = np.flatnonzero(~opens[starts])
        for user in goes_on.tolist():
            begun[session[starts[user]]] = states[user][0]
        names = np.repeat(np.arange(len(starts)), sizes)[heads].tolist()
        ids = pa.array([session_id(users[u], b) for u, b in zip(names, begun)], pa.string())

        # Behaviours with the remembered ones in front of each session that goes on.
        recent = [states[u][2] for u in goes_on.tolist()]
        ahead = np.zeros(len(heads), dtype=np.int64)
        ahead[session[starts[goes_on]]] = [len(r) for r in recent]
        place = np.arange(n) - heads[session] + ahead[session]
        lengths = np.minimum(place + 1, keep)
        offsets = np.append(0, np.cumsum(lengths))
        back = np.arange(offsets[-1]) - np.repeat(offsets[1:] - 1, lengths)
        row = np.repeat(np.arange(n), lengths)
        remembered = pa.array([b for r in recent for b in r], pa.string())
        source = pa.concat_arrays([rows["behavior_type"].combine_chunks(), remembered])
        held_from = n + np.cumsum(ahead) - heads
        at = row + back
        at = np.where(at >= heads[session[row]], at, at + held_from[session[row]])
        history = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), source.take(pa.array(at)))

        ends = np.append(starts[1:], n) - 1
        latest = history.take(pa.array(ends)).to_pylist()
        last, at_end = ms[ends].tolist(), session[ends].tolist()
        after = [(begun[s], m, h) for s, m, h in zip(at_end, last, latest)]
        return after, [ids.take(pa.array(session)), pa.array(before, mask=opens), history]

    watched = (
        events.where(F.col("event_ts").isNotNull())
        .withWatermark("event_ts", lateness)
        .where(has_user("event_ts"))
    )
    return in_time_order(
        watched, ["user_id"], "event_ts", ["behavior_type", *carry], order, _ADDED, step, gap, buckets
    )
