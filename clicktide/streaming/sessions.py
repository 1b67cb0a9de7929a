"""Sessions of a stream of events, as session windows: Spark keeps, merges and drops their state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PARTS = (
    "user_id bigint, first_ts timestamp, gap_ms bigint, last_ms bigint, events bigint, "
    "recent array<struct<ms: bigint, behavior: string>>"
)


def has_user(time: str) -> Column:
    """A user is there. The condition names the time as well, so that Spark does not test it below
    the watermark, where rows without a user would no longer move it."""
    return F.col(time) < F.when(F.col("user_id").isNotNull(), F.lit("9999-12-31").cast("timestamp"))


def stream_sessions(events: DataFrame, timeout: int = 1800, lateness: str = "10 minutes") -> DataFrame:
    """Sessions per user as session windows; a gap of exactly ``timeout`` stays inside.

    With ``merge.sessions.in.local.partition`` on (see the session defaults) a task merges a
    user's events before the shuffle. In append mode a session is written once, when the
    watermark has passed its end, and its state is dropped. Rows without a user belong to no
    session, but their time counts for the watermark.
    """
    sessions = (
        events.where(F.col("event_ts").isNotNull())
        .withWatermark("event_ts", lateness)
        .where(has_user("event_ts"))
        .groupBy("user_id", F.session_window("event_ts", f"{timeout} seconds"))
        .agg(F.count(F.lit(1)).alias("events"))
    )
    return sessions.select(
        "user_id",
        F.unix_millis(F.col("session_window.start")).alias("start_ms"),
        (F.unix_millis(F.col("session_window.end")) - timeout * 1000).alias("end_ms"),
        "events",
    )


def slot_parts(events: DataFrame, timeout: int = 1800, keep: int = 10) -> DataFrame:
    """Events folded, batch by Arrow batch, to one row per user and slot of ``timeout`` seconds.

    Times in one slot lie less than ``timeout`` apart, so they share a session whatever else
    arrives. This keeps a hot user's raw events from going to the user's state task. ``recent``
    holds the last ``keep`` behaviours by time, then name.
    """
    width = timeout * 1000

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.sort_values(["ms", "behavior_type"], kind="stable")
            batch["slot"] = batch["ms"] // width
            keys = ["user_id", "slot"]
            grouped = batch.groupby(keys, sort=False, dropna=False)
            folded = grouped["ms"].agg(first_ms="min", last_ms="max", events="size")
            tail = grouped.tail(keep)
            pairs = [{"ms": m, "behavior": b} for m, b in zip(tail["ms"], tail["behavior_type"])]
            recent = pd.Series(pairs, index=tail.index, dtype=object)
            parts = folded.join(recent.groupby([tail["user_id"], tail["slot"]], dropna=False).agg(list).rename("recent"))
            parts = parts.reset_index()
            parts["first_ts"] = pd.to_datetime(parts["first_ms"], unit="ms", utc=True)
            parts["gap_ms"] = parts["last_ms"] - parts["first_ms"] + width
            yield parts[["user_id", "first_ts", "gap_ms", "last_ms", "events", "recent"]].astype({"user_id": "Int64"})

    timed = events.where(F.col("event_ts").isNotNull()).select(
        "user_id", F.unix_millis("event_ts").alias("ms"), "behavior_type"
    )
    return timed.mapInPandas(fold, _PARTS)


def session_history(
    events: DataFrame, timeout: int = 1800, keep: int = 10, lateness: str = "10 minutes"
) -> DataFrame:
    """Sessions with their last ``keep`` behaviours as (ms, behavior), for append mode.

    A part that arrives late, but within ``lateness``, opens a session, joins one or merges two, so
    the result does not depend on how events fall into batches. What a session holds is at most
    ``keep`` behaviours for each of its slots.
    """
    parts = slot_parts(events, timeout, keep).withWatermark("first_ts", lateness)
    gap = F.concat(F.col("gap_ms").cast("string"), F.lit(" milliseconds"))
    sessions = (
        parts.where(has_user("first_ts"))
        .groupBy("user_id", F.session_window("first_ts", gap))
        .agg(
            F.max("last_ms").alias("end_ms"),
            F.sum("events").alias("events"),
            F.flatten(F.collect_list("recent")).alias("recent"),
        )
    )
    newest = F.slice(F.reverse(F.array_sort("recent")), 1, keep)
    return sessions.select(
        "user_id",
        F.unix_millis(F.col("session_window.start")).alias("start_ms"),
        "end_ms",
        "events",
        F.reverse(newest).alias("history"),
    )


def numbered(sessions: DataFrame) -> DataFrame:
    """``session_no`` from 1 in each user's order of time; for a finished table of sessions."""
    order = Window.partitionBy("user_id").orderBy("start_ms")
    return sessions.withColumn("session_no", F.row_number().over(order).cast("bigint"))
