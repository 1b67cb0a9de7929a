"""Counts over event-time windows and running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.functions import scalars as S
from clicktide.functions.scalars import ratio

# Behaviours that make up a window's total.
COUNTED = ("view", "cart", "purchase")
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def timed_events(lines: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """``event_ts``, ``user_id``, ``behavior_type`` and ``ids`` of JSON objects; other lines are skipped.

    The time is ``timestamp`` in epoch seconds if given, else ``event_time``, by the same rule as
    ``parse_events``; without a usable one ``event_ts`` is null, see ``untimed``. A missing
    behaviour is ``unknown``.
    """
    fields = ["event_time", "timestamp", "user_id", "behavior_type", *ids]
    e = F.from_json("value", ", ".join(f"`{c}` string" for c in fields))
    # Taken out by a generator, so that a line is parsed once, not for every use of a field.
    texts = lines.where(F.json_object_keys("value").isNotNull()).select(F.inline(F.array(e)))
    return texts.select(
        S.stamp_or_time("timestamp", "event_time").alias("event_ts"),
        S.safe_int("user_id").alias("user_id"),
        F.coalesce("behavior_type", F.lit("unknown")).alias("behavior_type"),
        *[S.safe_int(c).alias(c) for c in ids],
    )


def untimed(events: DataFrame) -> DataFrame:
    """Events with and without a usable time; windows and sessions hold the former only."""
    return events.groupBy(F.col("event_ts").isNotNull().alias("timed")).agg(F.count(F.lit(1)).alias("cnt"))


def window_counts(events: DataFrame, seconds: int = 10, lateness: str = "10 minutes") -> DataFrame:
    """Events per window and behaviour; the same plan serves batch and stream.

    Rows are counted before the shuffle, so a busy window costs one row per task. State is
    dropped once the watermark has passed a window.
    """
    b = F.col("behavior_type")
    counts = (
        events.where(F.col("event_ts").isNotNull())
        .withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", f"{seconds} seconds"))
        .agg(
            *[F.count_if(b == name).alias(name) for name in COUNTED],
            F.count_if(~b.isin(*COUNTED)).alias("other"),
        )
    )
    total = sum((F.col(name) for name in COUNTED[1:]), F.col(COUNTED[0]))
    return counts.select(
        F.unix_seconds(F.col("window.start")).alias("window_start"),
        *COUNTED,
        "other",
        total.alias("total"),
        (F.col("view") / seconds).alias("view_rate"),
        (F.col("purchase") / seconds).alias("purchase_rate"),
    )


def running_totals(events: DataFrame) -> DataFrame:
    """All-time count per behaviour; for output mode ``complete``."""
    return events.groupBy("behavior_type").agg(F.count(F.lit(1)).alias("cnt"))


def with_percent(totals: DataFrame) -> DataFrame:
    """Percent of all events, on a finished table of totals."""
    everything = totals.agg(F.sum("cnt")).first()[0]
    return totals.withColumn("pct", ratio(F.col("cnt") * 100.0, F.lit(everything).cast("double")))
