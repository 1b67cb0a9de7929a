"""Session ids.

A break needs a gap above ``timeout`` seconds, and two times in the same slot of ``timeout``
seconds are less than that apart. So a user's rows in one slot always belong together, and
only the first and last time of each slot decide where sessions break. The slots are a plain
map-side-combined aggregate; the window that numbers sessions sees one row per user and slot,
however many rows a hot user has. Rows get their number back by an equi-join on (user, slot),
whose skewed keys adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.operators.ordered import null_safe_join, prefix_sum
from clicktide.session import materialize

SLOT = "_slot"


def slot_of(timeout: int, time: str = "timestamp") -> Column:
    return F.floor(F.col(time) / F.lit(timeout)).cast("bigint")


def slot_spans(
    df: DataFrame, keys: Sequence[str], timeout: int, *extra: Column, time: str = "timestamp"
) -> DataFrame:
    """First and last time per key and slot, with any further aggregates."""
    return (
        df.withColumn(SLOT, slot_of(timeout, time))
        .groupBy(*keys, SLOT)
        .agg(F.min(time).alias("_first"), F.max(time).alias("_last"), *extra)
    )


def number_sessions(spans: DataFrame, keys: Sequence[str], timeout: int) -> DataFrame:
    """Add ``session_id``, counting from 1 per key."""
    along = Window.partitionBy(*keys).orderBy(SLOT)
    gap = F.col("_first") - F.lag("_last").over(along)
    starts = F.when(gap.isNull() | (gap > timeout), 1).otherwise(0)
    return spans.withColumn("_starts", starts).withColumn(
        "session_id",
        F.sum("_starts").over(along.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint"),
    )


def sessionize(
    df: DataFrame, timeout: int = 1800, keys: Sequence[str] = ("user_id",), time: str = "timestamp"
) -> DataFrame:
    """Add ``session_id``: per user, a new session after a gap of more than ``timeout``."""
    spans = number_sessions(slot_spans(df, keys, timeout, time=time), keys, timeout)
    ids = spans.select(*keys, SLOT, "session_id")
    rows = df.withColumn(SLOT, slot_of(timeout, time))
    return null_safe_join(rows, ids, [*keys, SLOT], "left").drop(SLOT)


def sessionize_global(
    df: DataFrame, timeout: int = 1800, user: str = "user_id", time: str = "timestamp"
) -> DataFrame:
    """As ``sessionize``, but ids run on over all users in (user, time) order.

    The number of sessions of smaller users is a prefix sum over per-user totals. The slot
    table is used for these and for the ids, so it is written once.
    """
    spans = materialize(
        number_sessions(slot_spans(df, [user], timeout, time=time), [user], timeout), "slots"
    )
    totals = spans.groupBy(user).agg(F.sum("_starts").alias("_sessions"))
    before = prefix_sum(totals, user, "_sessions", "_before").select(user, "_before")
    ids = spans.join(before, user).select(
        user, SLOT, (F.col("session_id") + F.col("_before")).alias("session_id")
    )
    rows = df.withColumn(SLOT, slot_of(timeout, time))
    return null_safe_join(rows, ids, [user, SLOT], "left").drop(SLOT)
