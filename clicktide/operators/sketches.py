"""Distinct counts that can be merged: a sketch per day and behaviour, united for any range.

A table of sketches has a few kilobytes per group whatever the number of rows, so unique visitors of
any set of days and behaviours come from it without the log. A day is updated by replacing its
partition; days that did not change are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.sources.versioned import overwrite_partitions, read_versioned

LG_SLOTS = 14


def error_bound(lg_slots: int = LG_SLOTS, deviations: float = 3.0) -> float:
    """Largest relative error to expect: some standard errors of 1.04 / sqrt(slots)."""
    return deviations * 1.04 / 2 ** (lg_slots / 2)


def day_of(timestamp: str = "timestamp") -> Column:
    """The UTC day of epoch seconds."""
    return F.to_date(F.timestamp_seconds(timestamp))


def visitor_sketches(
    log: DataFrame, by: Sequence[str], user: str = "user_id", lg_slots: int = LG_SLOTS
) -> DataFrame:
    """A sketch of the distinct users and the number of rows per group of ``by``.

    Sketches are made per task before the shuffle, so a hot group sends one per task. Rows without
    a user count as rows only.
    """
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(user, lg_slots).alias("visitors")
    )


def merge(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches united to coarser groups; the order and number of steps do not matter."""
    grouped = sketches.groupBy(*by) if by else sketches
    return grouped.agg(F.sum("rows").alias("rows"), F.hll_union_agg("visitors").alias("visitors"))


def estimates(sketches: DataFrame) -> DataFrame:
    """``uv_count`` in place of the sketch."""
    return sketches.withColumn("uv_count", F.hll_sketch_estimate("visitors")).drop("visitors")


def update_days(log: DataFrame, root: str, by: Sequence[str] = ("behavior_type",), **options) -> int:
    """Sketches of the days in ``log``, which must be whole days, in place of those in the table at
    ``root``; returns the table's version. Rows without a usable time are left out."""
    timed = log.withColumn("day", day_of()).where("day IS NOT NULL")
    return overwrite_partitions(visitor_sketches(timed, ["day", *by], **options), root, "day")


def visitors_between(
    spark: SparkSession, root: str, first: str, last: str, by: Sequence[str] = ("behavior_type",)
) -> DataFrame:
    """Rows and estimated unique visitors per group over the days from ``first`` to ``last``."""
    days = read_versioned(spark, root).where(F.col("day").between(F.lit(first), F.lit(last)))
    return estimates(merge(days, by))
