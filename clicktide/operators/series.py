"""Time series of load: hysteresis, backlog, slope, histogram; recent-view audit.

Every running value is computed per range chunk and corrected by a carry from earlier chunks
(see ``ordered``), so one long series does not end in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktide.operators.ordered import (
    CHUNK,
    carry_over,
    earlier_chunks,
    in_chunk,
    join_per_key,
    ordered_chunks,
    running_position,
    with_carry,
)

_UP_TO_NOW = (Window.unboundedPreceding, 0)
_BEFORE_NOW = (Window.unboundedPreceding, -1)


def hysteresis(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    load: str = "load_pct",
    high: float = 0.85,
    low: float = 0.30,
    out: str = "backpressure_active",
) -> DataFrame:
    """On at load >= ``high``, off at load <= ``low``, else unchanged; starts off."""
    signal = F.when(F.col(load) >= high, 1).when(F.col(load) <= low, 0)
    rows = ordered_chunks(df.withColumn("_signal", signal), series, order)
    last = rows.groupBy(*series, CHUNK).agg(
        F.max(F.when(F.col("_signal").isNotNull(), F.struct(*order, "_signal"))).alias("_last"),
    )
    carry = carry_over(
        last,
        series,
        {"_held": F.last("_last._signal", ignorenulls=True).over(earlier_chunks(series))},
    )
    local = F.last("_signal", ignorenulls=True).over(in_chunk(series, order).rowsBetween(*_UP_TO_NOW))
    return (
        with_carry(rows, carry, series)
        .withColumn(out, F.coalesce(local, "_held", F.lit(0)) == 1)
        .drop("_signal", "_held", CHUNK)
    )


def backlog(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    arrivals: str = "arrivals",
    capacity: str = "capacity",
    out: str = "queue_depth",
) -> DataFrame:
    """Queue depth implied by arrivals and service capacity.

    With S the running sum of arrivals - capacity, depth = S - min(0, smallest S so far).
    """
    rows = ordered_chunks(df, series, order)
    along = in_chunk(series, order).rowsBetween(*_UP_TO_NOW)
    walked = rows.withColumn("_s", F.sum(F.col(arrivals) - F.col(capacity)).over(along)).withColumn(
        "_low", F.min("_s").over(along)
    )
    per_chunk = walked.groupBy(*series, CHUNK).agg(
        F.sum(F.col(arrivals) - F.col(capacity)).alias("_total"), F.min("_low").alias("_low")
    )
    base = F.coalesce(F.sum("_total").over(earlier_chunks(series)), F.lit(0))
    based = per_chunk.withColumn("_base", base).withColumn("_floor", F.col("_base") + F.col("_low"))
    carry = carry_over(
        based,
        series,
        {"_base": F.col("_base"), "_floor": F.min("_floor").over(earlier_chunks(series))},
    )
    s = F.col("_s") + F.coalesce("_base", F.lit(0))
    low = F.least(F.lit(0), F.col("_floor"), F.col("_low") + F.coalesce("_base", F.lit(0)))
    return (
        with_carry(walked, carry, series)
        .withColumn(out, s - low)
        .drop("_s", "_low", "_base", "_floor", CHUNK)
    )


def recent_view_flag(
    df: DataFrame,
    order: Sequence[str],
    n: int = 5,
    user: str = "user_id",
    view: str = "pv",
    out: str = "recent_view",
) -> DataFrame:
    """Was any of the previous ``n`` behaviours of this user a view.

    That is so if the last view lies at most ``n`` rows back; row numbers and the number of
    the last view both carry over from chunk to chunk.
    """
    series = [user]
    is_view = F.col("behavior_type") == view
    rows = ordered_chunks(df, series, order)
    along = in_chunk(series, order)
    numbered = rows.withColumn("_pos", F.row_number().over(along))
    per_chunk = numbered.groupBy(*series, CHUNK).agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.when(is_view, F.col("_pos"))).alias("_view")
    )
    offset = F.coalesce(F.sum("_n").over(earlier_chunks(series)), F.lit(0))
    shifted = per_chunk.withColumn("_offset", offset).withColumn(
        "_view", F.col("_offset") + F.col("_view")
    )
    carry = carry_over(
        shifted,
        series,
        {"_offset": F.col("_offset"), "_seen": F.max("_view").over(earlier_chunks(series))},
    )
    local = F.max(F.when(is_view, F.col("_pos"))).over(along.rowsBetween(*_BEFORE_NOW))
    shift = F.coalesce("_offset", F.lit(0))
    last_view = F.coalesce(local + shift, F.col("_seen"))
    return (
        with_carry(numbered, carry, series)
        .withColumn(out, F.coalesce(F.col("_pos") + shift - last_view <= n, F.lit(False)))
        .drop("_pos", "_offset", "_seen", CHUNK)
    )


def regression_slope(
    df: DataFrame,
    series: Sequence[str],
    time: str,
    depth: str,
    skip: float = 0.4,
    order: Sequence[str] = (),
) -> DataFrame:
    """Least-squares slope of depth on time per series, without the first ``skip`` of its
    samples (at least one); null for fewer than three samples. ``order`` settles equal times."""
    wanted = dict.fromkeys([*series, time, depth, *order])
    placed = running_position(df.select(*wanted), series, list(order) or [time])
    sizes = placed.groupBy(*series).agg(F.count(F.lit(1)).alias("_n"))
    dropped = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(skip))).cast("bigint")
    joined = (
        join_per_key(placed, sizes, list(series), "inner", null_safe=True)
        if series
        else placed.withColumn("_n", F.lit(sizes.first()["_n"]))
    )
    kept = (F.col("_n") >= 3) & (F.col("position") > dropped)
    y, x = F.when(kept, F.col(depth).cast("double")), F.when(kept, F.col(time).cast("double"))
    return joined.groupBy(*series).agg(
        F.max("_n").alias("samples"), F.regr_slope(y, x).alias("measured_slope")
    )


def theoretical_slope(rate: float, service_seconds: float, consumers: int) -> float:
    """Growth of an unbounded queue: arrival rate less service rate."""
    return rate - consumers / service_seconds


def histogram(df: DataFrame, series: Sequence[str], value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins per series; the last bin is closed; equal values get a width of one."""
    lo, hi = F.col("_lo"), F.col("_hi")
    ends = (
        df.groupBy(*series)
        .agg(F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi"))
        .withColumns(
            {
                "_lo": F.when(lo == hi, lo - 0.5).otherwise(lo),
                "_hi": F.when(lo == hi, hi + 0.5).otherwise(hi),
            }
        )
    )
    position = (F.col(value) - lo) / (hi - lo) * bins
    index = F.least(F.lit(bins - 1), F.floor(position)).cast("bigint")
    rows = df.where(F.col(value).isNotNull())
    if series:
        placed = join_per_key(rows, ends, list(series), "inner", null_safe=True)
    else:
        placed = rows.withColumns({c: F.lit(v) for c, v in ends.first().asDict().items()})
    return placed.groupBy(*series, index.alias("bin")).agg(
        F.max(lo + (hi - lo) * index / bins).alias("bin_start"), F.count(F.lit(1)).alias("cnt")
    )


def metrics_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.max("queue_depth").alias("max_queue_depth"),
        F.max("load_pct").alias("max_load_pct"),
        F.count_if("backpressure_active").alias("active_samples"),
    )
