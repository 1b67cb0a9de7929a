"""Work along a total order without putting a whole table, or one hot series, in one task.

Two tools:

* ``prefix_sum`` adds up values by an integer key. It sums blocks of 65,536 neighbouring keys,
  then blocks of blocks, so every window sees at most 65,536 rows, whatever the data.
* ``ordered_chunks`` range-partitions rows by (series, order). Range bounds follow the data,
  so a hot series is cut into many chunks. Running values are then computed inside a chunk and
  corrected by what earlier chunks of the same series carry over. Only the first series of a
  chunk can have begun earlier, so the carry table has at most one row per range partition:
  that is its proven size bound, and why it may be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.session import materialize

CHUNK = "_chunk"
_BLOCK_BITS = 16
_BLOCK = 1 << _BLOCK_BITS
_BEFORE = (Window.unboundedPreceding, -1)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which a null key matches a null key; keeps the left key columns."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns]
    )
    condition = None
    for k in keys:
        part = left[k].eqNullSafe(renamed[f"_r_{k}"])
        condition = part if condition is None else condition & part
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def join_per_key(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str, null_safe: bool = False
) -> DataFrame:
    """Join rows with a table aggregated by the same keys, of which one may be very hot.

    Such a table already lies partitioned by the keys. Spark would leave it there, and then
    adaptive execution cannot split the hot key's rows, for it splits a join only where both
    sides were shuffled for it. A hash of the keys as one more key asks for that shuffle.
    Where the table measures small it is broadcast anyway. With ``null_safe`` null keys meet.
    """
    if null_safe:
        hashed = (x.withColumn("__hash", F.xxhash64(*keys)) for x in (rows, per_key))
        return null_safe_join(*hashed, [*keys, "__hash"], how).drop("__hash")
    joined = rows.withColumn("__hash", F.xxhash64(*keys)).join(
        per_key.withColumn("__hash", F.xxhash64(*keys)), [*keys, "__hash"], how
    )
    return joined.drop("__hash")


def prefix_sum(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows with a smaller ``key``.

    ``key`` is a unique, non-null integer column. ``df`` is a table of totals per key; it is
    written once, because it is both summed up in blocks and read for the result.
    """
    return _prefix(materialize(df, "totals"), key, value, out)


def _prefix(totals: DataFrame, key: str, value: str, out: str) -> DataFrame:
    ends = totals.agg(F.min(key), F.max(key)).first()
    if ends[0] is None or ends[1] - ends[0] < _BLOCK:
        # Fewer than 65,536 keys are left, so a single group is safe.
        every = Window.partitionBy(F.lit(0)).orderBy(key).rowsBetween(*_BEFORE)
        return totals.withColumn(out, F.coalesce(F.sum(value).over(every), F.lit(0)))
    inside = Window.partitionBy("__block").orderBy(key).rowsBetween(*_BEFORE)
    tagged = totals.withColumn("__block", block_of(key))
    blocks = tagged.groupBy(F.col("__block").alias("__key")).agg(F.sum(value).alias("__sum"))
    starts = _prefix(materialize(blocks, "blocks"), "__key", "__sum", "__start").select(
        F.col("__key").alias("__block"), "__start"
    )
    return (
        tagged.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts, "__block")
        .withColumn(out, F.col("__inside") + F.col("__start"))
        .select(*totals.columns, out)
    )


def block_of(key: str) -> Column:
    """Number of the block of 65,536 neighbouring keys that ``key`` lies in."""
    return F.shiftright(F.col(key).cast("bigint"), _BLOCK_BITS)


def ordered_chunks(df: DataFrame, series: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows cut into balanced, ordered chunks; ``_chunk`` rises along (series, order).

    ``order`` should end in a unique column, so that rows with equal times can be split too.
    The table is written once: sampled range bounds could differ in a second run, and the
    chunk numbers must not.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in (*series, *order)])
    return materialize(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")


def in_chunk(series: Sequence[str], order: Sequence[str]):
    """Window over the rows of one series inside one chunk."""
    return Window.partitionBy(*series, CHUNK).orderBy(*order)


def earlier_chunks(series: Sequence[str]):
    """Window over the summaries of the chunks before this one; at most one row per chunk."""
    keys = list(series) or [F.lit(0)]
    return Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)


def carry_over(
    summary: DataFrame, series: Sequence[str], carried: dict[str, Column]
) -> DataFrame:
    """Carry table: series, chunk and the carried values, for chunks that are not the first."""
    return (
        summary.withColumn("_earlier", F.count(F.lit(1)).over(earlier_chunks(series)))
        .withColumns(carried)
        .where(F.col("_earlier") > 0)
        .select(*series, CHUNK, *carried)
    )


def with_carry(rows: DataFrame, carry: DataFrame, series: Sequence[str]) -> DataFrame:
    """Attach the carry table, which has at most one row per range partition."""
    return null_safe_join(rows, F.broadcast(carry), [*series, CHUNK], "left")


def running_position(
    df: DataFrame, series: Sequence[str], order: Sequence[str], out: str = "position"
) -> DataFrame:
    """Add the 1-based row number of each row inside its series."""
    rows = ordered_chunks(df, series, order)
    sizes = rows.groupBy(*series, CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    carry = carry_over(sizes, series, {"_before": F.sum("_n").over(earlier_chunks(series))})
    local = F.row_number().over(in_chunk(series, order))
    return (
        with_carry(rows, carry, series)
        .withColumn(out, (local + F.coalesce("_before", F.lit(0))).cast("bigint"))
        .drop("_before", CHUNK)
    )


def running_total(
    df: DataFrame, series: Sequence[str], order: Sequence[str], value: str, out: str
) -> DataFrame:
    """Add the running sum of ``value`` up to and including each row of its series."""
    rows = ordered_chunks(df, series, order)
    totals = rows.groupBy(*series, CHUNK).agg(F.sum(value).alias("_n"))
    carry = carry_over(totals, series, {"_before": F.sum("_n").over(earlier_chunks(series))})
    local = F.sum(value).over(in_chunk(series, order).rowsBetween(Window.unboundedPreceding, 0))
    return (
        with_carry(rows, carry, series)
        .withColumn(out, local + F.coalesce("_before", F.lit(0)))
        .drop("_before", CHUNK)
    )


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Per column the mean of its two middle non-null values; None without any.

    All columns go in one pass, as series of (column, value). Equal values are counted first and
    the distinct ones are ranked by range, so no task ever holds all of them; two numbers per
    column reach the driver.
    """
    cells = [F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in columns]
    values = (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("_v").isNotNull())
        .groupBy("_c", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = materialize(running_total(values, ["_c"], ["_v"], "_n", "_upto"), "ranks")
    sizes = ranked.groupBy("_c").agg(F.max("_upto").alias("_size"))
    upto, size = F.col("_upto"), F.col("_size")
    lower, upper = F.floor((size + 1) / 2), F.floor(size / 2) + 1
    middle = (
        ranked.join(F.broadcast(sizes), "_c")  # one row per column
        .groupBy("_c")
        .agg(
            F.min(F.when(upto >= lower, F.col("_v"))).alias("lo"),
            F.min(F.when(upto >= upper, F.col("_v"))).alias("hi"),
        )
        .collect()
    )
    found = {r["_c"]: (r["lo"] + r["hi"]) / 2 for r in middle}
    return {c: found.get(c) for c in columns}


def exact_median(df: DataFrame, col: str) -> float | None:
    """The mean of the two middle non-null values of ``col``."""
    return exact_medians(df, [col])[col]
