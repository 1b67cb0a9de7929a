"""Pages, slices and reproducible samples that stay exact and distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktide.functions.scalars import hash_key
from clicktide.operators.ordered import block_of, prefix_sum
from clicktide.session import materialize

_BUCKET_HEX = 5  # 16**5 buckets: an offset table of at most 1,048,576 rows per class


def page(df: DataFrame, key: str, offset: int = 0, limit: int = 20) -> DataFrame:
    """Rows ``offset`` .. ``offset + limit - 1`` by the unique integer ``key``, plus ``total``.

    Keys are counted in blocks of 65,536. The page's blocks give a key range that the scan can
    prune on and an offset inside it of less than one block, so a page deep in the table
    neither sorts nor collects what lies before it.
    """
    if offset < 0 or not 1 <= limit <= 100:
        raise ValueError("offset must be >= 0 and limit within 1..100")
    needed = blocks_of_range(df, key, offset, offset + limit)
    found = needed.where("_needed").agg(
        F.min("_block").alias("first"), F.max("_block").alias("last"), F.min("_start").alias("start")
    ).first()
    total = needed.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if found["first"] is None:
        return df.limit(0).withColumns({"position": F.lit(offset).cast("bigint"), "total": F.lit(total)})
    in_range = F.col(key).between(found["first"] << 16, ((found["last"] + 1) << 16) - 1)
    rows = df.where(in_range).orderBy(key).offset(offset - found["start"]).limit(limit)
    # At most 100 rows are left to number.
    order = Window.partitionBy(F.lit(0)).orderBy(key)
    return rows.withColumns(
        {
            "position": (F.row_number().over(order) + (offset - 1)).cast("bigint"),
            "total": F.lit(total).cast("bigint"),
        }
    )


def blocks_of_range(df: DataFrame, key: str, start: int, stop: int) -> DataFrame:
    """Blocks of keys with their size, the position of their first row, and whether they reach
    into positions ``start`` .. ``stop - 1``."""
    counts = df.groupBy(block_of(key).alias("_block")).agg(F.count(F.lit(1)).alias("_n"))
    placed = prefix_sum(counts, "_block", "_n", "_start")
    reaches = (F.col("_start") < stop) & (F.col("_start") + F.col("_n") > start)
    return placed.withColumn("_needed", reaches)


def slice_rows(df: DataFrame, key: str, start: int, stop: int) -> DataFrame:
    """Rows by position, ``start`` included and ``stop`` not, in order of ``key``.

    However long the slice, rows are numbered inside their block of at most 65,536 keys.
    """
    needed = blocks_of_range(df, key, start, stop).where("_needed").select("_block", "_start")
    needed = materialize(needed, "needed")
    ends = needed.agg(F.min("_block"), F.max("_block")).first()
    if ends[0] is None:
        return df.limit(0).withColumn("position", F.lit(0).cast("bigint"))
    # A range of keys that the scan can prune on.
    in_range = F.col(key).between(ends[0] << 16, ((ends[1] + 1) << 16) - 1)
    rows = df.where(in_range).withColumn("_block", block_of(key)).join(needed, "_block")
    inside = Window.partitionBy("_block").orderBy(key)
    position = F.col("_start") + F.row_number().over(inside) - 1
    return (
        rows.withColumn("position", position.cast("bigint"))
        .where((F.col("position") >= start) & (F.col("position") < stop))
        .select(*df.columns, "position")
        .orderBy(key)
    )


def hash_rank(
    df: DataFrame,
    id_col: str,
    seed: int | str = 42,
    group: Sequence[str] = (),
    out: str = "rank",
    first: int | None = None,
) -> DataFrame:
    """1-based rank of each row in the order of md5(id, seed), per group; nulls are a group too.

    The hash spreads rows evenly over about a million buckets whatever the data. Buckets are
    counted and their starts summed up; the ranking itself happens inside a bucket. With
    ``first`` only rows in buckets that begin before that rank are ranked and returned: a bucket
    holds at least one row, so these are at most ``first`` buckets of a group.
    """
    hashed = F.coalesce(hash_key(id_col, seed), F.lit("0" * 32))  # rows without an id come first
    keyed = df.withColumn("_hash", hashed).withColumn("_bucket", F.substring("_hash", 1, _BUCKET_HEX))
    # Keys that are never null stand for the group's columns.
    owner = []
    for i, g in enumerate(group):
        text = F.col(g).cast("string")
        keyed = keyed.withColumns({f"_g{i}": F.coalesce(text, F.lit("")), f"_z{i}": text.isNull()})
        owner += [f"_g{i}", f"_z{i}"]
    keys = [*owner, "_bucket"]
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    owner = owner or [F.lit(0)]
    before = (
        Window.partitionBy(*owner).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*owner)
    starts = counts.withColumns(
        {
            "_start": F.coalesce(F.sum("_n").over(before), F.lit(0)),
            "group_size": F.sum("_n").over(whole),
        }
    ).drop("_n")
    inside = Window.partitionBy(*keys).orderBy("_hash", id_col)
    local = F.row_number().over(inside)
    if first is None:
        placed = keyed.withColumn("_local", local).join(starts, keys)
    else:
        # Written first, so that Spark knows its size: a small one is broadcast, and the rows of
        # all other buckets go before anything is shuffled.
        needed = materialize(starts.where(F.col("_start") < first), "buckets")
        placed = keyed.join(needed, keys).withColumn("_local", local)
    return placed.withColumn(out, (F.col("_start") + F.col("_local")).cast("bigint")).drop(
        "_hash", *keys, "_local", "_start"
    )


def sample_n(df: DataFrame, id_col: str, n: int, seed: int | str = 42) -> DataFrame:
    """``n`` rows, the same ones every time."""
    ranked = hash_rank(df, id_col, seed, first=n)
    return ranked.where(F.col("rank") <= n).drop("rank", "group_size")


def balanced_sample(
    df: DataFrame, label: str, id_col: str, n: int, seed: int | str = 42
) -> DataFrame:
    """Up to ``n`` rows of each class, with ``rank`` as the shuffled order inside the class."""
    ranked = hash_rank(df, id_col, seed, [label], first=n)
    return ranked.where(F.col("rank") <= n).drop("group_size")


def stratified_split(
    df: DataFrame, label: str, id_col: str, share: float = 0.2, seed: int | str = 42
) -> DataFrame:
    """Add ``is_test``: the same share of every class, rounded to whole rows."""
    return (
        hash_rank(df, id_col, seed, [label])
        .withColumn("is_test", F.col("rank") <= F.round(F.col("group_size") * F.lit(share)))
        .drop("rank", "group_size")
    )


def stratified_folds(
    df: DataFrame, label: str, id_col: str, folds: int = 5, seed: int | str = 42
) -> DataFrame:
    """Add ``fold`` 0..folds-1, dealing every class out evenly."""
    return (
        hash_rank(df, id_col, seed, [label])
        .withColumn("fold", F.pmod(F.col("rank") - 1, F.lit(folds)).cast("int"))
        .drop("rank", "group_size")
    )
