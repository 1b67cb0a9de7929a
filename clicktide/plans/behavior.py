"""The cleaned behaviour log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.functions import scalars as S
from clicktide.operators.cleaning import (
    DEDUP_KEYS,
    DEDUP_KEYS_WITH_BEHAVIOR,
    drop_invalid_time,
    map_behavior_code,
    survivor_order,
)
from clicktide.operators.sessions import SLOT, number_sessions, slot_of, slot_spans


_SMALLEST = -(2**63)


def merge_copies(
    log: DataFrame, keys: Sequence[str], behaviors: Sequence[str] | None, *extra: Column
) -> tuple[DataFrame, Column]:
    """One row per key, as ``dedup`` does, with further aggregates; and a condition that names
    every merged column and holds for every row.

    If the behaviours are known and only the category is left to choose, the survivor follows
    from plain numbers: the rank of its behaviour and the smallest category per behaviour.
    Spark then merges in a hash table. In general it has to sort.
    """
    rest = survivor_order(log.columns, keys)
    chosen = [c for c in rest if c != "behavior_type"]
    if not behaviors or len(chosen) != 1 or not isinstance(log.schema[chosen[0]].dataType, T.LongType):
        row = F.struct(*rest or [F.lit(1).alias("_one")])
        merged = log.groupBy(*keys).agg(F.min(row).alias("_row"), *extra)
        return merged.withColumns({c: F.col(f"_row.{c}") for c in rest}), F.col("_row").isNotNull()

    (category,) = chosen
    if "behavior_type" in keys:
        merged = log.groupBy(*keys).agg(F.min(category).alias(category), *extra)
        return merged, F.coalesce(category, F.lit(0)) >= _SMALLEST
    names = sorted(behaviors)
    b = F.col("behavior_type")
    rank = S.lookup(b, {name: i for i, name in enumerate(names)})
    smallest = [F.min(F.when(b == name, F.col(category))).alias(f"_c{i}") for i, name in enumerate(names)]
    merged = log.groupBy(*keys).agg(F.min(rank).alias("_rank"), *smallest, *extra)
    ranks = range(len(names))
    survivor = {
        "behavior_type": S.lookup(F.col("_rank"), dict(enumerate(names))),
        category: F.coalesce(*[F.when(F.col("_rank") == i, F.col(f"_c{i}")) for i in ranks]),
    }
    every = F.coalesce(*[F.col(f"_c{i}") for i in ranks], F.lit(0)) >= _SMALLEST
    return merged.withColumns(survivor), every & F.col("_rank").isNotNull()


def clean_behavior(
    log: DataFrame,
    pv_threshold: int = 500,
    timeout: int = 1800,
    per_behavior: bool = False,
    dedup_first: bool = True,
    behaviors: Sequence[str] | None = None,
) -> DataFrame:
    """Drop invalid times, copies, bot-like users and implausible buyers; number sessions.

    Rows without a user are dropped, and with ``per_behavior`` those without a behaviour: neither has
    a session.

    The three user rules all follow from one small table with a row per user and time slot:
    its views and purchases add up to the user's totals, its first and last time to sessions.
    So the rows themselves are shuffled twice only: once to merge copies (after a map-side
    merge) and once to meet that table, on a (user, slot) key that no single user can skew.

    ``per_behavior`` removes copies and numbers sessions within each behaviour type.
    ``dedup_first=False`` lets copies count towards the page-view threshold.
    ``behaviors`` keeps only these types, which also makes merging copies cheaper.
    """
    keys = DEDUP_KEYS_WITH_BEHAVIOR if per_behavior else DEDUP_KEYS
    series = ["user_id", "behavior_type"] if per_behavior else ["user_id"]
    is_view = F.col("behavior_type") == "pv"
    valid = drop_invalid_time(map_behavior_code(log)).where(F.col("user_id").isNotNull())
    if behaviors:
        valid = valid.where(F.col("behavior_type").isin(*behaviors))
    views = [] if dedup_first else [F.count_if(is_view).alias("_views")]
    rows, every = merge_copies(valid, keys, behaviors, *views)
    rows = rows.withColumn(SLOT, slot_of(timeout))
    # ``rows`` is used twice. Conditions that name every merged and join column, true though
    # they are, keep both uses alike, so that Spark merges once and reuses the shuffle.
    for c in (*series, SLOT):
        rows = rows.where(F.col(c).isNotNull())
    rows = rows.where(every)
    if not dedup_first:
        rows = rows.where(F.col("_views") >= 0)

    counted_views = F.count_if(is_view) if dedup_first else F.sum("_views")
    spans = slot_spans(
        rows,
        series,
        timeout,
        counted_views.alias("_pv_counted"),
        F.count_if(is_view).alias("_pv"),
        F.count_if(F.col("behavior_type") == "buy").alias("_buy"),
    )
    whole_user = Window.partitionBy("user_id")
    numbered = number_sessions(spans, series, timeout)
    good = (
        numbered.withColumns(
            {c: F.sum(c).over(whole_user) for c in ("_pv_counted", "_pv", "_buy")}
        )
        .where((F.col("_pv_counted") <= pv_threshold) & (F.col("_buy") <= F.col("_pv")))
        .select(*series, SLOT, "session_id")
    )
    return rows.join(good, [*series, SLOT]).select(*log.columns, "session_id")
