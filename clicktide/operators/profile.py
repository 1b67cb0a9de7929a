"""Aggregates over the behaviour log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktide.functions import scalars as S


def value_counts(df: DataFrame, column: str, out: str = "count") -> DataFrame:
    """Rows per value, most frequent first, equal counts by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), column)


def top_k(df: DataFrame, column: str, k: int, out: str = "count") -> DataFrame:
    return value_counts(df, column, out).limit(k)


def profile_nulls(df: DataFrame) -> DataFrame:
    b = F.col("behavior_type")
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("user_id").isNull()).alias("user_id_null"),
        F.count_if(b.isNull() | (b == "")).alias("behavior_type_null"),
    )


def profile_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Smallest and largest raw value, the same as times over valid rows, and invalid rows."""
    t = F.col(column)
    valid = F.when(t > 0, t)
    return df.agg(
        F.min(t).alias("min_ts"),
        F.max(t).alias("max_ts"),
        F.timestamp_seconds(F.min(valid)).alias("min_date"),
        F.timestamp_seconds(F.max(valid)).alias("max_date"),
        F.count_if(t <= 0).alias("invalid_count"),
    )


def unique_visitors(df: DataFrame, approximate: bool = False) -> DataFrame:
    counted = F.approx_count_distinct("user_id") if approximate else F.count_distinct("user_id")
    return df.agg(counted.alias("uv_count"))


def hourly_activity(df: DataFrame, behaviors: tuple[str, ...] = ("pv", "buy")) -> DataFrame:
    return (
        df.where(F.col("behavior_type").isin(*behaviors) & (F.col("timestamp") > 0))
        .groupBy(S.hour_of("timestamp").alias("hour"), "behavior_type")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy("hour", "behavior_type")
    )


def purchase_peak(df: DataFrame) -> DataFrame:
    """The hour with most purchases, the earliest of equals."""
    hours = hourly_activity(df, ("buy",))
    return hours.select("hour", "cnt").orderBy(F.desc("cnt"), "hour").limit(1)


def suspect_impact(df: DataFrame, threshold: int = 500) -> DataFrame:
    """How many users exceed the threshold, and their part of all page views."""
    per_user = (
        df.where(F.col("behavior_type") == "pv")
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("pv_count"))
    )
    hot = F.col("pv_count") > threshold
    sums = per_user.agg(
        F.count_if(hot).alias("suspects"),
        F.coalesce(F.sum(F.when(hot, F.col("pv_count"))), F.lit(0)).alias("suspect_pv"),
        F.coalesce(F.sum("pv_count"), F.lit(0)).alias("total_pv"),
    )
    return sums.withColumn("suspect_ratio", S.ratio(F.col("suspect_pv"), F.col("total_pv")))


def funnel(df: DataFrame) -> DataFrame:
    """Users who viewed; of those, who saved or carted; of those, who bought. Order-free."""
    b = F.col("behavior_type")
    per_user = df.groupBy("user_id").agg(
        F.max(b == "pv").alias("viewed"),
        F.max(b.isin("fav", "cart")).alias("wanted"),
        F.max(b == "buy").alias("bought"),
    )
    wanted = F.col("viewed") & F.col("wanted")
    counts = per_user.agg(
        F.count_if("viewed").alias("pv_users"),
        F.count_if(wanted).alias("fav_cart_users"),
        F.count_if(wanted & F.col("bought")).alias("buy_users"),
    )
    return counts.withColumns(
        {
            "fav_cart_rate": S.ratio(F.col("fav_cart_users"), F.col("pv_users")),
            "buy_rate": S.ratio(F.col("buy_users"), F.col("fav_cart_users")),
        }
    )


def user_behaviors(df: DataFrame) -> DataFrame:
    """The sorted set of behaviours of each user."""
    return df.groupBy("user_id").agg(
        F.array_sort(F.collect_set("behavior_type")).alias("behaviors")
    )


def behavior_share(df: DataFrame, column: str = "behavior_type") -> DataFrame:
    """Rows per behaviour and their percentage of all rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    # Rows are counted apart: any column may be asked for, and its values may be many.
    return counts.withColumn("pct", F.col("cnt") * 100.0 / F.lit(df.count()))


def hot_item_share(df: DataFrame, top: float = 0.2, item: str = "item_id") -> DataFrame:
    """Share of all rows that go to the most frequent ``top`` part of the items (at least one).

    Items are grouped by their row count first. There can be at most sqrt(2 * rows) different
    counts, so the ranking window stays small even with billions of items; items with equal
    counts are interchangeable for the sum.
    """
    per_item = df.groupBy(item).agg(F.count(F.lit(1)).alias("traffic"))
    by_count = per_item.groupBy("traffic").agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(0))
    above = everything.orderBy(F.desc("traffic")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = by_count.withColumns(
        {
            "_before": F.coalesce(F.sum("n").over(above), F.lit(0)),
            "_items": F.sum("n").over(everything),
            "_rows": F.sum(F.col("n") * F.col("traffic")).over(everything),
        }
    )
    hot = F.greatest(F.lit(1), F.floor(F.col("_items") * F.lit(top))).cast("bigint")
    taken = F.greatest(F.lit(0), F.least(F.col("n"), hot - F.col("_before")))
    sums = ranked.agg(
        F.max("_items").alias("items"),
        F.max(hot).alias("hot_items"),
        F.sum(taken * F.col("traffic")).alias("hot_rows"),
        F.max("_rows").alias("total_rows"),
    )
    return sums.withColumn("hot_share", S.ratio(F.col("hot_rows"), F.col("total_rows")))


def disallowed_behaviors(df: DataFrame, allowed: tuple[str, ...] = S.BEHAVIORS) -> DataFrame:
    """Behaviours that occur but are not allowed."""
    return df.select("behavior_type").where(~F.col("behavior_type").isin(*allowed)).distinct()
