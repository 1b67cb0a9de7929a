"""Filters, normalisation, de-duplication and removal of bot-like users."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.functions import scalars as S
from clicktide.operators.ordered import join_per_key

DEDUP_KEYS = ("user_id", "item_id", "timestamp")
DEDUP_KEYS_WITH_BEHAVIOR = ("user_id", "item_id", "behavior_type", "timestamp")


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename columns; a name that is absent is ignored."""
    return df.withColumnsRenamed(names)


def map_behavior_code(df: DataFrame, column: str = "behavior_type") -> DataFrame:
    """Numeric codes to names; an unknown code becomes its text. Text columns are kept."""
    as_text = F.col(column).cast("string")
    if isinstance(df.schema[column].dataType, T.NumericType):
        return df.withColumn(column, S.lookup(F.col(column), S.BEHAVIOR_CODES, as_text))
    return df.withColumn(column, as_text)


def drop_invalid_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    return df.where(F.col(column) > 0)


def drop_blank(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.where(F.col(c).isNotNull() & (F.col(c) != ""))
    return df


def valid_event_id(df: DataFrame, column: str = "event_id") -> Column:
    """Condition chosen from the column type: positive if numeric, not blank if text."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, T.NumericType):
        return c.isNotNull() & (c > 0)
    return c.isNotNull() & (c != "")


def mask_user_id(df: DataFrame, column: str = "user_id", out: str = "masked_user_id") -> DataFrame:
    return df.withColumn(out, S.mask_id(column)).drop(column)


def adaptive_clean(df: DataFrame) -> DataFrame:
    """Clean a raw web log, using the columns it happens to have."""
    present = set(df.columns)
    picked = [
        F.col("event_id"),
        S.standardize("event_type").alias("event_type"),
        S.mask_id("user_id").alias("masked_user_id"),
        F.col("device_info"),
        F.col("action_time" if "action_time" in present else "timestamp"),
    ]
    picked += [F.col(c) for c in ("ip_address", "ip") if c in present][:1]
    picked += [F.col("metadata")] if "metadata" in present else []
    return df.where(valid_event_id(df)).select(*picked)


def special_user_counts(df: DataFrame, column: str = "user_id") -> DataFrame:
    u = F.col(column)
    return df.agg(
        F.count_if(u == "-1").alias("minus_one"),
        F.count_if((u == "guest") | u.startswith("guest-")).alias("guests"),
    )


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: S.to_number(c) for c in columns})


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(subset))


def fill_unknown(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna("Unknown", subset=list(columns))


def survivor_order(columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    """Non-key columns in the order in which they decide which copy survives."""
    rest = [c for c in columns if c not in keys]
    return sorted(rest, key=lambda c: (c != "behavior_type", c))


def dedup(df: DataFrame, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """One row per key: smallest behaviour type, then smallest remaining columns.

    Copies are merged before the shuffle, so a group of many copies costs one row per task.
    """
    rest = survivor_order(df.columns, keys)
    if not rest:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def suspect_users(df: DataFrame, threshold: int = 500, dedup_first: bool = True) -> DataFrame:
    """Users with more than ``threshold`` valid page views."""
    views = drop_invalid_time(df).where(F.col("behavior_type") == "pv")
    if dedup_first:
        views = views.groupBy(*DEDUP_KEYS).agg(F.lit(1).alias("_one"))
    counts = views.groupBy("user_id").agg(F.count(F.lit(1)).alias("pv_count"))
    return counts.where(F.col("pv_count") > threshold)


def drop_suspects(df: DataFrame, suspects: DataFrame) -> DataFrame:
    """Anti-join; adaptive execution broadcasts the suspects only if they measure small."""
    return join_per_key(df, suspects.select("user_id"), ["user_id"], "left_anti").select(*df.columns)


def user_balance(df: DataFrame) -> DataFrame:
    """Purchases and page views per user; ``valid`` iff purchases do not exceed views."""
    counts = df.groupBy("user_id").agg(
        F.count_if(F.col("behavior_type") == "buy").alias("buy_cnt"),
        F.count_if(F.col("behavior_type") == "pv").alias("pv_cnt"),
    )
    return counts.withColumn("valid", F.col("buy_cnt") <= F.col("pv_cnt"))


def violators(df: DataFrame) -> DataFrame:
    return user_balance(df).where(~F.col("valid")).drop("valid")


def keep_valid_users(df: DataFrame, valid_users: DataFrame) -> DataFrame:
    return join_per_key(df, valid_users.select("user_id"), ["user_id"], "left_semi").select(*df.columns)


def numeric_columns(
    df: DataFrame, preferred: Sequence[str] = (), threshold: float = 0.6
) -> list[str]:
    """Columns to treat as numbers: preferred ones, else those that mostly parse.

    One aggregate over the table; only one row of shares reaches the driver.
    """
    chosen = [c for c in preferred if c in df.columns]
    if chosen:
        return chosen
    shares = numeric_shares(df).first().asDict()
    passing = [c for c in df.columns if shares[c] >= threshold]
    if len(passing) < 2:
        passing = sorted(df.columns, key=lambda c: -shares[c])[:4]
    return passing


def numeric_shares(df: DataFrame) -> DataFrame:
    """One row: per column, the share of non-blank values that parse as a number."""
    def share(c: str) -> Column:
        text = F.col(c).cast("string")
        filled = text.isNotNull() & (text != "")
        return F.coalesce(F.avg(F.when(filled, S.to_number(text).isNotNull().cast("double"))), F.lit(0.0))

    return df.agg(*[share(c).alias(c) for c in df.columns])


def removal_report(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Rows before and after, rows removed and the removed share in percent."""
    counted = raw.agg(F.count(F.lit(1)).alias("rows"), F.lit("raw").alias("side")).unionByName(
        clean.agg(F.count(F.lit(1)).alias("rows"), F.lit("clean").alias("side"))
    )
    both = counted.agg(
        F.max(F.when(F.col("side") == "raw", F.col("rows"))).alias("rows_before"),
        F.max(F.when(F.col("side") == "clean", F.col("rows"))).alias("rows_after"),
    )
    removed = F.col("rows_before") - F.col("rows_after")
    return both.withColumn("rows_removed", removed).withColumn(
        "removed_pct", S.ratio(removed * 100.0, F.col("rows_before"))
    )
