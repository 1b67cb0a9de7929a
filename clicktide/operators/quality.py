"""Data-quality checks: one result row each, with name, passed and detail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.functions.scalars import BEHAVIORS
from clicktide.operators.cleaning import DEDUP_KEYS_WITH_BEHAVIOR

# What the behaviour log must hold.
REQUIRED_COLUMNS = ("user_id", "item_id", "behavior_type", "timestamp")
MIN_ROWS = 10_000_000
MAX_NULL_RATIO = 0.01

RESULT = "check string, passed boolean, detail string"


def _result(name: str, passed: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"), passed.alias("passed"), detail.cast("string").alias("detail")
    )


def quality_report(
    df: DataFrame,
    min_rows: int = MIN_ROWS,
    allowed: Sequence[str] = BEHAVIORS,
    required: Sequence[str] = REQUIRED_COLUMNS,
    max_null_ratio: float = MAX_NULL_RATIO,
) -> DataFrame:
    """All checks on a behaviour log, from one scan.

    Rows are grouped by the duplicate key, groups by user, and users to one row. Everything
    that is checked is a function of the key, so each step adds up the counts of the one
    before; copies and hot users are merged before each shuffle. Duplicates are looked for in
    all rows, not in a sample.
    """
    missing = [c for c in required if c not in df.columns]
    rows = F.col("rows")
    size = [
        _result("rows_present", rows > 0, rows),
        _result("rows_enough", rows >= min_rows, rows),
        _result("columns_present", F.lit(not missing), F.lit(",".join(missing))),
    ]
    if missing:
        counted = df.agg(F.count(F.lit(1)).alias("rows"))
        return counted.select(F.inline(F.array(*size)))

    nulls = {f"null_{c}": F.col(c).isNull() for c in required}
    empty = F.lit(True)
    for condition in nulls.values():
        empty = empty & condition
    conditions = nulls | {"empty": empty}
    groups = df.groupBy(*DEDUP_KEYS_WITH_BEHAVIOR).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(condition).alias(name) for name, condition in conditions.items()],
    )
    b = F.col("behavior_type")

    def rows_if(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0))

    per_user = groups.groupBy("user_id").agg(
        F.sum("rows").alias("rows"),
        F.sum(rows - 1).alias("copies"),
        rows_if(b == "buy").alias("buys"),
        rows_if(b == "pv").alias("views"),
        rows_if(~F.coalesce(b.isin(*allowed), F.lit(False))).alias("outside"),
        rows_if(F.col("timestamp") < 0).alias("negative"),
        *[F.sum(name).alias(name) for name in conditions],
    )
    summed = ("rows", "copies", "outside", "negative", *conditions)
    totals = per_user.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in summed],
        F.count_if(F.col("buys") > F.col("views")).alias("violators"),
    )

    def none(name: str, counter: str) -> Column:
        return _result(name, F.col(counter) == 0, F.col(counter))

    checks = [
        *size,
        none("behavior_domain", "outside"),
        none("no_empty_row", "empty"),
        none("no_negative_time", "negative"),
        *[
            _result(
                f"null_ratio_{c}",
                F.col(f"null_{c}") <= rows * F.lit(max_null_ratio),
                F.col(f"null_{c}"),
            )
            for c in required
        ],
        none("buy_within_pv", "violators"),
        none("no_duplicates", "copies"),
    ]
    return totals.select(F.inline(F.array(*checks)))


def cleaned_log_report(df: DataFrame) -> DataFrame:
    """Checks of a cleaned raw web log: lower-case types, 64-digit hashes, no missing id."""
    t, u = F.col("event_type"), F.col("masked_user_id")
    upper = F.count_if(t.isNull() | (t != F.lower(t)))
    short = F.count_if(u.isNull() | (F.length(u) != 64))
    no_id = F.count_if(F.col("event_id").isNull())
    checks = [
        _result("types_lower_case", upper == 0, upper),
        _result("hash_length", short == 0, short),
        _result("event_id_present", no_id == 0, no_id),
    ]
    return df.agg(F.array(*checks).alias("r")).select(F.inline("r"))


def summary(report: DataFrame) -> DataFrame:
    return report.agg(F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("checks"))


def check_path(spark: SparkSession, path: str, **limits) -> DataFrame:
    """Reachability of a Parquet path first, then the full report if it can be read."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        row = [("readable", False, str(error.getCondition()))]
        return spark.createDataFrame(row, RESULT)
    readable = spark.createDataFrame([("readable", True, path)], RESULT)
    return readable.unionByName(quality_report(df, **limits))
