"""Features for purchase prediction: building, imputing, scaling, encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.functions import scalars as S
from clicktide.operators.ordered import exact_medians, null_safe_join, running_position

# The model's inputs.
NUMERIC = ("user_id", "item_id", "category_id", "hour", "dayofweek", "is_weekend")
CATEGORICAL = ("hour_bucket", "day_bucket")


def buy_features(log: DataFrame, *keep: str, with_label: bool = True) -> DataFrame:
    """Model inputs of each event; the label says whether it is a purchase.

    Ids and time are coerced to numbers. Without a usable time, hour and day stay null and
    their buckets are -1.
    """
    ts = S.to_number("timestamp")
    hour, day = F.hour(F.timestamp_seconds(ts)), F.weekday(F.timestamp_seconds(ts))
    label = [(S.normalize_behavior("behavior_type") == "buy").cast("int").alias("label")]
    return log.select(
        *keep,
        *[S.to_number(c).alias(c) for c in ("user_id", "item_id", "category_id")],
        hour.alias("hour"),
        day.alias("dayofweek"),
        F.coalesce(S.weekend_flag(day), F.lit(0.0)).alias("is_weekend"),
        F.coalesce(hour, F.lit(-1)).cast("string").alias("hour_bucket"),
        F.coalesce(day, F.lit(-1)).cast("string").alias("day_bucket"),
        *(label if with_label else []),
    )


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return exact_medians(df, columns)


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    found = medians(df, columns)
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(found[c])) for c in columns}
    )


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent non-null value per column, the smallest of equals.

    Columns of one type are counted in one job, as pairs of column and value."""
    found: dict = dict.fromkeys(columns)
    by_type: dict[str, list[str]] = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    for names in by_type.values():
        pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in names])).alias("p"))
        counts = pairs.where("p.v IS NOT NULL").groupBy("p.c", "p.v").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("c").agg(F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("best"))
        found |= {r.c: r.best.v for r in best.collect()}  # a row per column
    return found


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    found = {c: m for c, m in modes(df, columns).items() if m is not None}
    return df.fillna(found)


def scale_figures(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column in one pass; a deviation of zero becomes one."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
    ).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in columns}


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    figures = scale_figures(df, columns)
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in figures.items()})


def one_hot(columns: Sequence[str], suffix: str = "_vec") -> list:
    """Stages that one-hot encode; a value not seen in fitting becomes all zeros.

    The indexer keeps unseen values as an extra last index, which the encoder leaves out.
    """
    indexed = [f"{c}_index" for c in columns]
    return [
        StringIndexer(
            inputCols=list(columns),
            outputCols=indexed,
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=indexed, outputCols=[f"{c}{suffix}" for c in columns], dropLast=True
        ),
    ]


def fit_ordinal(df: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """Per column, a dictionary of the sorted distinct values and their codes from 0."""
    books = {}
    for c in columns:
        values = df.select(F.col(c).cast("string").alias("value")).where("value is not null").distinct()
        placed = running_position(values, [], ["value"])
        books[c] = placed.select("value", (F.col("position") - 1).alias("code"))
    return books


def ordinal_encode(
    df: DataFrame, columns: Sequence[str], books: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Replace values by their codes; a value not in the dictionary becomes -1.

    The dictionary is joined without a hint: Spark broadcasts it only where it measures small.
    """
    books = books or fit_ordinal(df, columns)
    for c in columns:
        book = books[c].select(F.col("value").alias(c), F.col("code").alias("_code"))
        joined = null_safe_join(df.withColumn(c, F.col(c).cast("string")), book, [c], "left")
        df = joined.withColumn(c, F.coalesce("_code", F.lit(-1)).cast("bigint")).drop("_code")
    return df
