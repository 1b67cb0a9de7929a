"""Standardising a stream with figures from its start, and how far it drifts from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.functions.scalars import to_number

Scaling = dict[str, tuple[float, float, float]]


def fit_scaling(df: DataFrame, columns: Sequence[str], order: Sequence[str], n: int = 1000) -> Scaling:
    """Median, mean and population deviation of the first ``n`` rows, which are few by design.

    Missing values count as the median; a deviation of zero becomes one.
    """
    head = df.orderBy(*order).limit(n).select(*[to_number(c).alias(c) for c in columns])
    medians = head.agg(*[F.median(c).alias(c) for c in columns]).first().asDict()
    filled = head.fillna({c: m for c, m in medians.items() if m is not None})
    stats = filled.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
    ).first()
    return {c: (medians[c], stats[f"mean_{c}"], stats[f"std_{c}"] or 1.0) for c in columns}


def z_score(column: str, scaling: Scaling) -> Column:
    median, mean, std = scaling[column]
    return (F.coalesce(to_number(column), F.lit(median)) - F.lit(mean)) / F.lit(std)


def drift_report(df: DataFrame, scaling: Scaling) -> DataFrame:
    """Mean and population deviation of the z-scores per column; batch or stream (complete)."""
    aggregates = []
    for c in scaling:
        z = z_score(c, scaling)
        aggregates += [F.avg(z).alias(f"z_mean_{c}"), F.stddev_pop(z).alias(f"z_std_{c}")]
    return df.agg(F.count(F.lit(1)).alias("consumed"), *aggregates)
