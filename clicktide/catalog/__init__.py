"""Registered queries: each runs on the supplied tables, most with an equivalent SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clicktide.session import DEFAULTS, ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Add a query under ``name``, with the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            for key, value in DEFAULTS.items():
                spark.conf.set(key, value)
            return fn(spark, sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load_all() -> None:
    from clicktide.catalog import batch, learned, review, stream  # noqa: F401
