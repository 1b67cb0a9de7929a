"""From the raw behaviour CSV to the cleaned, partitioned log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clicktide.functions.scalars import BEHAVIORS
from clicktide.operators.cleaning import removal_report
from clicktide.operators.quality import quality_report
from clicktide.plans.behavior import clean_behavior
from clicktide.sources.readers import BEHAVIOR_SCHEMA, read_behavior_csv
from clicktide.sources.writers import storage_report, write_partitioned


def run_etl(
    spark: SparkSession,
    csv_path: str,
    out: str,
    schema=BEHAVIOR_SCHEMA,
    codec: str = "zstd",
    level: int | None = 3,
    **cleaning,
) -> DataFrame:
    """Read once as text, clean, write by behaviour; returns the written table.

    The raw log is not copied to a staging table first: the cleaning reads the CSV with the
    columns it needs. Only the four behaviour types are kept. ``cleaning`` goes to
    ``clean_behavior``.
    """
    cleaning = {"behaviors": BEHAVIORS} | cleaning
    cleaned = clean_behavior(read_behavior_csv(spark, csv_path, schema), **cleaning)
    write_partitioned(cleaned, out, "behavior_type", codec=codec, level=level)
    return spark.read.parquet(out)


def etl_reports(
    spark: SparkSession, csv_path: str, out: str, original_mb: float, min_rows: int, schema=BEHAVIOR_SCHEMA
) -> dict[str, DataFrame]:
    """Rows removed, storage saved, and the checks of the result."""
    written = spark.read.parquet(out)
    return {
        "removed": removal_report(read_behavior_csv(spark, csv_path, schema), written),
        "storage": storage_report(spark, out, "behavior_type", original_mb),
        "quality": quality_report(written, min_rows=min_rows),
    }
