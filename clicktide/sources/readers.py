"""Readers for behaviour logs, raw web logs, reviews and event streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column names of the headerless behaviour CSV.
BEHAVIOR_COLUMNS = ("user_id", "item_id", "category_id", "behavior_type", "timestamp")

BEHAVIOR_SCHEMA = T.StructType(
    [
        T.StructField(c, T.StringType() if c == "behavior_type" else T.LongType())
        for c in BEHAVIOR_COLUMNS
    ]
)
BEHAVIOR_SCHEMA_INT = T.StructType(
    [
        T.StructField(c, T.StringType() if c == "behavior_type" else T.IntegerType())
        for c in BEHAVIOR_COLUMNS
    ]
)


def read_behavior_csv(
    spark: SparkSession, path: str, schema: T.StructType = BEHAVIOR_SCHEMA
) -> DataFrame:
    """Headerless five-column CSV. The schema is given, so nothing is scanned to infer it.

    A file with numeric behaviour codes is read with an integer ``behavior_type`` in ``schema``
    and passed on to ``map_behavior_code``. A ``merchant_id`` column is named ``category_id``.
    """
    df = spark.read.schema(schema).csv(path, mode="PERMISSIVE")
    return df.withColumnsRenamed({"merchant_id": "category_id"})


def read_csv_inferred(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header; fields may hold quoted JSON.

    Types are inferred by one more scan unless a schema is given. Files are split over tasks;
    ``multi_line`` lets fields hold line breaks, and then each file is one task.
    """
    reader = spark.read.schema(schema) if schema else spark.read.option("inferSchema", True)
    return reader.csv(path, header=True, multiLine=multi_line, escape='"')


def looks_like_header(cells: Sequence[str | None], expected: Sequence[str] = BEHAVIOR_COLUMNS) -> bool:
    """At least two cells of the first row are expected column names."""
    known = {name.lower() for name in expected}
    return sum((cell or "").strip().lower() in known for cell in cells) >= 2


def sniff_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with or without a header; all columns as text.

    Without one, five columns get the standard names and others ``col_0``, ``col_1``, ...
    """
    first = spark.read.csv(path, header=False).head(1)
    if not first:
        raise ValueError(f"no rows in {path}")
    if looks_like_header(list(first[0])):
        return spark.read.csv(path, header=True)
    width = len(first[0])
    names = BEHAVIOR_COLUMNS if width == 5 else [f"col_{i}" for i in range(width)]
    return spark.read.csv(path, header=False).toDF(*names)


def read_partitioned(spark: SparkSession, root: str) -> DataFrame:
    """Hive-style directory; the partition value becomes a column and prunes files."""
    return spark.read.parquet(root)


def read_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """Many Parquet files as one table, without partition columns."""
    return spark.read.option("recursiveFileLookup", "true").parquet(pattern)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name."""
    first, *others = frames
    for other in others:
        first = first.unionByName(other)
    return first


def read_event_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New lines of text files as they arrive, in ``value``; parsing comes later, so that a
    broken line can still be kept as it was. ``max_files_per_trigger`` bounds the intake."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)
