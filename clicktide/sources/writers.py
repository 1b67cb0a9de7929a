"""Writers, compaction and storage figures."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.session import scratch


def write_parquet(
    df: DataFrame,
    path: str,
    by: list[str] | None = None,
    codec: str = "snappy",
    level: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Parquet, by partition value if ``by`` is given, in one job for all values.

    ``codec`` is zstd, snappy, lz4 or none; ``level`` applies to zstd.
    """
    writer = df.write.mode(mode).option("compression", codec)
    if codec == "zstd" and level is not None:
        writer = writer.option("parquet.compression.codec.zstd.level", level)
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)


def write_partitioned(df: DataFrame, path: str, by: str | list[str], **options) -> None:
    """Parquet by key.

    Rows are rebalanced on the key first, so each value gets few, well filled files; a value
    with a large part of the rows is split over several tasks by adaptive execution.
    """
    keys = [by] if isinstance(by, str) else by
    write_parquet(df.hint("rebalance", *keys), path, keys, **options)


def compact(spark: SparkSession, root: str, out: str, **options) -> None:
    """Merge a partitioned directory into one dataset of evenly sized files."""
    write_parquet(spark.read.parquet(root).hint("rebalance"), out, **options)


def replace_partitions(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Overwrite ``path`` with ``df``, even if ``df`` reads from ``path``.

    Everything is written next to the target and swapped in by rename when complete.
    """
    spark = df.sparkSession
    target = path.rstrip("/")
    staging, old = f"{target}.staging", f"{target}.old"
    write_parquet(df, staging, by)
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(target)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(hadoop.Path(old), True)
    if fs.exists(where) and not fs.rename(where, hadoop.Path(old)):
        raise OSError(f"could not move {target} to {old}")
    if not fs.rename(hadoop.Path(staging), where):
        fs.rename(hadoop.Path(old), where)
        raise OSError(f"could not move {staging} to {target}")
    fs.delete(hadoop.Path(old), True)
    spark.catalog.refreshByPath(target)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header in UTF-8; spaces around values are kept."""
    df.write.mode(mode).csv(
        path,
        header=True,
        encoding="UTF-8",
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def storage_report(spark: SparkSession, root: str, partition: str, original_mb: float) -> DataFrame:
    """Files and MB per partition value, MB in total and percent saved against the original.

    Only the list of files is read, never their rows; a file's value is in its path.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
    )
    value = F.regexp_extract("path", f"/{re.escape(partition)}=([^/]*)/", 1)
    files = listed.select(F.url_decode(value).alias(partition), F.col("length").alias("file_size"))
    per_value = files.groupBy(partition).agg(
        F.count(F.lit(1)).alias("files"), (F.sum("file_size") / (1024 * 1024)).alias("mb")
    )
    total = files.agg(
        F.lit("TOTAL").alias(partition),
        F.count(F.lit(1)).alias("files"),
        (F.sum("file_size") / (1024 * 1024)).alias("mb"),
    )
    saving = F.when(
        F.col(partition) == "TOTAL", (1 - F.col("mb") / F.lit(float(original_mb))) * 100
    )
    return per_value.withColumn(partition, F.col(partition).cast("string")).unionByName(
        total
    ).withColumn("saving_pct", saving)


def round_trip(df: DataFrame, name: str, by: str) -> DataFrame:
    """Write by partition into the shared folder and read back."""
    path = scratch(df.sparkSession, name)
    write_partitioned(df, path, by)
    return df.sparkSession.read.parquet(path)
