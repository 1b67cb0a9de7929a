"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per Arrow batch where Python sees whole texts, so that a batch of long texts stays small.
TEXT_BATCH_ROWS = 512
#: Bytes per Arrow batch, whatever its rows; a longer text is a batch of its own.
TEXT_BATCH_BYTES = 8 << 20
#: Fixed value: rows whose crc32(id) gives this remainder modulo 5 are held out from training.
FOLDS, HELD_OUT_FOLD = 5, 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes that one Arrow batch hands to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BATCH_BYTES))


def whole_text(col: str = "text") -> Column:
    """The text; a null text counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def whole_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, _row): rows packed into one column, so that no name of theirs can clash."""
    return docs.select("doc_id", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows of the held-out fold; a null id belongs to it, so it never trains a model."""
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(True))


def training_labels(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label) of the training folds; ids with null or contradicting labels are left out."""
    return (
        labels.where(~held_out() & F.col(column).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min(column).alias("label"), F.max(column).alias("_high"))
        .where(F.col("label") == F.col("_high"))
        .select("doc_id", F.col("label").cast("int").alias("label"))
    )


def bounded_sample(ids: DataFrame, n: int, seed: int) -> DataFrame:
    """The ``n`` rows whose hashed doc_id comes first: at most ``n``, the same on every run."""
    return ids.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(n)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0)))


def adam(
    params: np.ndarray, gradient, steps: int, rate: float = 0.05
) -> Iterator[np.ndarray]:
    """Adam updates of ``params`` by ``gradient(params)``; yields the parameters of each step."""
    first, second = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, steps + 1):
        g = gradient(params)
        first += 0.1 * (g - first)
        second += 0.001 * (g * g - second)
        step = (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        params = params - rate * step
        yield params


def single_threaded() -> None:
    """Tokenizer libraries start threads of their own; a Spark task has one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
