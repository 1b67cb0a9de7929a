"""Character TF-IDF with smoothed idf and L2 norm, and its fusion with dense columns.

Fitting counts characters in one pass; only per-character totals are shuffled. Applying it is
a chain of Spark ML transformers on each row, without any shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.session import small_batches


def tidy_text(text: Column) -> Column:
    """Lower-cased text; a run of two or more white spaces counts as one space."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s\s+", " ")


def characters(text: Column) -> Column:
    return F.array_remove(F.split(tidy_text(text), ""), "")


def _count_characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Uses and documents of every character of a task, and its number of documents."""
    uses, documents, n = Counter(), Counter(), 0
    for batch in batches:
        for value in batch.column("text"):  # one text at a time
            text = value.as_py()
            uses.update(text)
            documents.update(set(text))
            n += 1
    if n:
        rows = [(c, k, documents[c]) for c, k in uses.items()] + [(None, 0, n)]
        columns = [pa.array(x) for x in zip(*rows)]
        kinds = (pa.string(), pa.int64(), pa.int64())
        arrays = [c.cast(k) for c, k in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, ["c", "tf", "df"])


@dataclass
class CharTfidf:
    """A fitted vocabulary, in character order, with its idf weights."""

    vocabulary: list[str]
    idf: list[float]

    def transform(self, df: DataFrame, column: str, out: str) -> DataFrame:
        chars, counts, weighted = f"_{out}_chars", f"_{out}_counts", f"_{out}_weighted"
        stages = [
            CountVectorizerModel.from_vocabulary(self.vocabulary, inputCol=chars, outputCol=counts),
            ElementwiseProduct(
                scalingVec=Vectors.dense(self.idf), inputCol=counts, outputCol=weighted
            ),
            Normalizer(p=2.0, inputCol=weighted, outputCol=out),
        ]
        prepared = df.withColumn(chars, characters(F.col(column)))
        return PipelineModel(stages).transform(prepared).drop(chars, counts, weighted)


def fit_char_tfidf(df: DataFrame, column: str, max_features: int = 500) -> CharTfidf:
    """The ``max_features`` most frequent characters; idf = ln((1 + n) / (1 + df)) + 1.

    Characters are counted task by task; a task gives one row for each of its characters, and one
    without a character for its number of documents.
    """
    small_batches(df.sparkSession)
    counted = (
        df.select(tidy_text(F.col(column)).alias("text"))
        .mapInArrow(_count_characters, "c string, tf bigint, df bigint")
        .groupBy("c")
        .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    )
    documents = counted.where(F.col("c").isNull()).first()
    if documents is None:
        return CharTfidf([], [])
    n = documents["df"]
    top = counted.where(F.col("c").isNotNull()).orderBy(F.desc("tf"), "c").limit(max_features)
    kept = sorted(top.collect(), key=lambda r: r["c"])
    return CharTfidf(
        [r["c"] for r in kept], [math.log((1 + n) / (1 + r["df"])) + 1 for r in kept]
    )


def weights(df: DataFrame, key: str, vector: str, names: Sequence[str]) -> DataFrame:
    """Non-zero entries of a vector column as rows (key, feature, weight)."""
    named = F.array(*[F.lit(n) for n in names])
    return entries(df.select(key, vector), vector).select(
        key, F.get(named, F.col("_i")).alias("feature"), F.col("_x").alias("weight")
    )


def entries(df: DataFrame, vector: str) -> DataFrame:
    """The other columns with ``_i`` and ``_x`` of each non-zero entry; sparse vectors stay sparse."""
    v = F.unwrap_udt(F.col(vector))
    places = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
    pairs = F.arrays_zip(places.alias("i"), v["values"].alias("x"))
    rest = [c for c in df.columns if c != vector]
    return df.select(*rest, F.inline(pairs).alias("_i", "_x")).where(F.col("_x") != 0)


def fuse(df: DataFrame, sparse: str, dense: Sequence[str], width: int, out: str = "features") -> DataFrame:
    """Sparse vector and dense columns in one vector of checked ``width``."""
    fused = VectorAssembler(inputCols=[sparse, *dense], outputCol=out).transform(df)
    size = fused.schema[out].metadata.get("ml_attr", {}).get("num_attrs")
    if size != width:
        raise ValueError(f"fused vectors have {size} columns, expected {width}")
    return fused
