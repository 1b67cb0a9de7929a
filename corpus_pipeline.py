"""From raw documents to packed training sequences: each stage works on what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clicktide.llm import chunks, packing, quality, simhash, toxicity
from clicktide.llm.common import table
from clicktide.llm.queries import prepare, tokenizer_file
from clicktide.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier lets pass."""
    prepare(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier lets pass."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash fingerprints, as the operator's contract sets them."""
    prepare(spark)
    return simhash.representatives(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds."""
    prepare(spark)
    return chunks.remove_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in packed token sequences, with their ids."""
    prepare(spark)
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_bad),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("packing", pack_sequences),
]

#: SQL can express none of the stages in full; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
