"""Inputs for the tests of this folder."""

import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside; as columns of an input they must change nothing.
CLASHING = ["fp", "key", "h1", "label", "score", "held_out", "component_id", "_text", "_row", "_spans",
            "_leads", "ids", "node", "toxicity", "positive", "start", "size"]


@pytest.fixture()
def make_docs(spark):
    def make(rows, clash=False):
        full = [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        if clash:
            df = df.select("*", *[F.lit("x").alias(c) for c in CLASHING])
        return df

    return make


def prose(seed: int, n: int) -> str:
    """n words that no other seed shares in the same order."""
    rng = random.Random(seed)
    words = "alder birch cedar elm fir hazel ivy larch maple oak pine rowan spruce willow yew".split()
    return " ".join(rng.choice(words) + rng.choice("abcdefgh") for _ in range(n))
