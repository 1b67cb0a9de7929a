import random

import pytest
from pyspark.sql import functions as F

from clicktide.operators import ordered, sampling


def brute_prefix(rows):
    out, total = {}, 0
    for k, v in sorted(rows):
        out[k] = total
        total += v
    return out


@pytest.mark.parametrize("span", [100, 300_000, 2**40])
def test_prefix_sum(spark, span):
    rng = random.Random(span)
    keys = rng.sample(range(-span, span), 150)
    rows = [(k, rng.randrange(10)) for k in keys]
    found = ordered.prefix_sum(spark.createDataFrame(rows, "k bigint, v bigint"), "k", "v", "before")
    assert {r["k"]: r["before"] for r in found.collect()} == brute_prefix(rows)


def test_prefix_sum_of_nothing(spark):
    empty = spark.createDataFrame([], "k bigint, v bigint")
    assert ordered.prefix_sum(empty, "k", "v", "before").count() == 0


def test_positions_of_a_hot_series_span_chunks(many_chunks):
    rows = [("hot", i % 7, i) for i in range(3000)] + [("cold", i, 10_000 + i) for i in range(20)]
    df = many_chunks.createDataFrame(rows, "s string, t bigint, id bigint")
    chunks = ordered.ordered_chunks(df, ["s"], ["t", "id"])
    assert chunks.where("s = 'hot'").select("_chunk").distinct().count() > 2
    found = ordered.running_position(df, ["s"], ["t", "id"])
    expected = {}
    for s in ("hot", "cold"):
        for i, r in enumerate(sorted(r for r in rows if r[0] == s)):
            expected[(s, r[2])] = i + 1
    assert {(r["s"], r["id"]): r["position"] for r in found.collect()} == expected


def test_null_series_is_a_series(many_chunks):
    rows = [(None if i % 2 else "a", i) for i in range(400)]
    df = many_chunks.createDataFrame(rows, "s string, id bigint")
    found = ordered.running_position(df, ["s"], ["id"])
    assert found.groupBy("s").agg(F.max("position").alias("m")).where("m = 200").count() == 2
    assert found.count() == 400


@pytest.mark.parametrize(
    "values, median", [([3], 3.0), ([1, 2], 1.5), ([5, 1, 1, 9, 2], 2.0), ([None, 4, 4, 4, 8], 4.0), ([None], None)]
)
def test_exact_median(many_chunks, values, median):
    df = many_chunks.createDataFrame([(v,) for v in values], "x int")
    assert ordered.exact_median(df, "x") == median


def test_page_and_slice(spark):
    ids = list(range(0, 400_000, 997))
    df = spark.createDataFrame([(i, str(i)) for i in ids], "id bigint, t string")
    page = sampling.page(df, "id", 370, 20).collect()
    assert [r["id"] for r in page] == ids[370:390]
    assert [r["position"] for r in page] == list(range(370, 390))
    assert {r["total"] for r in page} == {len(ids)}
    assert sampling.page(df, "id", 10_000, 20).collect() == []
    assert [r["id"] for r in sampling.page(df, "id", 395, 20).collect()] == ids[395:]
    assert [r["id"] for r in sampling.slice_rows(df, "id", 60, 390).collect()] == ids[60:390]
    with pytest.raises(ValueError):
        sampling.page(df, "id", 0, 101)


def test_samples(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1000)], "id bigint, label int")
    first = {r["id"] for r in sampling.sample_n(df, "id", 100).collect()}
    assert len(first) == 100 and first == {r["id"] for r in sampling.sample_n(df, "id", 100).collect()}
    assert first != {r["id"] for r in sampling.sample_n(df, "id", 100, seed=7).collect()}
    per_class = sampling.balanced_sample(df, "label", "id", 60).groupBy("label").count().collect()
    assert {r["count"] for r in per_class} == {60}
    split = sampling.stratified_split(df, "label", "id").where("is_test").groupBy("label").count()
    assert {(r["label"], r["count"]) for r in split.collect()} == {(0, 180), (1, 20)}
    folds = sampling.stratified_folds(df, "label", "id").groupBy("label", "fold").count().collect()
    assert {(r["label"], r["count"]) for r in folds} == {(0, 180), (1, 20)} and len(folds) == 10
