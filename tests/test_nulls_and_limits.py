"""Inputs on which rows must not get lost, and figures must not depend on their size."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicktide.learning import buy_model, evaluate, tfidf
from clicktide.operators import extraction, profile, reviews, sampling, series
from clicktide.operators.ordered import exact_medians
from clicktide.session import clear_scratch, scratch
from clicktide.sources import readers, writers


def test_pivot_keeps_every_sentiment(spark):
    rows = [("a", "正面"), ("a", extraction.FALLBACK), ("b", extraction.FALLBACK), ("b", None)]
    found = reviews.sentiment_pivot(spark.createDataFrame(rows, "cat string, sentiment string"))
    assert found.columns == ["category", "正面", "负面", "中性", extraction.FALLBACK]
    many = spark.createDataFrame([("a", f"s{i}") for i in range(5)] * 2, "cat string, sentiment string")
    with pytest.raises(ValueError, match="sentiment_counts"):
        reviews.sentiment_pivot(many, max_others=4)
    assert len(reviews.sentiment_pivot(many, max_others=5).columns) == 9
    assert {tuple(r) for r in reviews.sentiment_counts(many).collect()} == {("a", f"s{i}", 2) for i in range(5)}
    assert sorted(map(tuple, found.collect())) == [("a", 1, 0, 0, 1), ("b", 0, 0, 0, 1)]


def test_samples_keep_the_null_class(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "x") for i in range(20)], "id int, label string")
    assert sampling.stratified_split(df, "label", "id").count() == 20
    folds = sampling.stratified_folds(df, "label", "id").groupBy("label", "fold").count().collect()
    assert len(folds) == 10 and all(r["count"] == 2 for r in folds)
    assert sampling.balanced_sample(df, "label", "id", 3).groupBy("label").count().count() == 2
    assert sampling.balanced_sample(df, "label", "id", 3).count() == 6
    blank = spark.createDataFrame([(1, ""), (2, None), (None, None)], "id int, label string")
    assert sampling.stratified_split(blank, "label", "id").count() == 3


def test_samples_move_few_rows(spark):
    df = spark.range(5000).withColumn("label", F.lit("x"))
    found = sampling.sample_n(df, "id", 40)
    everything = sampling.hash_rank(df, "id").where("rank <= 40")
    assert sorted(r["id"] for r in found.collect()) == sorted(r["id"] for r in everything.collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window") :]
    # What is sorted for the window has been joined with the few buckets that are needed.
    assert re.search("BroadcastHashJoin", window)


@pytest.mark.parametrize("many", [1, 3])
def test_null_series_stay(many_chunks, many):
    rows = [(s, t, float(t * t % 7)) for s in [None, "a"][: many] + ["b"] * (many > 2) for t in range(9)]
    df = many_chunks.createDataFrame(rows, "s string, t int, d double")
    slopes = series.regression_slope(df, ["s"], "t", "d").collect()
    assert {r["s"] for r in slopes} == {r[0] for r in rows} and all(r["samples"] == 9 for r in slopes)
    bins = series.histogram(df, ["s"], "d", 4).groupBy("s").agg(F.sum("cnt").alias("n")).collect()
    assert {r["s"]: r["n"] for r in bins} == {r[0]: 9 for r in rows}


def test_auc_of_any_scores(spark):
    def auc(rows):
        return evaluate.roc_auc(spark.createDataFrame(rows, "label int, probability double")).first()["auc"]

    assert auc([(1, 1e-18), (0, 1e-19)]) == 1.0
    assert auc([(1, 3000.0), (0, -5e300), (0, 3000.0)]) == 0.75
    for bad in ([(1, None), (0, 0.5)], [(1, math.nan), (0, 0.5)], [(None, 0.1), (0, 0.5)]):
        with pytest.raises(Exception, match="a score or label is missing"):
            auc(bad)


def test_the_filler_is_the_training_median(spark):
    names = ["user_id", "item_id", "category_id", "hour", "dayofweek", "is_weekend"]
    rows = [(*[float(x)] * 6, "1", "2", x % 2) for x in (24, 25, 26, 25, 100_000, 10)]
    schema = ", ".join(f"{c} double" for c in names) + ", hour_bucket string, day_bucket string, label int"
    train = spark.createDataFrame(rows, schema)
    stage = buy_model.scaling_stage(train)
    holes = spark.createDataFrame([(*[None] * 6, "1", "2", 0), (*[25.0] * 6, "1", "2", 0)], schema)
    empty, middle = stage.transform(holes).collect()
    assert all(empty[f"z_{c}"] == pytest.approx(middle[f"z_{c}"]) for c in names)


def test_medians_of_several_columns(many_chunks):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 50, 301).tolist(), rng.normal(size=301).tolist()
    b[5] = b[6] = None
    df = many_chunks.createDataFrame([(x, y, None) for x, y in zip(a, b)], "a int, b double, c double")
    found = exact_medians(df, ["a", "b", "c"])
    assert found["a"] == np.median(a) and found["c"] is None
    assert found["b"] == pytest.approx(np.median([y for y in b if y is not None]))


def test_nul_is_a_character_like_others(spark):
    df = spark.createDataFrame([(0, "a\0\0\0b"), (1, "a")], "i int, t string")
    fitted = tfidf.fit_char_tfidf(df, "t", 10)
    assert fitted.vocabulary == ["\0", "a", "b"]
    assert fitted.idf[1] == pytest.approx(1.0)
    found = tfidf.weights(fitted.transform(df, "t", "v"), "i", "v", fitted.vocabulary)
    assert {(r["i"], r["feature"]) for r in found.collect()} == {(0, "\0"), (0, "a"), (0, "b"), (1, "a")}


def test_one_bad_call_does_not_end_the_job(spark):
    def failing(text):
        if text == "bad":
            raise ValueError("no answer")
        return '{"sentiment": "正面", "category": "质量", "summary": "s"}'

    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, None)], "i int, review string")
    rows = {r["i"]: r for r in extraction.extract_features(df, "review", failing).collect()}
    assert rows[1]["sentiment"] == "正面" and rows[1]["error"] is None
    assert rows[2]["error"] == "ValueError: no answer"
    assert {rows[2][c] for c in ("sentiment", "category", "summary")} == {extraction.FALLBACK}
    assert rows[3]["error"] is None and rows[3]["sentiment"] == extraction.FALLBACK
    with pytest.raises(Exception, match="no answer"):
        extraction.extract_features(df, "review", failing, on_error="raise").collect()


def test_the_extractor_runs_once_per_review(spark, monkeypatch):
    from clicktide.catalog import learned

    calls = spark.sparkContext.accumulator(0)
    plain = learned.keyword_extractor

    def counted(text):
        calls.add(1)
        return plain(text)

    monkeypatch.setattr(learned, "keyword_extractor", counted)
    vectors, _ = learned.prepared(spark, "/root/testdata/sf0.001")
    assert vectors.count() == calls.value > 0


def test_shares_of_any_column(spark):
    df = spark.range(100).withColumn("item_id", F.col("id") % 50)
    assert {r["pct"] for r in profile.behavior_share(df, "item_id").collect()} == {2.0}


def test_report_counts_files(spark):
    root = scratch(spark, "report")
    df = spark.range(100).select(F.concat(F.lit("v "), F.col("id") % 2).alias("part"), "id")
    writers.write_parquet(df.coalesce(1), root, ["part"])
    rows = {r["part"]: r for r in writers.storage_report(spark, root, "part", 1.0).collect()}
    assert set(rows) == {"v 0", "v 1", "TOTAL"}
    assert rows["TOTAL"]["files"] == rows["v 0"]["files"] + rows["v 1"]["files"] == 2


def test_csv_with_a_schema_and_line_breaks(spark, tmp_path):
    path = f"{tmp_path}/x.csv"
    writers.write_csv(spark.createDataFrame([("1", "a\nb"), ("2", "c")], "n string, t string").coalesce(1), path)
    assert readers.read_csv_inferred(spark, path, multi_line=True).dtypes == [("n", "int"), ("t", "string")]
    assert [r["t"] for r in readers.read_csv_inferred(spark, path, "n string, t string", True).orderBy("n").collect()] == ["a\nb", "c"]


def test_intermediate_tables_can_be_cleared(spark):
    path = scratch(spark, "gone")
    spark.range(3).write.parquet(path)
    clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path)
