import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clicktide.learning import ablation, buy_model, evaluate, features, tfidf
from clicktide.operators import extraction


def test_ordinal_codes(many_chunks):
    fit = many_chunks.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "x string")
    books = features.fit_ordinal(fit, ["x"])
    new = many_chunks.createDataFrame([(1, "a"), (2, "zz"), (3, "c"), (4, None)], "i int, x string")
    found = features.ordinal_encode(new, ["x"], books).orderBy("i").collect()
    assert [r["x"] for r in found] == [0, -1, 2, -1]


def test_scaling_and_imputing(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    assert [r["a"] for r in features.impute_median(df, ["a"]).collect()] == [1.0, 3.0, 2.0]
    scaled = features.standard_scale(features.impute_median(df, ["a"]), ["a", "b"]).collect()
    assert [r["b"] for r in scaled] == [0.0, 0.0, 0.0]
    assert scaled[1]["a"] == pytest.approx(math.sqrt(1.5))
    words = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "w string")
    assert sorted(r[0] for r in features.impute_mode(words, ["w"]).collect()) == ["x", "y", "y", "y"]


def test_features_without_time(spark):
    df = spark.createDataFrame([("1", "2", "x", " PURCHASE ", None)],
                               "user_id string, item_id string, category_id string, behavior_type string, timestamp string")
    row = features.buy_features(df).first()
    assert (row["hour"], row["hour_bucket"], row["day_bucket"], row["category_id"], row["label"]) == (
        None, "-1", "-1", None, 1)


def brute_auc(pairs):
    pos, neg = [p for y, p in pairs if y], [p for y, p in pairs if not y]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc(spark):
    rng = random.Random(4)
    pairs = [(int(rng.random() < 0.3), rng.choice([0.1, 0.25, rng.random()])) for _ in range(300)]
    df = spark.createDataFrame(pairs, "label int, probability double")
    assert evaluate.roc_auc(df).first()["auc"] == pytest.approx(brute_auc(pairs), abs=1e-12)
    assert evaluate.roc_auc(df.where("label = 1")).first()["auc"] == 0.0


def test_char_tfidf(spark):
    texts = ["Ab  a", "b\nb", "", None, "zzzzzz a"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    fitted = tfidf.fit_char_tfidf(df, "t", 3)
    assert fitted.vocabulary == ["a", "b", "z"]
    assert fitted.idf == pytest.approx([math.log(6 / 3) + 1, math.log(6 / 3) + 1, math.log(6 / 2) + 1])
    rows = fitted.transform(df, "t", "v").orderBy("i").collect()
    raw = np.array([2 * fitted.idf[0], fitted.idf[1], 0])
    assert np.allclose(rows[0]["v"].toArray(), raw / np.linalg.norm(raw))
    assert rows[2]["v"].numNonzeros() == 0 and rows[3]["v"].numNonzeros() == 0
    with pytest.raises(ValueError):
        tfidf.fuse(fitted.transform(df, "t", "v").withColumn("d", F.lit(1)), "v", ["d"], 9)


@pytest.fixture(scope="module")
def purchases(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        item = rng.randrange(100)
        behavior = "buy" if rng.random() < item / 150 else "pv"
        rows.append((i, rng.randrange(50), item, item % 9 + 1, behavior, rng.randrange(10**6)))
    log = spark.createDataFrame(
        rows, "id bigint, user_id bigint, item_id bigint, category_id bigint, behavior_type string, timestamp bigint")
    return features.buy_features(log, "id").cache()


def test_model_equals_newton_on_the_same_objective(purchases):
    model = buy_model.train_buy_model(purchases)
    scored = model.transform(purchases).select("features", "label", "probability").collect()
    x = np.array([r["features"].toArray() for r in scored])
    y = np.array([r["label"] for r in scored], dtype=float)
    n = len(y)
    sample = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    a = np.hstack([x, np.ones((n, 1))])
    penalty = np.ones(a.shape[1])
    penalty[-1] = 0  # the intercept is free
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        gradient = a.T @ (sample * (p - y)) + penalty * w
        hessian = (a * (sample * p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        w -= np.linalg.solve(hessian, gradient)
    found = np.array([r["probability"][1] for r in scored])
    assert np.allclose(found, 1 / (1 + np.exp(-a @ w)), atol=2e-3)


def test_cross_validation(purchases):
    folds = buy_model.cross_validate(purchases, "id", max_iter=50).collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2, 3, 4]
    assert sum(r["auc"] for r in folds) / 5 > 0.6


def test_attributions_and_trees(spark):
    rng = random.Random(6)
    rows = [(i, "s" + str(i % 3), "正面" if (i * 7) % 5 < 3 else "负面", "综合", int((i * 7) % 5 < 3),
             "".join(rng.choice("abcd") for _ in range(20))) for i in range(150)]
    df = spark.createDataFrame(rows, "id bigint, cat string, sentiment string, category string, label int, review string")
    prepared, fitted = ablation.prepare(df, "id")
    assert prepared.where("is_test").count() == 30
    results = {r["experiment"]: r for r in ablation.ablation(prepared, rounds=3).collect()}
    assert results["B dense"]["accuracy"] == 1.0 and results["A text"]["delta_auc"] == 0.0
    assert results["C fused"]["features"] == len(fitted.vocabulary) + 3
    names = [f"字_{c}" for c in fitted.vocabulary] + list(ablation.DENSE)
    found = ablation.linear_attributions(prepared, names)
    assert ablation.top_features(found, 1).first()["feature"] == "sentiment"
    audit = ablation.attribution_audit(found).first()
    assert audit["dense_features"] == 3 and audit["mean_ratio"] > 1
    moved = ablation.permuted(df, "id", "sentiment")
    assert moved.count() == 150
    assert sorted(r[0] for r in moved.select("sentiment").collect()) == sorted(r[2] for r in rows)


def test_modes_of_several_types(spark):
    rows = [("b", 3, None), ("a", 1, None), ("a", 1, None), ("b", 2, None), (None, None, None)]
    df = spark.createDataFrame(rows, "s string, i int, n string")
    assert features.modes(df, ["s", "i", "n"]) == {"s": "a", "i": 1, "n": None}
    assert features.modes(df.limit(0), ["s"]) == {"s": None}


def test_a_shifted_slope_is_no_optimum(spark):
    rng = random.Random(1)
    rows = [(rng.gauss(0, 1), rng.random()) for _ in range(400)]
    df = spark.createDataFrame([(a, float(b < 1 / (1 + 2.7 ** -a))) for a, b in rows], "x double, label double")
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    weighted, n = buy_model.balanced_weights(df)
    slopes = []
    for strength in (1.0 / n, 0.2):
        stages = [VectorAssembler(inputCols=["x"], outputCol="features"),
                  LogisticRegression(weightCol="weight", regParam=strength, standardization=False)]
        model = Pipeline(stages=stages).fit(weighted)
        if strength == 0.2:
            model.stages[-1].set(model.stages[-1].regParam, 1.0 / n)
        slopes.append(buy_model.steepest_slope(model, weighted, n))
    assert slopes[0] < 1e-4 < 0.01 < slopes[1]


def test_extractor_and_counts_get_small_batches(spark):
    """A task holds a bounded part of its texts, however many rows and bytes Spark would send at once."""
    keys = {f"spark.sql.execution.arrow.{k}": v for k, v in (("maxRecordsPerBatch", "10000"), ("maxBytesPerBatch", "64MB"))}
    before = {k: spark.conf.get(k) for k in keys}

    def sizes(batches):
        for batch in batches:
            cells = [pa.array([batch.num_rows]), pa.array([batch.nbytes])]
            yield pa.RecordBatch.from_arrays(cells, ["n", "size"])

    try:
        for rows, length in ((3000, 10), (300, 100_000)):
            for key, value in keys.items():
                spark.conf.set(key, value)
            df = spark.range(0, rows, 1, 1).withColumn("t", F.repeat(F.lit("a"), length))
            replies = extraction.ask(df, "t", lambda text: str(len(text)))
            got = replies.mapInArrow(sizes, "n bigint, size bigint").collect()
            assert sum(r.n for r in got) == rows
            assert max(r.n for r in got) <= 512 and max(r.size for r in got) < 10 << 20
            assert replies.select("reply").distinct().collect() == [(str(length),)]
            for key, value in keys.items():
                spark.conf.set(key, value)
            tfidf.fit_char_tfidf(df, "t", 5)
            assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 512
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
