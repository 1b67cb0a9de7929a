import json
import random
import sys

from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from clicktide.learning import ablation
from clicktide.plans.etl import etl_reports, run_etl
from clicktide.plans.review_study import review_study
from clicktide.plans.scoring import start_scoring
from clicktide.session import scratch
from clicktide.streaming import events, run

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_etl(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(20), rng.randrange(9), 1, rng.choice(["pv", "pv", "cart", "buy"]),
             rng.randrange(-50, 9000)) for _ in range(800)]
    csv, out = scratch(spark, "etl-csv"), scratch(spark, "etl-out")
    spark.createDataFrame(rows, "u bigint, i bigint, c bigint, b string, t bigint").write.csv(csv)
    written = run_etl(spark, csv, out)
    assert "session_id" in written.columns
    reports = etl_reports(spark, csv, out, original_mb=1.0, min_rows=1)
    removed = reports["removed"].first()
    assert removed["rows_before"] == 800 and removed["rows_after"] == written.count()
    assert reports["quality"].where("not passed").count() == 0
    assert reports["storage"].where("behavior_type = 'TOTAL'").count() == 1


def test_scoring_with_rules(spark):
    folder, out = scratch(spark, "in"), scratch(spark, "out")
    good = json.dumps({"event_time": "2024-01-06 13:00:00.5", "user_id": 1, "item_id": 7, "behavior_type": "buy"})
    spark.createDataFrame([(good,), ("{",)], "value string").write.text(folder)
    query = start_scoring(spark, folder, out, scratch(spark, "state"), files_per_batch=5)
    query.awaitTermination()
    routed = run.read_batches(spark, out)
    assert {(r["route"], r["error"]) for r in routed.collect()} == {
        ("scored", "RULE_FALLBACK"), ("dead", "event must be an object")}


def make_model():
    return lambda rows: rows[:, 3] / 24.0


def test_model_of_another_library(spark):
    lines = [json.dumps({"event_time": f"2024-01-06 {h}:00:00.5", "user_id": 1, "item_id": 7}) for h in (10, 18)]
    df = spark.createDataFrame([(v,) for v in [*lines, "{"]], "value string")
    scored = events.external_score(events.parse_events(df), make_model)
    found = {r["hour"]: (r["predicted_label"], r["buy_probability"]) for r in scored.where("error is null").collect()}
    assert found == {10: (0, 10 / 24), 18: (1, 0.75)}


def extractor(text):
    mood = "正面" if "a" in text else "负面"
    return json.dumps({"sentiment": mood, "category": "综合", "summary": ""})


def test_review_study(spark):
    rows = [(i, "s", int(i % 3 == 0), ("a" if i % 3 == 0 else "b") + "xyz" * (i % 4)) for i in range(120)]
    df = spark.createDataFrame(rows, "id bigint, cat string, label int, review string")
    found = review_study(df, "id", extractor, per_class=40, rounds=2, max_features=20)
    assert {r["accuracy"] for r in found["ablation"].collect()} == {1.0}
    assert found["audit"].first()["dense_features"] == 3
    assert found["attributions"].count() == 8


def test_permutation_importance(spark):
    rows = [(i, "s", "正面" if i % 2 else "负面", "综合", i % 2, "x") for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, cat string, sentiment string, category string, label int, review string")
    prepared, _ = ablation.prepare(df, "id")
    model = GBTClassifier(maxIter=2, seed=1).fit(prepared.where(~F.col("is_test")))
    loss = {r["feature"]: r["accuracy_loss"] for r in
            ablation.permutation_importance(model, prepared, "id").collect()}
    assert loss["sentiment"] > 0.2 and loss["cat"] == loss["category"] == 0.0
