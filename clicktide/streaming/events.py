"""Event parsing, scoring and dead letters."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.functions import scalars as S

FIELDS = (
    "event_time",
    "timestamp",
    "user_id",
    "item_id",
    "category_id",
    "behavior_type",
    "session_id",
)
_TEXT_FIELDS = T.StructType([T.StructField(c, T.StringType()) for c in FIELDS])

# Columns of a scored event.
SCORED_COLUMNS = (
    "processed_at",
    "event_time",
    "user_id",
    "item_id",
    "category_id",
    "predicted_label",
    "buy_probability",
    "error",
)
FEATURE_COLUMNS = (
    "user_id",
    "item_id",
    "category_id",
    "hour",
    "dayofweek",
    "is_weekend",
    "hour_bucket",
    "day_bucket",
)


def parse_events(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON lines to features. ``error`` names the first failed check and is null if none fails.

    Checks in order: an object, user id, item id, category (if given), time. The time is
    ``timestamp`` if given, else ``event_time``.
    """
    e = F.from_json(F.col(column), _TEXT_FIELDS)
    fields = F.json_object_keys(F.col(column))
    p = lines.withColumns({"_e": e, "_keys": fields})

    def given(c: str):
        return F.array_contains("_keys", c)

    def text(c: str):
        return F.col(f"_e.{c}")

    item = S.safe_int(text("item_id"))
    category = F.when(given("category_id"), S.safe_int(text("category_id"))).otherwise(
        S.default_category(item)
    )
    has_stamp = given("timestamp") & text("timestamp").isNotNull() & (text("timestamp") != "")
    seconds = F.when(has_stamp, S.safe_int(text("timestamp"))).otherwise(
        S.event_seconds(text("event_time"))
    )
    p = p.withColumns(
        {
            "_user": S.safe_int(text("user_id")),
            "_item": item,
            "_category": category,
            "_seconds": seconds,
            "_stamp": has_stamp,
        }
    )
    error = (
        F.when(F.col("_keys").isNull(), "event must be an object")
        .when(~given("user_id"), "missing user_id")
        .when(F.col("_user").isNull(), "bad user_id")
        .when(~given("item_id"), "missing item_id")
        .when(F.col("_item").isNull(), "bad item_id")
        .when(F.col("_category").isNull(), "bad category_id")
        .when(F.col("_stamp") & F.col("_seconds").isNull(), "bad timestamp")
        .when(~F.col("_stamp") & ~given("event_time"), "missing event_time")
        .when(F.col("_seconds").isNull(), "bad event_time")
    )
    hour, day = S.hour_of("_seconds"), S.weekday_of("_seconds")
    passed = [c for c in lines.columns if c != column]
    return p.select(
        *passed,
        F.col(column).alias("raw"),
        error.alias("error"),
        text("event_time").alias("event_time"),
        F.col("_user").alias("user_id"),
        F.col("_item").alias("item_id"),
        F.col("_category").alias("category_id"),
        text("behavior_type").alias("behavior_type"),
        F.col("_seconds").alias("timestamp"),
        hour.alias("hour"),
        day.alias("dayofweek"),
        S.weekend_flag(day).alias("is_weekend"),
        hour.cast("string").alias("hour_bucket"),
        day.cast("string").alias("day_bucket"),
    )


def rule_score(events: DataFrame) -> DataFrame:
    """Probability from the behaviour alone, marked ``RULE_FALLBACK``."""
    p = S.rule_probability("behavior_type")
    return events.withColumns(
        {
            "predicted_label": (p >= 0.5).cast("int"),
            "buy_probability": p,
            "score_tag": F.lit("RULE_FALLBACK"),
        }
    )


def model_score(events: DataFrame, model: PipelineModel) -> DataFrame:
    scored = model.transform(events)
    return scored.select(
        *events.columns,
        F.col("prediction").cast("int").alias("predicted_label"),
        vector_to_array("probability")[1].alias("buy_probability"),
        F.lit("").alias("score_tag"),
    )


def external_score(events: DataFrame, make_predict, batch_size: int = 50) -> DataFrame:
    """Scores from a model that is not Spark's.

    ``make_predict`` loads the model, once per Python worker, and returns a function from a
    matrix of the numeric features (buckets as numbers) to purchase probabilities. It is
    called on batches of ``batch_size`` rows.
    """
    inputs = F.array(*[F.col(c).cast("double") for c in FEATURE_COLUMNS])
    predict = predict_batch_udf(
        make_predict,
        return_type=T.DoubleType(),
        batch_size=batch_size,
        input_tensor_shapes=[[len(FEATURE_COLUMNS)]],
    )
    # Rows that failed to parse have no features; zeros stand in, and their score is dropped.
    usable = F.when(F.col("error").isNull(), inputs).otherwise(
        F.array(*[F.lit(0.0)] * len(FEATURE_COLUMNS))
    )
    scored = events.withColumn("buy_probability", predict(usable))
    return scored.withColumns(
        {
            "predicted_label": (F.col("buy_probability") >= 0.5).cast("int"),
            "score_tag": F.lit(""),
        }
    )


def load_scorer(spark: SparkSession, model_path: str | None):
    """(scorer, reason): the saved model if it loads and passes a probe with one valid event, else
    the rules and why."""
    if model_path is None:
        return rule_score, "no model"
    probe = '{"event_time": "2026-05-04 12:00:00.000", "user_id": 1, "item_id": 1, "behavior_type": "view"}'
    try:
        model = PipelineModel.load(model_path)
        model_score(parse_events(spark.createDataFrame([(probe,)], "value string")), model).collect()
    except Exception as error:  # noqa: BLE001 - whatever makes the model unusable, the rules take over
        return rule_score, f"{type(error).__name__}: {error}"[:500]
    return (lambda events: model_score(events, model)), None


def score_and_route(lines: DataFrame, scorer=rule_score) -> DataFrame:
    """Parse and score every event; ``route`` is ``scored`` or ``dead``.

    One pass: a broken row keeps its raw text and error, a good one its scores. The writer
    splits them by ``route``, so nothing is cached or computed twice.
    """
    scored = scorer(parse_events(lines))
    dead = F.col("error").isNotNull()

    def if_good(c: str):
        return F.when(~dead, F.col(c)).alias(c)

    passed = [c for c in lines.columns if c != "value"]
    return scored.select(
        *passed,
        F.current_timestamp().alias("processed_at"),
        *[if_good(c) for c in ("event_time", "user_id", "item_id", "category_id", "behavior_type")],
        if_good("predicted_label"),
        if_good("buy_probability"),
        F.when(dead, F.col("error")).otherwise(F.col("score_tag")).alias("error"),
        F.when(dead, F.col("raw")).alias("raw"),
        F.when(dead, "dead").otherwise("scored").alias("route"),
    )


def scored_events(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("route") == "scored").drop("raw", "route")


def dead_letters(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("route") == "dead").select(
        F.col("processed_at").alias("ts"), "batch_id", "error", "raw"
    )


def failed_as_score(routed: DataFrame) -> DataFrame:
    """The variant without dead letters: failures become rows with label and probability -1."""
    dead = F.col("route") == "dead"
    return routed.withColumns(
        {
            "predicted_label": F.when(dead, F.lit(-1)).otherwise(F.col("predicted_label")),
            "buy_probability": F.when(dead, F.lit(-1.0)).otherwise(F.col("buy_probability")),
        }
    ).drop("raw", "route")


def scoring_summary(scores: DataFrame) -> DataFrame:
    """Scored, failed and positive rows, positive share and mean probability of scored rows."""
    good = F.col("buy_probability") >= 0
    scored = F.count_if(good)
    positive = F.count_if(good & (F.col("predicted_label") == 1))
    return scores.agg(
        scored.alias("scored"),
        F.count_if(~good).alias("failed"),
        positive.alias("positive"),
        F.when(scored > 0, positive / scored).otherwise(0.0).alias("positive_ratio"),
        F.avg(F.when(good, F.col("buy_probability"))).alias("avg_buy_probability"),
    )
