"""Counters of a scoring pipeline, and settings that bound its intake."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicktide.streaming.run import read_counters

HIGH, LOW = 0.85, 0.30


def counters() -> dict[str, Column]:
    """Counters of scored and routed rows, for ``run.start`` to take while it writes a batch."""
    dead = F.col("route") == "dead"
    return {
        "produced": F.count(F.lit(1)),
        "consumed": F.count_if(~dead),
        "dead_lettered": F.count_if(dead),
        "fallback_predictions": F.count_if(F.col("error") == "RULE_FALLBACK"),
    }


def progress_metrics(spark: SparkSession, query: StreamingQuery, path: str) -> DataFrame:
    """Counters and input rates per batch of a query that was started with ``counters()``.

    The counters were taken as the batches were written, so no batch is missing however long the
    query has run, and nothing is scanned. Rates are known for the recent batches only, whose reports
    Spark still holds (``spark.sql.streaming.numRecentProgressUpdates``), and null for others.
    """
    reports = [
        (p["batchId"], p["timestamp"], p["inputRowsPerSecond"], p["processedRowsPerSecond"])
        for p in query.recentProgress
        if p["numInputRows"] > 0
    ]
    schema = "batch_id bigint, at string, input_rate double, process_rate double"
    rates = spark.createDataFrame(reports, schema).dropDuplicates(["batch_id"])
    counts = read_counters(spark, path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return counts.join(F.broadcast(rates), "batch_id", "left").select("batch_id", *counters(), *rates.columns[1:])


def pipeline_metrics(routed: DataFrame) -> DataFrame:
    """The counters over all written batches."""
    dead = F.col("route") == "dead"
    injected = F.count_if(F.col("fault").isNotNull()) if "fault" in routed.columns else F.lit(None).cast("bigint")
    return routed.agg(
        F.count(F.lit(1)).alias("produced"),
        F.count_if(~dead).alias("consumed"),
        F.count_if(dead).alias("failed"),
        F.count_if(dead).alias("dead_lettered"),
        F.count_if(F.col("error") == "RULE_FALLBACK").alias("fallback_predictions"),
        injected.alias("chaos_injected"),
    )


def intake_options(source: str, limit: int, hot: bool = False, slowdown: int = 3) -> dict[str, int]:
    """Reader options that bound what one batch takes in; less while the load is high."""
    # The state of ``load_is_high`` belongs in ``hot``.
    names = {"kafka": "maxOffsetsPerTrigger", "rate": "rowsPerSecond"}
    bound = max(1, limit // slowdown) if hot else limit
    return {names.get(source, "maxFilesPerTrigger"): bound}


def load_is_high(samples: DataFrame, order: str = "at", load: str = "load_pct") -> bool:
    """State of the hysteresis after the last sample of one pipeline's load; False without any.

    The last sample at or beyond a bound decides, which one aggregate finds."""
    value = F.col(load)
    decisive = samples.where((value >= HIGH) | (value <= LOW))
    return bool(decisive.agg(F.max_by(value >= HIGH, order)).first()[0])
