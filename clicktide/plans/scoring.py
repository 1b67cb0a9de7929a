"""From event files to scored events and dead letters, continuously."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicktide.sources.paced import read_paced_lines
from clicktide.sources.readers import read_event_stream
from clicktide.streaming.events import load_scorer, rule_score, score_and_route
from clicktide.streaming.metrics import counters, intake_options, load_is_high
from clicktide.streaming.run import start


def start_scoring(
    spark: SparkSession,
    events_path: str,
    out: str,
    checkpoint: str,
    model_path: str | None = None,
    files_per_batch: int | None = None,
    processing_time: str | None = None,
    load_samples: DataFrame | None = None,
    scorer: Callable[[DataFrame], DataFrame] | None = None,
    load_board: str | None = None,
) -> StreamingQuery:
    """Score new events with ``scorer`` or the saved model, or with the rules if it is unusable.

    Each batch is one pass: parse, score, write by route. A batch on which the model fails is
    scored by the rules; ``fallback_reason`` tells why, in that case and where no model loaded.
    ``files_per_batch`` bounds the intake, and less is taken in if ``load_samples`` (``at``,
    ``load_pct``) end with the load high: Spark reads that bound when a query starts, so a
    pipeline that is restarted while hot slows down. With a ``load_board`` (see ``streaming.load``)
    the bound follows the load while the query runs; that needs ``files_per_batch`` and
    ``processing_time``, and keeps its position beside the checkpoint.
    """
    if load_board and not (files_per_batch and processing_time):
        raise ValueError("a load board needs files_per_batch and processing_time")
    limit = None
    if files_per_batch:
        hot = load_samples is not None and load_is_high(load_samples)
        limit = intake_options("file", files_per_batch, hot)["maxFilesPerTrigger"]
    reason = None
    if scorer is None:
        scorer, reason = load_scorer(spark, model_path)

    def shape(lines: DataFrame) -> DataFrame:
        return with_reason(score_and_route(lines, scorer), reason)

    def by_rules(lines: DataFrame, error: Exception) -> DataFrame:
        return with_reason(score_and_route(lines, rule_score), f"{type(error).__name__}: {error}"[:500])

    if load_board:
        lines = read_paced_lines(spark, events_path, f"{checkpoint}-position", files_per_batch, load_board)
    else:
        lines = read_event_stream(spark, events_path, limit)
    return start(
        lines, out, checkpoint, processing_time=processing_time, by=["route"], shape=shape, fallback=by_rules,
        counters=counters(),
    )


def with_reason(routed: DataFrame, reason: str | None) -> DataFrame:
    """``fallback_reason`` on rows scored by the rules."""
    by_rules = F.col("error") == "RULE_FALLBACK"
    return routed.withColumn("fallback_reason", F.when(by_rules, F.lit(reason).cast("string")))
