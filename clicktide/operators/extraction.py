"""Structured features from text by a pluggable extractor, such as a model API."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.session import small_batches

#: Rows whose texts and replies a task holds as Python strings.
SLICE_ROWS = 256
# Instruction sent with each review, and the mark of an unusable reply.
PROMPT = (
    "你是专业的电商数据流清洗组件，负责从商品评论中提取结构化特征。\n"
    "严格按以下规则输出：\n"
    "1. sentiment：仅选【正面、负面、中性】\n"
    "2. category：仅选【物流、质量、价格、服务、综合】\n"
    "3. summary：15字以内，概括核心诉求\n\n"
    "评论内容：%s\n\n"
    "请仅返回纯净JSON对象，不要任何额外文字、解释、Markdown标记。"
)
FALLBACK = "解析失败"

FEATURES = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("sentiment", "category", "summary")]
)


class RetryableError(Exception):
    """Raised by an extractor for rate limits, time-outs and server errors."""


def build_prompt(text: Column, template: str = PROMPT) -> Column:
    return F.format_string(template, text)


def call_with_retry(
    extractor: Callable[[str], str],
    text: str,
    attempts: int,
    wait: tuple[float, float],
    retryable: tuple[type[BaseException], ...],
) -> str:
    """Retry retryable errors only, waiting exponentially longer within ``wait``."""
    for attempt in range(1, attempts + 1):
        try:
            return extractor(text)
        except retryable:
            if attempt == attempts:
                raise
            pause = min(wait[1], max(wait[0], 2.0 ** (attempt - 1)))
            time.sleep(pause * random.uniform(0.9, 1.0))
    raise AssertionError("unreachable")


def ask(
    df: DataFrame,
    column: str,
    extractor: Callable[[str], str],
    out: str = "reply",
    concurrency: int = 20,
    attempts: int = 10,
    wait: tuple[float, float] = (2.0, 60.0),
    retryable: tuple[type[BaseException], ...] = (RetryableError,),
    error: str = "error",
    on_error: str = "mark",
) -> DataFrame:
    """Add the extractor's raw reply, and ``error`` with what the last attempt raised.

    Calls overlap inside a task, at most ``concurrency`` at a time, and tasks run on all
    partitions; rows stream through in Arrow batches, and Python holds the texts of ``SLICE_ROWS`` rows
    of one. Batches are bounded for the session (see ``small_batches``). The reply joins its row in
    place. A call that fails in the end leaves a null reply and its error, so that one bad text does not
    make Spark pay for all calls of the task again; ``on_error="raise"`` ends the job instead.
    """
    if on_error not in ("mark", "raise"):
        raise ValueError("on_error is mark or raise")
    added = [T.StructField(c, T.StringType()) for c in (out, error)]
    schema = T.StructType([*df.schema.fields, *added])
    place = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(text):
            if text is None:
                return None, None
            try:
                return call_with_retry(extractor, text, attempts, wait, retryable), None
            except Exception as failure:  # noqa: BLE001 - extractors raise what they like
                if on_error == "raise":
                    raise
                return None, f"{type(failure).__name__}: {failure}"

        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    rows = batch.slice(at, SLICE_ROWS)
                    answers = list(pool.map(one, rows.column(place).to_pylist()))
                    made = [pa.array([a[i] for a in answers], pa.string()) for i in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*rows.columns, *made], schema.names)

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def parse_reply(reply: Column, whole_fallback: bool = False) -> Column:
    """The reply's JSON object; otherwise the fallback mark with the reply's first 30
    characters as summary (or the mark in all three with ``whole_fallback``)."""
    usable = F.startswith(F.ltrim(reply), F.lit("{")) & F.try_parse_json(reply).isNotNull()
    rest = F.lit(FALLBACK) if whole_fallback else F.substring(F.coalesce(reply, F.lit("None")), 1, 30)
    fallback = F.struct(
        F.lit(FALLBACK).alias("sentiment"), F.lit(FALLBACK).alias("category"), rest.alias("summary")
    )
    return F.when(usable, F.from_json(reply, FEATURES)).otherwise(fallback)


def features_of(
    replies: DataFrame, columns: list[str], reply: str, error: str, whole_fallback: bool = False
) -> DataFrame:
    """``columns`` with ``sentiment``, ``category``, ``summary`` and ``error`` from raw replies.

    A row whose call failed has the fallback mark in all three and the error.
    """
    parsed = F.when(F.col(error).isNotNull(), F.struct(*[F.lit(FALLBACK).alias(c) for c in FEATURES.names]))
    parsed = parsed.otherwise(parse_reply(F.col(reply), whole_fallback))
    features = [F.col(f"_f.{c}") for c in FEATURES.names]
    return replies.withColumn("_f", parsed).select(*columns, *features, F.col(error).alias("error"))


def extract_features(
    df: DataFrame,
    column: str,
    extractor: Callable[[str], str],
    whole_fallback: bool = False,
    **options,
) -> DataFrame:
    """Features of each row's text, asked in place (see ``ask``).

    Every row is one call and calls are bounded per task; ``replies.extract_features_once`` asks
    equal texts once and bounds the calls of the whole job.
    """
    replies = ask(df, column, extractor, "_reply", error="_error", **options)
    return features_of(replies, df.columns, "_reply", "_error", whole_fallback)


def extraction_summary(df: DataFrame) -> DataFrame:
    failed = F.count_if(F.col("sentiment") == FALLBACK)
    rows = F.count(F.lit(1))
    return df.agg(
        (rows - failed).alias("succeeded"),
        failed.alias("fallback"),
        F.when(rows > 0, (rows - failed) / rows).otherwise(0.0).alias("success_rate"),
    )
