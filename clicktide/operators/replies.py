"""A store of extractor replies: equal texts are asked once, and a task that is run again pays nothing.

``fetch_replies`` finds the distinct texts that have no reply yet and deals them to a fixed number of
callers, so the calls in flight are bounded over the whole job, however many tasks the cluster runs.
A caller writes its replies to the store while it works. If its task is lost, the next attempt reads
what the lost one had stored and goes on from there; only calls in flight at that moment are made
again. ``with_replies`` joins the store to any table with the same texts.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from threading import Condition

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import RDD, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.operators.extraction import PROMPT, RetryableError, call_with_retry, features_of
from clicktide.operators.ordered import join_per_key
from clicktide.session import small_batches

STORED = "digest string, reply string, error string"
_KIND = pa.schema([("digest", pa.string()), ("reply", pa.string()), ("error", pa.string())])


def digest(text: Column, prompt: str = PROMPT) -> Column:
    """Key of a text under a prompt; null for a null text."""
    return F.sha2(F.concat(F.lit(f"{len(prompt)}:{prompt}"), text), 256)


class Throttle:
    """Calls one caller may have in flight. A retryable error halves it, and every success widens it
    again by its reciprocal, up to ``most``; it never falls below one."""

    def __init__(self, most: int) -> None:
        self.most, self.limit, self.running = most, float(most), 0
        self.free = Condition()

    def __enter__(self) -> None:
        with self.free:
            self.free.wait_for(lambda: self.running < int(self.limit))
            self.running += 1

    def __exit__(self, *_) -> None:
        with self.free:
            self.running -= 1
            self.free.notify_all()

    def report(self, retryable_error: bool) -> None:
        with self.free:
            change = self.limit / 2 if retryable_error else self.limit + 1 / self.limit
            self.limit = min(float(self.most), max(1.0, change))
            self.free.notify_all()


class ReplyWriter:
    """One caller's part of the store. A file is named only when it is whole, so no reader sees half of one."""

    def __init__(self, folder: str, every: int, seconds: float) -> None:
        self.system, self.folder = fs.FileSystem.from_uri(folder)
        self.every, self.seconds = every, seconds
        self.rows: list[tuple] = []
        self.since = time.monotonic()
        self.system.create_dir(self.folder, recursive=True)

    def digests(self) -> set[str]:
        """What earlier attempts of this caller have stored."""
        found: set[str] = set()
        for info in self.system.get_file_info(fs.FileSelector(self.folder)):
            if info.base_name.endswith(".parquet") and not info.base_name.startswith("_"):
                with self.system.open_input_file(info.path) as file:
                    found.update(pq.read_table(file, columns=["digest"])["digest"].to_pylist())
        return found

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        if len(self.rows) >= self.every or time.monotonic() - self.since >= self.seconds:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            name = f"{uuid.uuid4().hex}.parquet"
            with self.system.open_output_stream(f"{self.folder}/_{name}") as out:
                table = pa.table([list(c) for c in zip(*self.rows)], schema=_KIND)
                pq.write_table(table, out)
            self.system.move(f"{self.folder}/_{name}", f"{self.folder}/{name}")
        self.rows, self.since = [], time.monotonic()


def reply_store(spark: SparkSession, store: str) -> DataFrame:
    """(digest, reply, error) of all texts ever asked, one row each; a reply outweighs an error."""
    return (
        spark.read.schema(STORED).option("recursiveFileLookup", "true").parquet(_made(spark, store))
        .groupBy("digest")
        .agg(F.min(F.struct(F.col("reply").isNull().alias("failed"), "reply", "error")).alias("_r"))
        .select("digest", "_r.reply", "_r.error")
    )


def _made(spark: SparkSession, store: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return store


def fetch_replies(
    df: DataFrame,
    column: str,
    extractor: Callable[[str], str],
    store: str,
    prompt: str = PROMPT,
    in_flight: int = 20,
    callers: int = 4,
    attempts: int = 10,
    pauses: tuple[float, float] = (2.0, 60.0),
    retryable: tuple[type[BaseException], ...] = (RetryableError,),
    every: int = 100,
    seconds: float = 5.0,
    task_bytes: int = 128 << 20,
) -> int:
    """Ask for every distinct text of ``column`` without a stored reply; the number of texts asked.

    At most ``in_flight`` calls run at a time over all tasks: ``callers`` tasks with an equal share
    each. Texts are dealt to as many tasks as need to read some ``task_bytes`` each, which are run
    ``callers`` at a time, round after round, from one shuffle. A text whose call fails in the end is stored with its error, and asked again by the
    next run. Null texts are not asked; an empty one is a text like others. ``store`` is a
    folder that all executors reach by a path that pyarrow knows as well (file, hdfs, s3, gs, abfs).
    Replies are written after ``every`` of them or ``seconds``. Speculative execution would ask twice.
    """
    if not 1 <= callers <= in_flight:
        raise ValueError("callers must be at least 1, and at most in_flight")
    share = in_flight // callers
    folder = f"{store.rstrip('/')}/run-{uuid.uuid4().hex}"
    spark = df.sparkSession

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = ReplyWriter(f"{folder}/caller-{TaskContext.get().partitionId()}", every, seconds)
        known, throttle, made = writer.digests(), Throttle(share), 0

        def guarded(text: str) -> str:
            with throttle:
                try:
                    reply = extractor(text)
                except retryable:
                    throttle.report(retryable_error=True)
                    raise
            throttle.report(retryable_error=False)
            return reply

        def one(key: str, text: str) -> tuple:
            try:
                return key, call_with_retry(guarded, text, attempts, pauses, retryable), None
            except Exception as failure:  # noqa: BLE001 - extractors raise what they like
                return key, None, f"{type(failure).__name__}: {failure}"

        with ThreadPoolExecutor(share) as pool:
            running: set[Future] = set()
            for key, text in _pairs(batches):
                if key in known:
                    continue
                if len(running) >= share:
                    made += _collect(running, writer)
                running.add(pool.submit(one, key, text))
            while running:
                made += _collect(running, writer)
        writer.flush()
        yield pd.DataFrame({"made": [made + len(known)]})

    size = df.agg(F.sum(F.octet_length(column).cast("bigint"))).first()[0] or 0
    parts = callers * max(1, -(-size // (callers * task_bytes)))
    small_batches(spark)
    asked = (
        df.select(digest(F.col(column), prompt).alias("digest"), F.col(column).alias("text"))
        .where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.any_value("text").alias("text"))
        .join(reply_store(spark, store).where("error IS NULL").select("digest"), "digest", "left_anti")
        .repartition(parts, "digest")
    )
    made = asked.mapInPandas(ask, "made bigint").rdd
    rounds = range(0, made.getNumPartitions(), callers)
    return sum(sum(_round(made, range(r, min(r + callers, made.getNumPartitions())))) for r in rounds)


def _round(made: RDD, tasks: range) -> list[int]:
    """Run these partitions only; the shuffle below them is made once for all rounds."""
    return made.context.runJob(made, lambda rows: [r["made"] for r in rows], list(tasks))


def _pairs(batches: Iterable[pd.DataFrame]) -> Iterator[tuple[str, str]]:
    for batch in batches:
        yield from zip(batch["digest"], batch["text"])


def _collect(running: set[Future], writer: ReplyWriter) -> int:
    """Store the calls that are done, waiting for one at least."""
    done, _ = wait(running, return_when=FIRST_COMPLETED)
    for call in done:
        running.discard(call)
        writer.add(call.result())
    return len(done)


def with_replies(
    df: DataFrame, column: str, store: str, prompt: str = PROMPT, out: str = "reply", error: str = "error"
) -> DataFrame:
    """``df`` with the stored reply, or what the last call raised, of each row's text.

    Both are null for a null text and for one that was never asked."""
    stored = reply_store(df.sparkSession, store).select(
        F.col("digest").alias("__digest"), F.col("reply").alias(out), F.col("error").alias(error)
    )
    keyed = df.withColumn("__digest", digest(F.col(column), prompt))
    joined = join_per_key(keyed, stored, ["__digest"], "left")
    return joined.select(*df.columns, out, error)


def extract_features_once(
    df: DataFrame,
    column: str,
    extractor: Callable[[str], str],
    store: str,
    whole_fallback: bool = False,
    prompt: str = PROMPT,
    **options,
) -> DataFrame:
    """Features of each row's text, from the store; what it lacks is asked first (see ``fetch_replies``)."""
    fetch_replies(df, column, extractor, store, prompt, **options)
    replies = with_replies(df, column, store, prompt, "_reply", "_error")
    return features_of(replies, df.columns, "_reply", "_error", whole_fallback)
