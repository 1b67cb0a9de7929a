"""Starting streams and reading what they wrote.

Every micro-batch goes to ``<path>/batch_id=<n>`` in overwrite mode. A batch that is run again
after a failure replaces its own folder, so each row counts exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicktide.session import scratch


def start(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str = "append",
    processing_time: str | None = None,
    by: Sequence[str] = (),
    shape: Callable[[DataFrame], DataFrame] | None = None,
    fallback: Callable[[DataFrame, Exception], DataFrame] | None = None,
    counters: Mapping[str, Column] | None = None,
) -> StreamingQuery:
    """Write each micro-batch under its id, after ``shape`` if given.

    ``counters`` are aggregates over what is written. They are taken while a batch is written, in the
    task that writes a row, and kept as one row per batch beside ``path`` (see ``read_counters``).

    If shaping or writing a batch fails, ``fallback`` gets the batch and the error, and what it
    returns is written instead; without it, or if that fails too, the query ends.

    Without ``processing_time`` all available input is processed and the stream stops; with it
    a batch starts at that interval, which bounds the age of a row (batch size is bounded at
    the source, see ``read_event_stream``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        def put(shaped: DataFrame) -> None:
            seen = Observation()
            if counters:
                shaped = shaped.observe(seen, *[c.alias(name) for name, c in counters.items()])
            writer = shaped.write.mode("overwrite")
            if by:
                writer = writer.partitionBy(*by)
            writer.parquet(f"{path}/batch_id={batch_id}")
            if counters:
                _keep_counters(shaped.sparkSession, path, batch_id, seen.get, counters)

        try:
            put(shape(batch) if shape else batch)
        except Exception as error:  # noqa: BLE001 - whatever failed, the fallback may do
            if fallback is None:
                raise
            put(fallback(batch, error))

    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
        .trigger(**trigger)
        .start()
    )


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[SparkSession]:
    """Queries started inside keep their state in RocksDB, as timers and keyed state need."""
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    with _setting(spark, "spark.sql.streaming.stateStore.providerClass", provider):
        yield spark


@contextmanager
def no_empty_batches(spark: SparkSession) -> Iterator[SparkSession]:
    """Queries run inside leave what their last rows make due to the next batch with rows, which may
    be of a later start; no batch without rows is run for it."""
    with _setting(spark, "spark.sql.streaming.noDataMicroBatches.enabled", "false"):
        yield spark


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def run_available(stream: DataFrame, name: str, **options) -> tuple[str, StreamingQuery]:
    """Process what is there into a new folder; returns the folder and the finished query."""
    path = scratch(stream.sparkSession, name)
    query = start(stream, path, scratch(stream.sparkSession, f"{name}-state"), **options)
    query.awaitTermination()
    return path, query


def _keep_counters(
    spark: SparkSession, path: str, batch_id: int, values: dict, counters: Mapping[str, Column]
) -> None:
    row = spark.range(1, numPartitions=1).select(*[F.lit(values[n]).cast("bigint").alias(n) for n in counters])
    row.write.mode("overwrite").parquet(f"{path}.counters/batch_id={batch_id}")


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch written to ``path`` with its counters; no written row is read again.

    They are files like the batches, so they outlive the query, and a batch that is run again
    replaces its own."""
    return spark.read.parquet(f"{path}.counters")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches, with ``batch_id``."""
    return spark.read.parquet(path)


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Of a stream of updates, the newest row per key.

    The newest batch wins by an aggregate that combines before the shuffle.
    """
    updates = read_batches(spark, path)
    rest = [c for c in updates.columns if c not in (*keys, "batch_id")]
    newest = updates.groupBy(*keys).agg(F.max(F.struct("batch_id", *rest)).alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def last_batch(spark: SparkSession, path: str) -> DataFrame:
    """Of a stream in complete mode, the newest result.

    Its folder is found by listing the folders; no data file is opened for that.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    names = [status.getPath().getName() for status in listed]
    newest = max(int(n.split("=")[1]) for n in names if n.startswith("batch_id="))
    return spark.read.parquet(f"{path}/batch_id={newest}")
