"""Scaling fitted on the first rows of a stream, which then scores all rows that follow.

The first ``n`` rows fill a small table, batch by batch. The batch that completes it fits the scaling;
from then on every batch is scored with it in parallel. Both the table's parts and the scaling are
written under the batch's own name, so a batch that is run again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clicktide.sources.writers import path_exists
from clicktide.streaming.drift import Scaling, fit_scaling, z_score

_FITTED = "column string, median double, mean double, deviation double, batch_id bigint"


def read_scaling(spark: SparkSession, state: str) -> tuple[Scaling, int] | None:
    """The scaling and the batch that completed it; None while rows are still missing."""
    if not path_exists(spark, f"{state}/scaling/_SUCCESS"):
        return None
    rows = spark.read.schema(_FITTED).json(f"{state}/scaling").collect()  # one per column
    return {r["column"]: (r.median, r.mean, r.deviation) for r in rows}, rows[0].batch_id


def _head(spark: SparkSession, state: str, schema, before: int) -> DataFrame:
    """Fitting rows of earlier batches; at most the number that the fit takes."""
    folders = (f"{state}/head/batch_id={i}" for i in range(before))
    parts = [f for f in folders if path_exists(spark, f)]
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)


def start_fitted(
    stream: DataFrame,
    columns: Sequence[str],
    order: Sequence[str],
    path: str,
    state: str,
    checkpoint: str,
    n: int = 1000,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Write each row behind the first ``n`` with ``z_<column>`` for every one of ``columns``.

    Within a batch rows count in the ``order`` given; of the stream's first ``n`` rows none is scored,
    they make the scaling (see ``drift.fit_scaling``). Rows that tie in ``order`` are parted by their
    other values. ``state`` is a folder of this query's own, kept like its checkpoint.
    """
    spark = stream.sparkSession
    whole = [*order, *[c for c in stream.columns if c not in order]]

    def write(batch: DataFrame, batch_id: int) -> None:
        fitted = read_scaling(spark, state)
        scored = batch
        if fitted is None or fitted[1] == batch_id:
            schema = batch.schema
            earlier = _head(spark, state, schema, batch_id)
            missing = n - earlier.count()
            # Sorted by task, of which only the least rows travel on: never more than n.
            head = batch.orderBy(*whole).limit(missing)
            here = f"{state}/head/batch_id={batch_id}"
            head.write.mode("overwrite").parquet(here)
            taken = spark.read.schema(schema).parquet(here)
            if taken.count() < missing:
                return
            scaling = fit_scaling(earlier.unionByName(taken), columns, whole, n)
            rows = [(c, *scaling[c], batch_id) for c in columns]
            spark.createDataFrame(rows, _FITTED).coalesce(1).write.mode("overwrite").json(f"{state}/scaling")
            scored = batch.exceptAll(taken)  # one copy of each fitting row goes
        else:
            scaling = fitted[0]
        z = {f"z_{c}": z_score(c, scaling) for c in columns}
        scored.withColumns(z).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()

