"""Hysteresis of a load over a stream of samples: on and off are carried from batch to batch."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.streaming.ordered_state import in_time_order


def stream_hysteresis(
    samples: DataFrame,
    series: Sequence[str],
    time: str = "at",
    load: str = "load_pct",
    high: float = 0.85,
    low: float = 0.30,
    order: Sequence[str] = ("ms",),
    out: str = "backpressure_active",
    lateness: str = "10 minutes",
) -> DataFrame:
    """``series``, ``ms``, the load and ``out`` of every sample, in append mode.

    The rule is that of ``operators.series.hysteresis``: on at ``high``, off at ``low``, else as
    before; starts off. A sample leaves when the watermark has passed it; late ones within ``lateness``
    take their place in time, so the result is that of the finished table in any batches. Samples
    without a time are left out; one without a load changes nothing. The state of a series, one
    boolean, is kept for good.
    """

    def step(rows, starts, states):
        value = rows[load].cast("double").to_numpy()
        signal = np.where(value >= high, 1, np.where(value <= low, 0, -1))
        before = np.repeat([bool(s) for s in states], np.diff(starts, append=rows.num_rows))
        # The place of the last signal, if it is one of the same series.
        last = np.maximum.accumulate(np.where(signal >= 0, np.arange(rows.num_rows), -1))
        own = last >= np.repeat(starts, np.diff(starts, append=rows.num_rows))
        active = np.where(own, signal[last] == 1, before)
        ends = np.append(starts[1:], rows.num_rows) - 1
        return active[ends].tolist(), [pa.array(active)]

    watched = samples.where(F.col(time).isNotNull()).withWatermark(time, lateness)
    columns = [load, *[c for c in order if c not in ("ms", load)]]
    added = T.StructType([T.StructField(out, T.BooleanType())])
    return in_time_order(watched, series, time, columns, order, added, step, None)
