"""Hysteresis over a stream equals hysteresis over the finished table."""

import random
from datetime import datetime, timedelta

import pytest

from clicktide.operators.series import hysteresis
from clicktide.session import scratch
from clicktide.streaming import run
from clicktide.streaming.load_state import stream_hysteresis

SCHEMA = "host string, at timestamp, load_pct double"
FAR = ("end", datetime(2100, 1, 1), 0.0)


def made_samples():
    rng, start = random.Random(4), datetime(2024, 3, 1)
    return [
        (host, start + timedelta(seconds=20 * i), rng.choice([0.1, 0.3, 0.5, 0.6, 0.7, 0.85, 0.95, None]))
        for host in ("a", "b", None)
        for i in range(100)
    ]


@pytest.mark.parametrize("batches", [1, 7])
def test_stream_equals_table(spark, batches):
    samples = made_samples()
    rng = random.Random(batches)
    arrival = sorted(samples, key=lambda s: s[1] + timedelta(seconds=rng.randrange(500)))
    size = -(-len(arrival) // batches)
    source, out, state = (scratch(spark, n) for n in ("loads", "loads-out", "loads-state"))
    for i in range(0, len(arrival), size):
        spark.createDataFrame(arrival[i : i + size], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    spark.createDataFrame([("a", None, 0.9), FAR], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    with run.rocksdb_state(spark):
        query = run.start(stream_hysteresis(stream, ["host"]), out, state)
    query.awaitTermination()
    found = run.read_batches(spark, out).selectExpr("host", "ms", "load_pct", "backpressure_active")
    table = hysteresis(spark.createDataFrame(samples, SCHEMA), ["host"], ["at"])
    expected = table.selectExpr("host", "unix_millis(at) AS ms", "load_pct", "backpressure_active")
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert {r.backpressure_active for r in found.collect()} == {True, False}
