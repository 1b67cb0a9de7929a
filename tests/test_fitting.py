"""A scaling fitted on a stream's first rows, in any batches."""

import random

import pytest

from clicktide.session import scratch
from clicktide.streaming import drift, fitting, run

SCHEMA = "id int, a double, b string"
ORDER = ["id"]


def made(n=140):
    rng = random.Random(2)
    return [(i, rng.choice([None, rng.gauss(5, 2)]), rng.choice(["7", "x", str(rng.randrange(90))])) for i in range(n)]


def stream(spark, rows, batches, n, fail=None):
    source, out, state, checkpoint = (scratch(spark, x) for x in ("fit-in", "fit-out", "fit-state", "fit-check"))
    size = -(-len(rows) // batches)
    queries = []
    for i in range(0, len(rows), size):
        df = spark.createDataFrame(rows[i : i + size], SCHEMA)
        df.coalesce(1).write.mode("append").parquet(source)
        reader = spark.readStream.schema(SCHEMA).parquet(source)
        # A new query each time: it goes on from its checkpoint and the state folder.
        query = fitting.start_fitted(reader, ["a", "b"], ORDER, out, state, checkpoint, n)
        query.awaitTermination()
        queries.append(query)
    return out, state


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_equal_to_the_fit_of_the_finished_table(spark, batches):
    rows, n = made(), 50
    out, state = stream(spark, rows, batches, n)
    table = spark.createDataFrame(rows, SCHEMA)
    scaling = drift.fit_scaling(table, ["a", "b"], ORDER, n)
    found = fitting.read_scaling(spark, state)[0]
    assert {c: pytest.approx(v, rel=1e-12) for c, v in scaling.items()} == found
    expected = table.where(f"id >= {n}").withColumns({f"z_{c}": drift.z_score(c, scaling) for c in ("a", "b")})
    got = sorted(run.read_batches(spark, out).drop("batch_id").collect())
    assert [r.id for r in got] == list(range(n, len(rows)))
    for a, b in zip(got, sorted(expected.collect())):
        assert (a.z_a, a.z_b) == (pytest.approx(b.z_a), pytest.approx(b.z_b))


def test_equal_rows_and_too_few_rows(spark):
    rows = [(1, 2.0, "3")] * 30
    out, state = stream(spark, rows, 2, 20)
    assert run.read_batches(spark, out).count() == 10
    _, state = stream(spark, rows[:5], 1, 20)
    assert fitting.read_scaling(spark, state) is None
