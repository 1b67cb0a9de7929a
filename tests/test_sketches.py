"""Distinct counts from merged sketches."""

import random

import pytest

from clicktide.operators import sketches

LOG = "user_id bigint, behavior_type string, timestamp bigint"
DAY = 86_400


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return [
        (rng.randrange(9000) if rng.random() < 0.98 else None, rng.choice(["pv", "buy"]), rng.randrange(10 * DAY))
        for _ in range(40_000)
    ]


def exact(rows, low, high, behavior=None):
    held = [u for u, b, t in rows if low <= t // DAY <= high and behavior in (None, b)]
    return len(held), len({u for u in held if u is not None})


def test_any_range_lies_within_the_stated_error(spark, rows, tmp_path):
    log = spark.createDataFrame(rows, LOG)
    sketches.update_days(log, f"{tmp_path}/days")
    for low, high in ((0, 9), (2, 2), (3, 7)):
        first, last = f"1970-01-{low + 1:02d}", f"1970-01-{high + 1:02d}"
        for r in sketches.visitors_between(spark, f"{tmp_path}/days", first, last).collect():
            n, users = exact(rows, low, high, r.behavior_type)
            assert r.rows == n and abs(r.uv_count - users) <= sketches.error_bound() * users
        (r,) = sketches.visitors_between(spark, f"{tmp_path}/days", first, last, ()).collect()
        n, users = exact(rows, low, high)
        assert r.rows == n and abs(r.uv_count - users) <= sketches.error_bound() * users
    assert sketches.visitors_between(spark, f"{tmp_path}/days", "1999-01-01", "1999-01-02").count() == 0


def test_a_union_equals_one_pass(spark, rows):
    log = spark.createDataFrame(rows, LOG).withColumn("day", sketches.day_of())
    whole = sketches.visitor_sketches(log, ["behavior_type"])
    united = sketches.merge(sketches.visitor_sketches(log, ["day", "behavior_type"]), ["behavior_type"])
    twice = sketches.merge(united.unionByName(whole), ["behavior_type"])
    counts = [
        {r.behavior_type: r.uv_count for r in sketches.estimates(s).collect()} for s in (united, twice)
    ]
    assert counts[0] == counts[1], "nothing is counted twice"
    for r in sketches.estimates(whole).collect():
        assert abs(r.uv_count - counts[0][r.behavior_type]) <= 0.01 * r.uv_count


def test_a_day_is_replaced(spark, tmp_path):
    root = f"{tmp_path}/days"
    old = [(u, "pv", d * DAY) for d in range(3) for u in range(10)]
    assert sketches.update_days(spark.createDataFrame(old, LOG), root) == 0
    new = [(u, "pv", DAY + 5) for u in range(100, 104)] + [(1, "pv", None)]
    assert sketches.update_days(spark.createDataFrame(new, LOG), root) == 1
    found = {
        str(r.day): (r["rows"], r.uv_count)
        for r in sketches.estimates(sketches.read_versioned(spark, root)).collect()
    }
    assert found == {"1970-01-01": (10, 10), "1970-01-02": (4, 4), "1970-01-03": (10, 10)}
