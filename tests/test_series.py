import random

import pytest

from clicktide.operators import series

S = "s string, t bigint, load_pct double"


def test_hysteresis_fixture(many_chunks):
    loads = [0.84, 0.85, 0.50, 0.31, 0.30, 0.50]
    df = many_chunks.createDataFrame([("a", i, x) for i, x in enumerate(loads)], S)
    found = series.hysteresis(df, ["s"], ["t"]).orderBy("t").collect()
    assert [r["backpressure_active"] for r in found] == [False, True, True, True, False, False]


def test_hysteresis_over_many_chunks(many_chunks):
    rng = random.Random(0)
    rows = [(rng.choice("aaaab"), t, rng.random() * 0.4 + 0.28) for t in range(4000)]
    expected, state = {}, {}
    for s, t, x in rows:
        state[s] = True if x >= 0.85 or x >= 0.66 else False if x <= 0.30 else state.get(s, False)
        expected[t] = state[s]
    df = many_chunks.createDataFrame(rows, S)
    found = series.hysteresis(df, ["s"], ["t"], high=0.66, low=0.30).collect()
    assert {r["t"]: r["backpressure_active"] for r in found} == expected


def test_backlog_over_many_chunks(many_chunks):
    rng = random.Random(1)
    rows = [(rng.choice("aaab"), t, rng.randrange(7), 3) for t in range(3000)]
    expected, depth = {}, {}
    for s, t, arrivals, capacity in rows:
        depth[s] = max(0, depth.get(s, 0) + arrivals - capacity)
        expected[t] = depth[s]
    df = many_chunks.createDataFrame(rows, "s string, t bigint, arrivals bigint, capacity bigint")
    found = series.backlog(df, ["s"], ["t"]).collect()
    assert {r["t"]: r["queue_depth"] for r in found} == expected


def test_recent_view_over_many_chunks(many_chunks):
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 1, 2]), i // 3, i, rng.choice(["pv"] + ["buy"] * 7)) for i in range(3000)]
    expected, seen = {}, {}
    for user, _, i, behavior in rows:
        past = seen.setdefault(user, [])
        expected[i] = "pv" in past[-5:]
        past.append(behavior)
    df = many_chunks.createDataFrame(rows, "user_id bigint, timestamp bigint, id bigint, behavior_type string")
    found = series.recent_view_flag(df, ["timestamp", "id"]).collect()
    assert {r["id"]: r["recent_view"] for r in found} == expected


def test_slope(many_chunks):
    rows = [("two", 0, 1.0), ("two", 1, 2.0), ("three", 0, 9.0), ("three", 1, 1.0), ("three", 2, 4.0)]
    rows += [("line", t, 5.0 if t < 4 else 2.0 * t) for t in range(10)]
    df = many_chunks.createDataFrame(rows, "s string, t bigint, depth double")
    found = {r["s"]: r for r in series.regression_slope(df, ["s"], "t", "depth").collect()}
    assert found["two"]["measured_slope"] is None and found["two"]["samples"] == 2
    assert found["three"]["measured_slope"] == pytest.approx(3.0)
    assert found["line"]["measured_slope"] == pytest.approx(2.0)
    assert series.theoretical_slope(30, 0.1, 2) == pytest.approx(10)


def test_histogram(spark):
    rows = [("flat", 4.0)] * 5 + [("range", float(i)) for i in range(11)]
    df = spark.createDataFrame(rows, "s string, v double")
    found = {(r["s"], r["bin"]): (r["bin_start"], r["cnt"]) for r in series.histogram(df, ["s"], "v", 10).collect()}
    assert found[("flat", 5)] == (4.0, 5)
    assert found[("range", 9)] == (9.0, 2) and found[("range", 0)] == (0.0, 1)
    assert sum(n for _, n in found.values()) == len(rows)
    whole = {r["bin"]: r["cnt"] for r in series.histogram(df, [], "v", 10).collect()}
    assert sum(whole.values()) == len(rows) and whole[9] == 2 and whole[4] == 6
