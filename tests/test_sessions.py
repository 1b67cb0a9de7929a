import random

import pytest

from clicktide.functions.scalars import BEHAVIORS
from clicktide.operators import sessions
from clicktide.plans.behavior import clean_behavior


def brute(rows, timeout):
    out = {}
    for user in {r[0] for r in rows}:
        number, last = 0, None
        for r in sorted((r for r in rows if r[0] == user), key=lambda r: r[4]):
            if last is None or r[4] - last > timeout:
                number += 1
            last = r[4]
            out[r[:2] + (r[4],)] = number
    return out


def ids(df):
    return {(r["user_id"], r["item_id"], r["timestamp"]): r["session_id"] for r in df.collect()}


def test_gap_of_exactly_the_timeout_stays(log):
    times = [5000, 5000 + 1800, 5000 + 1800 + 1801, 5000 + 1800 + 1801]
    rows = [(1, i, 1, "pv", t) for i, t in enumerate(times)] + [(2, 0, 1, "pv", 10)]
    random.Random(0).shuffle(rows)
    found = ids(sessions.sessionize(log(rows)))
    assert found == {(1, 0, 5000): 1, (1, 1, 6800): 1, (1, 2, 8601): 2, (1, 3, 8601): 2, (2, 0, 10): 1}


def test_random_sessions_with_hot_user_and_negative_times(log):
    rng = random.Random(1)
    rows = [(rng.choice([7, 7, 7, rng.randrange(20)]), i, 1, "pv", rng.randrange(-90_000, 300_000))
            for i in range(1500)]
    for timeout in (60, 1800):
        assert ids(sessions.sessionize(log(rows), timeout)) == brute(rows, timeout)


def test_global_ids_have_no_hole(log):
    rng = random.Random(2)
    rows = [(rng.choice([3, 70_000, 5_000_000_000]), i, 1, "pv", rng.randrange(200_000)) for i in range(300)]
    found = ids(sessions.sessionize_global(log(rows)))
    expected, number, last = {}, 0, None
    for r in sorted(rows, key=lambda r: (r[0], r[4])):
        if last is None or last[0] != r[0] or r[4] - last[4] > 1800:
            number += 1
        last = r
        expected[r[:2] + (r[4],)] = number
    assert found == expected
    assert set(found.values()) == set(range(1, max(found.values()) + 1))


def test_null_user_keeps_rows(log):
    rows = [(None, 1, 1, "pv", 100), (None, 2, 1, "pv", 5000), (1, 1, 1, "pv", 100)]
    assert sorted(r["session_id"] for r in sessions.sessionize(log(rows)).collect()) == [1, 1, 2]


def views(user, n, start=1000):
    return [(user, i, 1, "pv", start + i) for i in range(n)]


def test_clean_thresholds(log):
    rows = views(1, 500) + views(2, 501) + views(3, 500) + views(3, 1) + [(2, 9, 1, "buy", 10)]
    rows += [(4, 1, 1, "buy", 50), (4, 1, 1, "pv", 60), (5, 1, 1, "buy", 50), (6, 1, 1, "cart", 50)]
    rows += [(1, 1, 1, "pv", 0), (1, 1, 1, "pv", -5), (None, 1, 1, "pv", 70)]
    kept = clean_behavior(log(rows)).groupBy("user_id").count().collect()
    assert {r["user_id"]: r["count"] for r in kept} == {1: 500, 3: 500, 4: 2, 6: 1}


def test_copies_count_towards_the_threshold_if_asked(log):
    rows = views(1, 6) * 2 + views(2, 6)
    after = clean_behavior(log(rows), pv_threshold=10)
    before = clean_behavior(log(rows), pv_threshold=10, dedup_first=False)
    assert {r["user_id"] for r in after.collect()} == {1, 2}
    assert {r["user_id"] for r in before.collect()} == {2}


def test_survivor_of_clashing_copies(log):
    rows = [(1, 1, 9, "pv", 10), (1, 1, 5, "cart", 10), (1, 1, 4, "cart", 10), (1, 2, 1, "pv", 10)]
    across = {(r["item_id"], r["behavior_type"], r["category_id"]) for r in clean_behavior(log(rows)).collect()}
    assert across == {(1, "cart", 4), (2, "pv", 1)}
    within = clean_behavior(log(rows), per_behavior=True)
    assert {(r["item_id"], r["behavior_type"], r["category_id"]) for r in within.collect()} == {
        (1, "cart", 4), (1, "pv", 9), (2, "pv", 1)}


def test_empty_log(log):
    assert clean_behavior(log([])).count() == 0
    assert sessions.sessionize_global(log([])).count() == 0


def test_cleaned_log_passes_its_checks(log):
    from clicktide.operators.quality import quality_report, summary

    rng = random.Random(3)
    rows = [(rng.randrange(30), rng.randrange(5), 1, rng.choice(["pv", "pv", "cart", "fav", "buy"]),
             rng.randrange(-100, 5000)) for _ in range(2000)]
    report = quality_report(clean_behavior(log(rows)).drop("session_id"), min_rows=1)
    row = summary(report).first()
    assert row["passed"] == row["checks"] == 12


@pytest.mark.parametrize("per_behavior", [False, True])
@pytest.mark.parametrize("dedup_first", [False, True])
@pytest.mark.parametrize("behaviors", [None, BEHAVIORS])
def test_merge_runs_once(log, per_behavior, dedup_first, behaviors):
    """Both uses of the merged rows share one shuffle."""
    rows = log(views(1, 50) + views(2, 3))
    cleaned = clean_behavior(
        rows, per_behavior=per_behavior, dedup_first=dedup_first, behaviors=behaviors
    )
    cleaned.collect()
    plan = cleaned._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1
    assert ("SortAggregate" in plan) == (behaviors is None)


@pytest.mark.parametrize("per_behavior", [False, True])
@pytest.mark.parametrize("dedup_first", [False, True])
def test_both_merges_agree(log, per_behavior, dedup_first):
    rng = random.Random(9)
    rows = log([(rng.randrange(12), rng.randrange(4), rng.randrange(-3, 5), rng.choice(BEHAVIORS + ("pv",)),
                 rng.randrange(-100, 4000) // 9 * 9) for _ in range(3000)])
    options = dict(pv_threshold=90, per_behavior=per_behavior, dedup_first=dedup_first)
    sorting = clean_behavior(rows, **options)
    hashing = clean_behavior(rows, **options, behaviors=BEHAVIORS)
    assert sorted(map(tuple, sorting.collect())) == sorted(map(tuple, hashing.collect()))


def test_other_types_go_only_if_types_are_given(log):
    rows = log([(1, 1, 1, "pv", 10), (1, 2, 1, "share", 20)])
    assert clean_behavior(rows).count() == 2
    assert clean_behavior(rows, behaviors=BEHAVIORS).count() == 1
