import json
import random

import pytest
from pyspark.sql import functions as F

from clicktide.plans.scoring import start_scoring
from clicktide.session import scratch
from clicktide.sources import readers
from clicktide.streaming import drift, events, metrics, run, sessions, windows

GOOD = {"event_time": "2024-01-06 13:00:00.5", "user_id": 1, "item_id": 7, "behavior_type": "cart"}


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def altered(**changes):
    event = dict(GOOD) | changes
    return json.dumps({k: v for k, v in event.items() if v != "DROP"})


@pytest.mark.parametrize(
    "line, error",
    [
        (altered(), None),
        (altered(item_id="12.7"), None),
        (altered(user_id="DROP"), "missing user_id"),
        (altered(user_id=None), "bad user_id"),
        (altered(item_id="DROP"), "missing item_id"),
        (altered(item_id="not_an_int"), "bad item_id"),
        (altered(category_id=None), "bad category_id"),
        (altered(category_id=3), None),
        (altered(event_time="DROP"), "missing event_time"),
        (altered(event_time="2099/99/99 99:99:99"), "bad event_time"),
        (altered(event_time="2024-01-06 13:00:00"), "bad event_time"),
        (altered(event_time="DROP", timestamp=1704500000), None),
        (altered(timestamp=""), None),
        (altered(timestamp="soon"), "bad timestamp"),
        ('"BROKEN_EVENT_PAYLOAD"', "event must be an object"),
        ("[1]", "event must be an object"),
        ("{broken", "event must be an object"),
    ],
)
def test_parse(spark, line, error):
    assert events.parse_events(lines(spark, [line])).first()["error"] == error


def test_parsed_features(spark):
    row = events.parse_events(lines(spark, [altered(item_id="512.7")])).first()
    assert (row["item_id"], row["category_id"], row["hour"], row["dayofweek"]) == (512, 13, 13, 5)
    assert (row["is_weekend"], row["hour_bucket"], row["day_bucket"]) == (1.0, "13", "5")
    assert events.parse_events(lines(spark, [altered(category_id=3)])).first()["category_id"] == 3


def stream_of(spark, batches, files=None):
    path = scratch(spark, "test-lines")
    for batch in batches:
        lines(spark, batch).coalesce(1).write.mode("append").text(path)
    return readers.read_event_stream(spark, path, files)


def test_nothing_is_lost_and_a_rerun_changes_nothing(spark):
    faulty = [altered(), altered(item_id="x"), '"BROKEN_EVENT_PAYLOAD"', altered(behavior_type="buy")]
    stream = stream_of(spark, [faulty, faulty[:2]], files=1)
    path, query = run.run_available(events.score_and_route(stream), "test-routed", by=["route"], counters=metrics.counters())
    routed = run.read_batches(spark, path)
    assert routed.select("batch_id").distinct().count() == 2
    assert events.scored_events(routed).count() == 3 and events.dead_letters(routed).count() == 3
    assert {r["raw"] for r in events.dead_letters(routed).collect()} == {altered(item_id="x"), faulty[2]}
    labels = {(r["behavior_type"], r["predicted_label"]) for r in events.scored_events(routed).collect()}
    assert labels == {("cart", 0), ("buy", 1)}
    counted = metrics.progress_metrics(spark, query, path).agg(F.sum("produced"), F.sum("dead_lettered")).first()
    assert tuple(counted) == (6, 3)
    by_batch = routed.groupBy("batch_id").agg(*[c.alias(n) for n, c in metrics.counters().items()])
    kept = run.read_counters(spark, path).select(*by_batch.columns)
    assert sorted(kept.collect()) == sorted(by_batch.collect()), "no scan, the same counts"
    # The same batch written again, as after a failure, replaces itself.
    batch = routed.where("batch_id = 0").drop("batch_id").cache()
    batch.count()
    batch.write.mode("overwrite").partitionBy("route").parquet(f"{path}/batch_id=0")
    spark.catalog.refreshByPath(path)
    assert run.read_batches(spark, path).count() == 6


def test_summary_of_failed_rows(spark):
    routed = events.score_and_route(lines(spark, [altered(behavior_type="buy"), altered(), "{"]))
    row = events.scoring_summary(events.failed_as_score(routed)).first()
    assert (row["scored"], row["failed"], row["positive"], row["positive_ratio"]) == (2, 1, 1, 0.5)
    assert row["avg_buy_probability"] == pytest.approx((0.95 + 0.35) / 2)


def test_unusable_model_falls_back_to_rules(spark):
    scorer, reason = events.load_scorer(spark, "/tmp/no-such-model")
    assert scorer is events.rule_score and "no-such-model" in reason


def test_metrics_of_more_batches_than_reports(spark):
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "3")
    try:
        stream = stream_of(spark, [[altered(user_id=i)] for i in range(8)], files=1)
        path, query = run.run_available(events.score_and_route(stream), "test-many", by=["route"], counters=metrics.counters())
    finally:
        spark.conf.unset(key)
    assert len(query.recentProgress) <= 3
    found = metrics.progress_metrics(spark, query, path).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["produced"]) for r in found] == [(i, 1) for i in range(8)]
    assert found[0]["input_rate"] is None and found[-1]["input_rate"] is not None


def test_counters_survive_a_restart_and_a_failed_batch(spark, tmp_path):
    source, out, state = (f"{tmp_path}/{n}" for n in ("lines", "out", "state"))
    broken = {"left": 1}

    def shape(batch):
        if broken["left"] and batch.where("get_json_object(value, '$.user_id') = '2'").count():
            broken["left"] -= 1
            raise ValueError("lost")
        return events.score_and_route(batch)

    for users, ends in (([1], False), ([2, 3], True), ([], False), ([4], False)):
        if users:
            lines(spark, [altered(user_id=u) for u in users] + ["{"]).coalesce(1).write.mode("append").text(source)
        stream = readers.read_event_stream(spark, source)
        query = run.start(stream, out, state, by=["route"], shape=shape, counters=metrics.counters())
        if ends:
            with pytest.raises(Exception, match="lost"):
                query.awaitTermination()
        else:
            query.awaitTermination()
    found = run.read_counters(spark, out).orderBy("batch_id").collect()
    assert [(r["produced"], r["dead_lettered"]) for r in found] == [(2, 1), (3, 1), (2, 1)]
    assert [r["consumed"] for r in found] == [1, 2, 1]


def test_a_model_that_fails_while_running(spark, tmp_path):
    """The batch is scored by the rules, with the reason; other batches keep the model."""

    def scorer(parsed):
        explode = F.when(F.col("user_id") == 13, F.raise_error(F.lit("model broke")).cast("double"))
        return parsed.withColumns(
            {"predicted_label": F.lit(1), "buy_probability": explode.otherwise(0.9), "score_tag": F.lit("")}
        )

    source = f"{tmp_path}/lines"
    for batch in ([altered(user_id=1)], [altered(user_id=13), altered(user_id=2)]):
        lines(spark, batch).coalesce(1).write.mode("append").text(source)
    out = f"{tmp_path}/out"
    query = start_scoring(spark, source, out, f"{tmp_path}/state", files_per_batch=1, scorer=scorer)
    query.awaitTermination()
    found = {r["user_id"]: r for r in run.read_batches(spark, out).collect()}
    assert (found[1]["error"] or "", found[1]["buy_probability"], found[1]["fallback_reason"]) == ("", 0.9, None)
    for user in (13, 2):
        assert found[user]["error"] == "RULE_FALLBACK" and found[user]["buy_probability"] == 0.35
        assert "model broke" in found[user]["fallback_reason"]


def test_intake_follows_the_load(spark):
    loads = [0.2, 0.9, 0.5, 0.4]
    samples = spark.createDataFrame(list(enumerate(loads)), "at int, load_pct double")
    assert metrics.load_is_high(samples)
    assert not metrics.load_is_high(samples.unionByName(spark.createDataFrame([(9, 0.1)], "at int, load_pct double")))
    assert not metrics.load_is_high(samples.limit(0))


@pytest.mark.parametrize(
    "line",
    [altered(event_time="2024-01-06 13:00:00.123456"), altered(event_time="2024-1-6 13:0:0.1"),
     altered(event_time="DROP", timestamp=1704546000), altered(event_time="x", timestamp="1704546000.7")],
)
def test_times_of_windows_are_those_of_parsing(spark, line):
    frame = lines(spark, [line])
    seconds = events.parse_events(frame).first()["timestamp"]
    timed = windows.timed_events(frame)
    assert seconds == 1704546000
    assert timed.select(F.unix_seconds("event_ts")).first()[0] == seconds
    assert windows.window_counts(timed).first()["window_start"] == 1704546000


def test_events_without_a_time_are_counted(spark):
    frame = lines(spark, [altered(), altered(event_time="soon"), altered(event_time="DROP"), "no json"])
    found = {r["timed"]: r["cnt"] for r in windows.untimed(windows.timed_events(frame)).collect()}
    assert found == {True: 1, False: 2}


def test_a_line_is_parsed_once(spark):
    odd = ['{"user_id": "1", "user_id": " 2.7 ", "item_id": 3e2, "event_time": {"a": 1}}', "{}", "[1]", '{"user_id": 1', ""]
    timed = windows.timed_events(lines(spark, [altered(), *odd]), ["item_id"])
    kept = timed.where("event_ts IS NOT NULL AND user_id IS NOT NULL")
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert [tuple(r)[1:] for r in timed.collect()][1:] == [(2, "unknown", 300), (None, "unknown", None)]


def test_windows_in_two_batches_equal_one(spark):
    def event(second, behavior):
        return altered(event_time=f"2024-01-06 13:00:{second:02d}.000", behavior_type=behavior)

    first = [event(0, "view"), event(9, "cart"), event(12, "view"), "no json"]
    second = [event(5, "purchase"), event(13, "DROP"), event(31, "fav")]
    counts = windows.window_counts(windows.timed_events(stream_of(spark, [first, second], files=1)))
    path, _ = run.run_available(counts, "test-windows", output_mode="update")
    found = run.latest(spark, path, ["window_start"]).orderBy("window_start").collect()
    assert [(r["view"], r["cart"], r["purchase"], r["other"], r["total"]) for r in found] == [
        (1, 1, 1, 0, 3), (1, 0, 0, 1, 1), (0, 0, 0, 1, 0)]
    batch = windows.window_counts(windows.timed_events(lines(spark, first + second)))
    assert sorted(map(tuple, batch.collect())) == sorted(tuple(r) for r in found)


def test_session_gap_in_a_stream(spark):
    times = ["13:00:00.000", "13:30:00.000", "14:00:00.001"]
    batch = [altered(event_time=f"2024-01-06 {t}") for t in times]
    found = sessions.stream_sessions(windows.timed_events(stream_of(spark, [batch])))
    path, _ = run.run_available(found, "test-sessions", output_mode="complete")
    rows = run.last_batch(spark, path).orderBy("start_ms").collect()
    assert [r["events"] for r in rows] == [2, 1]
    assert rows[0]["end_ms"] - rows[0]["start_ms"] == 1800_000


def at(minute, behavior, user=1):
    time = f"2024-01-06 {8 + minute // 60:02d}:{minute % 60:02d}:00.000"
    return altered(event_time=time, behavior_type=behavior, user_id=user)


MARK = altered(event_time="2100-01-01 00:00:00.000", user_id="DROP")


def histories(spark, batches, timeout=1800):
    """Sessions of a run with these batches, the last of which moves the watermark past all."""
    stream = stream_of(spark, [*batches, [MARK]], files=1)
    found = sessions.session_history(windows.timed_events(stream), timeout, lateness="2 days")
    path, _ = run.run_available(found, "test-history")
    rows = sessions.numbered(run.read_batches(spark, path)).collect()
    return sorted(
        (r["user_id"], r["session_no"], r["start_ms"], r["end_ms"], r["events"],
         tuple((h["ms"], h["behavior"]) for h in r["history"]))
        for r in rows
    )


def test_history_keeps_the_last_ten_across_batches(spark):
    first = [at(m, f"add to {m:02d}") for m in range(8)]
    second = [at(m, f"add to {m:02d}") for m in range(8, 14)] + [at(13 + 31, "late")]
    rows = histories(spark, [first, second])
    assert [(r[1], r[4]) for r in rows] == [(1, 14), (2, 1)]
    assert [b for _, b in rows[0][5]] == [f"add to {m:02d}" for m in range(4, 14)]


def test_sessions_do_not_depend_on_batches(spark):
    rng = random.Random(6)
    rows = [at(m, rng.choice(["view", "cart", "add to cart"]), rng.choice([1, 2])) for m in rng.sample(range(900), 60)]
    rows += rows[:3]  # copies
    whole = histories(spark, [rows])
    assert len({r[:2] for r in whole}) > 6
    rng.shuffle(rows)
    assert histories(spark, [rows[i::5] for i in range(5)]) == whole


def test_a_late_part_opens_a_session_of_its_own(spark):
    day = 25 * 60
    rows = histories(spark, [[at(day % 900 + 300, "now")], [at(10, "long ago")]])
    assert [(r[1], r[4]) for r in rows] == [(1, 1), (2, 1)]
    joined = histories(spark, [[at(100, "a")], [at(160, "c")], [at(130, "b")]])
    assert [(r[4], [b for _, b in r[5]]) for r in joined] == [(3, ["a", "b", "c"])]


def test_drift(spark):
    rows = [(i, "1" if i < 3 else "bad" if i == 3 else "5", "2") for i in range(8)]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    scaling = drift.fit_scaling(df, ["a", "b"], ["i"], n=4)
    assert scaling == {"a": (1.0, 1.0, 1.0), "b": (2.0, 2.0, 1.0)}
    row = drift.drift_report(df, scaling).first()
    assert row["consumed"] == 8 and row["z_mean_a"] == pytest.approx(2.0) and row["z_std_b"] == 0.0


def test_intake_options():
    assert metrics.intake_options("file", 30) == {"maxFilesPerTrigger": 30}
    assert metrics.intake_options("kafka", 30, hot=True) == {"maxOffsetsPerTrigger": 10}
