"""The reply store: equal texts once, a bound on the job's calls, and nothing paid twice."""

import os
import sys
import threading
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark import cloudpickle

from clicktide.operators import extraction, replies

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import this file


class Logged:
    """Notes every call in a file, with the calls that run at that moment in this process."""

    def __init__(self, folder, pause=0.0):
        self.folder, self.pause = str(folder), pause

    def note(self, text):
        with open(f"{self.folder}/calls", "a") as log:
            log.write(f"{text}\n")

    def __call__(self, text):
        self.note(text)
        time.sleep(self.pause)
        return '{"sentiment": "%s"}' % text


class Timed(Logged):
    """Notes begin and end of every call."""

    def __call__(self, text):
        begin = time.monotonic()
        time.sleep(0.1)
        self.note(f"{begin} {time.monotonic()}")
        return "{}"


class Dies(Logged):
    """Ends its worker process at one text, once."""

    def __call__(self, text):
        self.note(text)
        mark = Path(self.folder, "died")
        if text == "t7" and not mark.exists():
            mark.touch()
            os._exit(1)
        return "{}"


class Busy(Logged):
    """Refuses every text's first call."""

    def __call__(self, text):
        first = not Path(self.folder, f"seen-{text}").exists()
        Path(self.folder, f"seen-{text}").touch()
        self.note(text)
        if first:
            raise extraction.RetryableError("busy")
        if text == "never":
            raise ValueError("no answer")
        return "{}"


def calls(folder):
    return Counter(Path(folder, "calls").read_text().split("\n")[:-1])


def texts(spark, values, parts=8):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id int, text string").repartition(parts)


def test_equal_texts_are_asked_once(spark, tmp_path):
    store = f"file://{tmp_path}/store"
    df = texts(spark, [f"t{i % 9}" for i in range(300)] + [None, None, ""])
    asks = Logged(tmp_path)
    assert replies.fetch_replies(df, "text", asks, store) == 10
    assert replies.fetch_replies(df, "text", asks, store) == 0
    assert replies.fetch_replies(texts(spark, ["t1", "new"]), "text", asks, store) == 1
    assert set(calls(tmp_path).values()) == {1} and len(calls(tmp_path)) == 11
    rows = replies.with_replies(df, "text", store).collect()
    assert len(rows) == 303
    assert all(r.reply == (None if r.text is None else '{"sentiment": "%s"}' % r.text) for r in rows)
    # Another prompt is another question.
    assert replies.fetch_replies(df, "text", asks, store, prompt="other %s") == 10
    unasked = replies.with_replies(texts(spark, ["t1", "not asked"]), "text", store).orderBy("id").collect()
    assert [r.reply is None for r in unasked] == [False, True]


def test_calls_in_flight_are_bounded_over_all_tasks(spark, tmp_path):
    df = texts(spark, [f"t{i}" for i in range(200)], parts=8)
    replies.fetch_replies(df, "text", Timed(tmp_path), f"{tmp_path}/store", in_flight=20, callers=4)
    spans = [tuple(map(float, line.split())) for line in calls(tmp_path)]
    assert len(spans) == 200
    moments = sorted([(a, 1) for a, _ in spans] + [(b, -1) for _, b in spans])
    running, most = 0, 0
    for _, step in moments:
        running += step
        most = max(most, running)
    assert 5 <= most <= 20  # how far tasks overlap is the machine's matter


def test_more_tasks_than_callers_run_in_rounds(spark, tmp_path):
    """What one task reads is bounded by bytes; the calls in flight are still those of the callers."""
    df = spark.createDataFrame([(f"t{i}",) for i in range(24)], "t string")
    asked = replies.fetch_replies(
        df, "t", Timed(tmp_path), f"{tmp_path}/store", in_flight=4, callers=2, task_bytes=8
    )
    assert asked == 24
    tasks = {p.name for p in tmp_path.glob("store/run-*/caller-*")}
    assert len(tasks) > 2
    moments = [(float(t), step) for line in Path(tmp_path, "calls").read_text().splitlines()
               for t, step in zip(line.split(), (1, -1))]
    running = most = 0
    for _, step in sorted(moments):
        running += step
        most = max(most, running)
    assert len(moments) == 48 and most <= 4
    assert replies.fetch_replies(df, "t", Timed(tmp_path), f"{tmp_path}/store", callers=2, task_bytes=8) == 0


def test_a_lost_task_pays_only_for_calls_in_flight(spark, tmp_path):
    df = texts(spark, [f"t{i}" for i in range(30)])
    asks, store = Dies(tmp_path), f"{tmp_path}/store"
    options = dict(in_flight=2, callers=2, every=1)
    with pytest.raises(Exception):  # local mode gives a task one attempt
        replies.fetch_replies(df, "text", asks, store, **options)
    asked = calls(tmp_path)
    assert replies.fetch_replies(df, "text", asks, store, **options) <= 30 - sum(asked.values()) + 2
    again = {t: n for t, n in calls(tmp_path).items() if n > 1}
    assert len(calls(tmp_path)) == 30 and set(again) <= {"t7"} | set(asked)
    assert len(again) <= 2  # one call in flight per caller


def test_another_attempt_reads_what_the_lost_one_stored(tmp_path):
    writer = replies.ReplyWriter(f"{tmp_path}/caller-0", 2, 60.0)
    for i in range(5):
        writer.add((f"d{i}", "{}", None))
    # The fifth reply is not on disk yet; half-written files are not read.
    Path(tmp_path, "caller-0", "_half.parquet").write_bytes(b"PAR1")
    assert replies.ReplyWriter(f"{tmp_path}/caller-0", 2, 60.0).digests() == {"d0", "d1", "d2", "d3"}
    writer.flush()
    assert len(replies.ReplyWriter(f"{tmp_path}/caller-0", 2, 60.0).digests()) == 5


def test_errors_are_stored_and_asked_again(spark, tmp_path):
    store, asks = f"{tmp_path}/store", Busy(tmp_path)
    df = texts(spark, ["a", "b", "never"])
    options = dict(pauses=(0.0, 0.01), in_flight=4, callers=2)
    assert replies.fetch_replies(df, "text", asks, store, **options) == 3
    assert calls(tmp_path) == {"a": 2, "b": 2, "never": 2}
    found = {r.text: r for r in replies.extract_features_once(df, "text", asks, store, **options).collect()}
    assert calls(tmp_path)["never"] == 3 and calls(tmp_path)["a"] == 2
    assert found["never"].error == "ValueError: no answer"
    assert found["never"].sentiment == extraction.FALLBACK and found["a"].error is None
    assert replies.reply_store(spark, store).count() == 3


def test_edge_cases(spark, tmp_path):
    with pytest.raises(ValueError):
        replies.fetch_replies(texts(spark, ["a"]), "text", Logged(tmp_path), "x", in_flight=2, callers=3)
    store = f"{tmp_path}/store"
    empty = texts(spark, ["a"]).limit(0)
    assert replies.fetch_replies(empty, "text", Logged(tmp_path), store) == 0
    assert replies.extract_features_once(empty, "text", Logged(tmp_path), store).count() == 0
    assert replies.with_replies(texts(spark, ["a"]), "text", store).first().reply is None


def test_throttle_halves_and_recovers():
    throttle = replies.Throttle(8)
    throttle.report(retryable_error=True)
    throttle.report(retryable_error=True)
    assert throttle.limit == 2
    for _ in range(4):
        throttle.report(retryable_error=True)
    assert throttle.limit == 1
    for _ in range(60):
        throttle.report(retryable_error=False)
    assert throttle.limit == 8
    most, running, lock = 0, 0, threading.Lock()

    def call():
        nonlocal most, running
        with throttle:
            with lock:
                running += 1
                most = max(most, running)
            time.sleep(0.01)
            with lock:
                running -= 1

    throttle.limit = 3.0
    threads = [threading.Thread(target=call) for _ in range(12)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert most == 3
