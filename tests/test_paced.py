"""A stream source whose batches follow the load while the query runs."""

import json

import pytest

from clicktide.plans.scoring import start_scoring
from clicktide.session import scratch
from clicktide.sources import paced
from clicktide.streaming import run
from clicktide.streaming.load import BatchLoad, LoadBoard


def write_files(folder, numbers):
    folder.mkdir(exist_ok=True)
    for n in numbers:
        (folder / f"f{n:04d}").write_text(f"{n} a\n{n} b\r\n\n{n} ü")


def drain(spark, tmp_path, after=None):
    """Run until all files are read; the files of each batch, in order."""
    seen = []

    def shape(batch):
        files = sorted({int(r.value.split()[0]) for r in batch.collect() if r.value})
        seen.append(files)
        if after:
            after(len(seen))
        return batch

    stream = paced.read_paced_lines(
        spark, f"{tmp_path}/in", f"{tmp_path}/position", 6, f"file://{tmp_path}/board"
    )
    query = run.start(
        stream, f"{tmp_path}/out", f"{tmp_path}/state", processing_time="50 milliseconds", shape=shape
    )
    query.processAllAvailable()
    query.stop()
    return seen


def test_batches_shrink_while_hot_and_grow_back_in_one_run(spark, tmp_path):
    write_files(tmp_path / "in", range(24))
    board = LoadBoard(f"{tmp_path}/board")
    samples = {1: 0.9, 2: 0.5, 4: 0.2}
    sizes = drain(spark, tmp_path, lambda n: n in samples and board.report(n, samples[n]))
    assert [len(s) for s in sizes if s] == [6, 2, 2, 2, 6, 6]
    assert [f for s in sizes for f in s] == list(range(24))
    rows = run.read_batches(spark, f"{tmp_path}/out").collect()
    assert len(rows) == 24 * 4 and {r.value for r in rows if r.value.startswith("3 ")} == {"3 a", "3 b", "3 ü"}
    # A restart goes on behind the last batch; hidden and half-written files are not read.
    write_files(tmp_path / "in", range(24, 29))
    (tmp_path / "in" / "_f9999").write_text("999 x")
    again = drain(spark, tmp_path)
    assert [f for s in again for f in s] == list(range(24, 29))
    assert run.read_batches(spark, f"{tmp_path}/out").count() == 29 * 4


def test_a_restarted_reader_never_goes_back(tmp_path):
    write_files(tmp_path / "in", range(9))
    options = {"path": f"{tmp_path}/in", "state": f"{tmp_path}/position", "files": "4"}
    reader = paced.PacedReader(options)
    assert reader.latestOffset() == {"file": "f0003"} and reader.latestOffset() == {"file": "f0007"}
    reader = paced.PacedReader(options)
    assert reader.latestOffset() == {"file": "f0008"} == reader.latestOffset()
    parts = reader.partitions({"file": "f0003"}, {"file": "f0008"})
    assert [p.value for p in parts] == [f"f{n:04d}" for n in range(4, 9)]
    assert reader.partitions({"file": "f0008"}, {"file": "f0008"}) == []
    with pytest.raises(ValueError):
        paced.PacedReader(options | {"files": "0"})
    empty = paced.PacedReader({"path": f"{tmp_path}/none", "state": f"{tmp_path}/p2"})
    assert empty.latestOffset() == empty.initialOffset()


def test_load_board(tmp_path):
    board = LoadBoard(f"file://{tmp_path}/board")
    states = []
    for at, load in enumerate([0.5, 0.85, 0.6, 0.31, 0.30, 0.84, 0.9]):
        board.report(at, load)
        states.append(board.is_high())
    assert states == [False, True, True, True, False, False, True]
    assert board.samples() == [(6, 0.9)]  # what no longer decides is removed
    assert not LoadBoard(f"{tmp_path}/new").is_high()


def test_batches_report_their_load(spark, tmp_path):
    write_files(tmp_path / "in", range(3))
    listener = BatchLoad(f"{tmp_path}/board", budget_ms=1)
    spark.streams.addListener(listener)
    try:
        drain(spark, tmp_path)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert LoadBoard(f"{tmp_path}/board").is_high()


def test_scoring_with_a_board(spark, tmp_path):
    good = {"event_time": "2024-01-06 13:00:00.5", "user_id": 1, "item_id": 7, "behavior_type": "cart"}
    (tmp_path / "in").mkdir()
    for n in range(4):
        (tmp_path / "in" / f"f{n}").write_text(json.dumps(good) + "\nbroken\n")
    LoadBoard(f"{tmp_path}/board").report(1, 0.9)
    out = scratch(spark, "paced-scoring")
    with pytest.raises(ValueError):
        start_scoring(spark, f"{tmp_path}/in", out, f"{tmp_path}/state", load_board=f"{tmp_path}/board")
    query = start_scoring(
        spark, f"{tmp_path}/in", out, f"{tmp_path}/state", files_per_batch=6,
        processing_time="50 milliseconds", load_board=f"{tmp_path}/board",
    )
    query.processAllAvailable()
    query.stop()
    found = run.read_batches(spark, out)
    assert {tuple(r) for r in found.groupBy("route").count().collect()} == {("scored", 4), ("dead", 4)}
    assert found.select("batch_id").distinct().count() == 2
