"""Partitions replaced by one rename: old or new after a crash at any step, never neither."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clicktide.sources import versioned

SCHEMA = "id int, text string, day string, kind int"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


OLD = [(1, "a", "mon", 1), (2, "b", "mon", 2), (3, "c", "tue", 1), (4, None, None, None)]
NEW = [(5, "d", "mon", 2), (6, "e", "wed", 7)]
AFTER = [OLD[0], OLD[2], OLD[3], *NEW]


@pytest.fixture()
def root(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert versioned.overwrite_partitions(table(spark, OLD), path, ["day", "kind"]) == 0
    return path


def data_files(root):
    folder = Path(root.removeprefix("file://"))
    return {str(p.relative_to(folder)) for p in folder.glob("version=*/**/*.parquet")}


def test_only_touched_partitions_are_rewritten(spark, root):
    before = data_files(root)
    assert rows(versioned.read_versioned(spark, root)) == sorted(OLD, key=str)
    assert versioned.overwrite_partitions(table(spark, NEW), root, ["day", "kind"]) == 1
    found = versioned.read_versioned(spark, root)
    assert rows(found) == sorted(AFTER, key=str) and found.dtypes == table(spark, NEW).dtypes
    assert before < data_files(root)
    assert all("day=mon/kind=2" in f or "day=wed/kind=7" in f for f in data_files(root) - before)
    assert rows(versioned.read_versioned(spark, root, 0)) == sorted(OLD, key=str)
    # The partition filter reaches the scan.
    plan = found.where("day = 'wed'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_a_table_may_be_rewritten_from_itself(spark, root):
    doubled = versioned.read_versioned(spark, root).withColumn("id", F.col("id") * 2)
    versioned.overwrite_partitions(doubled, root, ["day", "kind"])
    assert rows(versioned.read_versioned(spark, root)) == sorted([(i * 2, *r) for i, *r in OLD], key=str)


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["write", "half a manifest", "rename", "after"])
def test_a_crash_at_any_step_leaves_old_or_new(spark, root, monkeypatch, step):
    def stop(*_):
        raise Stop

    if step == "write":
        def half(df, path, by, **_):
            df.where("id = 5").write.partitionBy(*by).parquet(path)
            raise Stop

        monkeypatch.setattr(versioned, "write_parquet", half)
    elif step == "half a manifest":
        real = versioned._Files.write
        monkeypatch.setattr(versioned._Files, "write", lambda f, n, t: (real(f, n, t[:20]), stop()))
    elif step == "rename":
        monkeypatch.setattr(versioned._Files, "rename", stop)
    else:
        commit = versioned._commit
        monkeypatch.setattr(versioned, "_commit", lambda *a: (commit(*a), stop()))
    with pytest.raises(Stop):
        versioned.overwrite_partitions(table(spark, NEW), root, ["day", "kind"])
    monkeypatch.undo()
    done = step == "after"
    assert rows(versioned.read_versioned(spark, root)) == sorted(AFTER if done else OLD, key=str)
    # The next writer goes on, and vacuum removes what the crash left.
    versioned.overwrite_partitions(table(spark, NEW), root, ["day", "kind"])
    assert rows(versioned.read_versioned(spark, root)) == sorted(AFTER, key=str)
    versioned.vacuum(spark, root)
    assert rows(versioned.read_versioned(spark, root)) == sorted(AFTER, key=str)
    assert len(versioned.versions(spark, root)) == 1
    names = {p.name for p in Path(root.removeprefix("file://"), "_manifests").iterdir()}
    assert len({n for n in names if not n.endswith(".crc")}) == 1


def test_vacuum_keeps_what_kept_versions_need(spark, root):
    for _ in range(3):
        versioned.overwrite_partitions(table(spark, NEW), root, ["day", "kind"])
    assert versioned.vacuum(spark, root, keep=2) > 0
    assert versioned.versions(spark, root) == [2, 3]
    for number in (2, 3):
        assert rows(versioned.read_versioned(spark, root, number)) == sorted(AFTER, key=str)
    assert versioned.vacuum(spark, root, keep=2) == 0
    with pytest.raises(ValueError):
        versioned.vacuum(spark, root, keep=0)


def test_two_writers_do_not_undo_each_other(spark, root):
    files = versioned._Files(spark, root)
    manifest = versioned._manifest(files, 0)
    versioned._commit(files, 1, manifest)
    with pytest.raises(OSError):
        versioned._commit(files, 1, manifest)


def test_edge_cases(spark, root, tmp_path):
    assert versioned.overwrite_partitions(table(spark, []), root, ["day", "kind"]) == 0
    assert rows(versioned.read_versioned(spark, root)) == sorted(OLD, key=str)
    empty = f"{tmp_path}/empty"
    assert versioned.overwrite_partitions(table(spark, []), empty, "day") == 0
    assert versioned.read_versioned(spark, empty).count() == 0
    with pytest.raises(ValueError):
        versioned.overwrite_partitions(table(spark, NEW), root, "day")
    with pytest.raises(ValueError):
        versioned.overwrite_partitions(table(spark, NEW).withColumn("more", F.lit(1)), root, ["day", "kind"])
    with pytest.raises(FileNotFoundError):
        versioned.read_versioned(spark, f"{tmp_path}/none")
    odd = table(spark, [(1, "x", "a=b/c d%", 1), (2, "y", "ü", 1)])
    versioned.overwrite_partitions(odd, f"{tmp_path}/odd", "day")
    assert rows(versioned.read_versioned(spark, f"{tmp_path}/odd").select("id", "text", "day", "kind")) == rows(odd)


def test_only_small_files_are_merged(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    schema = "id bigint, pad string, day string"
    pad = F.sha2(F.concat(F.col("id").cast("string"), F.lit("x")), 512)
    for day, low, high, parts in (("a b", 0, 4000, 1), ("c d+e%/f", 4000, 4600, 6), ("d", 4600, 4700, 1)):
        rows = spark.range(low, high).select("id", pad.alias("pad"), F.lit(day).alias("day"))
        versioned.overwrite_partitions(rows.repartition(parts), root, "day", rebalance=False)
    before = versioned.file_sizes(spark, root)
    (small,) = (p for p in before if p.startswith("day=c"))
    assert len(before[small]) >= 2
    target = max(size for held in before.values() for _, size in held)
    expected = rows_of(spark, root)
    number = versioned.compact_files(spark, root, target)
    after = versioned.file_sizes(spark, root)
    assert number == 3 and rows_of(spark, root) == expected
    assert after["day=a b"] == before["day=a b"] and after["day=d"] == before["day=d"]
    assert len(after[small]) == 1 and after[small][0][1] <= 1.1 * target
    assert versioned.compact_files(spark, root, target) == 3, "nothing is left to merge"
    # An overwrite and a vacuum go on from lists of files.
    assert versioned.vacuum(spark, root) > 0
    assert rows_of(spark, root) == expected
    more = spark.createDataFrame([(1, "p", "c d+e%/f")], schema)
    versioned.overwrite_partitions(more, root, "day")
    versioned.vacuum(spark, root)
    assert versioned.read_versioned(spark, root).where("day = 'c d+e%/f'").count() == 1
    assert versioned.read_versioned(spark, root).count() == 4101


def rows_of(spark, root):
    return sorted(map(tuple, versioned.read_versioned(spark, root).collect()))


def test_bins():
    sized = [(f"f{i}", s) for i, s in enumerate([5, 9, 3, 3, 2, 8, 30])]
    bins = versioned.pack_bins(sized, 10)
    assert sorted(n for b in bins for n, _ in b) == sorted(n for n, _ in sized)
    assert all(sum(s for _, s in b) <= 10 or len(b) == 1 for b in bins) and len(bins) <= 5
    assert versioned.pack_bins([], 10) == []
