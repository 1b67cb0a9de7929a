"""Partitioned tables whose partitions are replaced by one atomic rename.

Every write goes to a folder of its own, ``version=<name>/<key>=<value>/...``. A manifest lists which
folder or files hold each partition, and the table is what the newest manifest lists. A commit writes the next
manifest under a hidden name and renames it: before that rename readers see the old partitions, after it
the new ones, and a crash at any step leaves one of the two. Partitions that a write does not touch are
neither read nor moved. ``vacuum`` removes folders that no kept manifest names. One writer at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.sources.writers import write_parquet

_MANIFEST = re.compile(r"^(\d{10})\.json$")


class _Files:
    """Hadoop's file system below one root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._path(f"{self.root}/{name}")

    def names(self, folder: str) -> list[str]:
        where = self.at(folder)
        if not self._fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where))

    def sizes(self, path: str) -> list[tuple[str, int]]:
        """Data files at a path, which is a file itself or a folder: (path below the root, bytes)."""
        found = [(s.getPath().getName(), s.getLen()) for s in self._fs.listStatus(self.at(path))]
        if path.endswith(".parquet"):
            return [(path, found[0][1])]
        return [(f"{path}/{n}", size) for n, size in found if not n.startswith(("_", "."))]

    def read(self, name: str) -> str:
        stream = self._fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self.at(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, name: str, new: str) -> None:
        if self._fs.exists(self.at(new)) or not self._fs.rename(self.at(name), self.at(new)):
            raise OSError(f"{new} is there already, or could not be written; another writer?")

    def delete(self, name: str) -> None:
        self._fs.delete(self.at(name), True)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the manifests that are there, oldest first."""
    found = (_MANIFEST.match(n) for n in _Files(spark, root).names("_manifests"))
    return [int(m.group(1)) for m in found if m]


def _manifest(files: _Files, number: int) -> dict:
    return json.loads(files.read(f"_manifests/{number:010d}.json"))


def read_versioned(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of a version, the newest by default, with the types it was written with."""
    numbers = versions(spark, root)
    if not numbers:
        raise FileNotFoundError(f"no table at {root}")
    files = _Files(spark, root)
    manifest = _manifest(files, numbers[-1] if version is None else version)
    schema = T.StructType.fromJson(manifest["schema"])
    folders = [f"{files.root}/{path}" for paths in manifest["partitions"].values() for path in paths]
    if not folders:
        return spark.createDataFrame([], schema)
    with_version = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    reader = spark.read.schema(with_version).option("basePath", files.root)
    return reader.parquet(*folders).select(*schema.names)


def overwrite_partitions(
    df: DataFrame, root: str, by: str | Sequence[str], rebalance: bool = True, **options
) -> int:
    """Replace the partitions that ``df`` has rows of, add those that are new, leave all others.

    ``df`` may read the table itself. The columns, their types and ``by`` must stay those of the table.
    Returns the number of the version that holds the result; without rows that is the present one, or
    an empty first version. Rows are rebalanced on the keys, as in ``writers.write_partitioned``, unless
    they lie well already. ``options`` go to ``write_parquet``.
    """
    spark, keys = df.sparkSession, [by] if isinstance(by, str) else list(by)
    if "version" in df.columns:
        raise ValueError("version is the name of the folders' own key")
    files, numbers = _Files(spark, root), versions(spark, root)
    data = [f for f in df.schema.fields if f.name not in keys]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in [*data, *[df.schema[k] for k in keys]]])
    old = _manifest(files, numbers[-1]) if numbers else None
    if old and (old["schema"] != schema.jsonValue() or old["by"] != keys):
        raise ValueError("columns, types or partition keys differ from the table's")
    folder = f"version={uuid.uuid4().hex}"
    write_parquet(df.hint("rebalance", *keys) if rebalance else df, f"{files.root}/{folder}", keys, **options)
    touched = {p: [f"{folder}/{p}"] for p in _partitions(files, folder, len(keys))}
    if old and not touched:
        files.delete(folder)
        return numbers[-1]
    partitions = (old["partitions"] if old else {}) | touched
    number = numbers[-1] + 1 if numbers else 0
    _commit(files, number, {"schema": schema.jsonValue(), "by": keys, "partitions": partitions})
    return number


def _partitions(files: _Files, folder: str, depth: int) -> list[str]:
    """Partition folders below one write's folder, as relative paths."""
    paths = [""]
    for _ in range(depth):
        paths = [
            f"{p}/{n}".lstrip("/") for p in paths for n in files.names(f"{folder}/{p}") if "=" in n
        ]
    return paths


def _commit(files: _Files, number: int, manifest: dict) -> None:
    hidden = f"_manifests/.{uuid.uuid4().hex}"
    files.write(hidden, json.dumps(manifest))
    files.rename(hidden, f"_manifests/{number:010d}.json")


def file_sizes(spark: SparkSession, root: str) -> dict[str, list[tuple[str, int]]]:
    """Per partition of the newest version its files, as (path below the root, bytes)."""
    files, numbers = _Files(spark, root), versions(spark, root)
    manifest = _manifest(files, numbers[-1])
    return {p: [f for path in paths for f in files.sizes(path)] for p, paths in manifest["partitions"].items()}


def compact_files(spark: SparkSession, root: str, target_bytes: int, **options) -> int:
    """Merge files below three quarters of ``target_bytes`` into files of about that size.

    The files of a partition are packed into bins, largest first; a bin of several files becomes one
    file, written by one task. All other files are neither read nor renamed. The merged files replace the
    small ones by one commit, like every write; returns the number of the version that holds the
    result. Only the list of files is worked out on the driver.
    """
    files, numbers = _Files(spark, root), versions(spark, root)
    manifest = _manifest(files, numbers[-1])
    sizes = file_sizes(spark, root)
    bins = [
        (partition, members)
        for partition, held in sizes.items()
        for members in pack_bins([f for f in held if f[1] < 0.75 * target_bytes], target_bytes)
        if len(members) > 1
    ]
    if not bins:
        return numbers[-1]
    schema = T.StructType.fromJson(manifest["schema"])
    with_version = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    small = [f"{files.root}/{name}" for _, members in bins for name, _ in members]
    read = spark.read.schema(with_version).option("basePath", files.root).parquet(*small)
    # Joined by the path below the root; Spark gives whole paths, percent-encoded.
    names = [(name, i) for i, (_, members) in enumerate(bins) for name, _ in members]
    of_file = spark.createDataFrame(names, "_file string, _bin int")
    whole = F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B")))
    depth = len(manifest["by"]) + 2
    file = F.array_join(F.slice(F.split(whole, "/"), -depth, depth), "/")
    dealt = read.withColumn("_file", file).join(of_file, "_file").repartitionById(len(bins), F.col("_bin"))
    folder = f"version={uuid.uuid4().hex}"
    write_parquet(dealt.select(*schema.names), f"{files.root}/{folder}", manifest["by"], **options)
    gone = {name for _, members in bins for name, _ in members}
    partitions = dict(manifest["partitions"])
    for partition in {p for p, _ in bins}:
        stay = [name for name, _ in sizes[partition] if name not in gone]
        partitions[partition] = [*stay, *[name for name, _ in files.sizes(f"{folder}/{partition}")]]
    _commit(files, numbers[-1] + 1, manifest | {"partitions": partitions})
    return numbers[-1] + 1


def pack_bins(sized: list[tuple[str, int]], target: int) -> list[list[tuple[str, int]]]:
    """First fit of falling sizes: bins of at most ``target`` bytes, but for a larger single file."""
    bins: list[list] = []
    for name, size in sorted(sized, key=lambda f: (-f[1], f[0])):
        place = next((b for b in bins if b[0] + size <= target), None)
        if place is None:
            place = [0, []]
            bins.append(place)
        place[0] += size
        place[1].append((name, size))
    return [b[1] for b in bins]


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Remove what the last ``keep`` versions do not need: older manifests, replaced partitions, and
    what crashed writes left. Nothing may be writing. Returns the number of folders removed."""
    if keep < 1:
        raise ValueError("the newest version stays")
    files, numbers = _Files(spark, root), versions(spark, root)
    kept = numbers[-keep:]
    held = {path for n in kept for paths in _manifest(files, n)["partitions"].values() for path in paths}
    # Of a partition some of whose files are needed, the folder stays.
    needed = {path.rsplit("/", 1)[0] if path.endswith(".parquet") else path for path in held}
    for name in files.names("_manifests"):
        number = _MANIFEST.match(name)
        if not number or int(number.group(1)) not in kept:
            files.delete(f"_manifests/{name}")
    removed = 0
    for folder in (n for n in files.names("") if n.startswith("version=")):
        depth = max((p.count("/") for p in needed), default=1)
        here = [f"{folder}/{p}" for p in _partitions(files, folder, depth)]
        gone = [p for p in here if p not in needed]
        for path in [folder] if len(gone) == len(here) else gone:
            files.delete(path)
            removed += 1
    return removed
