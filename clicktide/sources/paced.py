"""A stream of text lines whose intake follows the load while the query runs.

Spark's file source fixes its bound when a query starts. This source decides for every batch: while the
load board says that the load is high, a batch takes a third of the files it takes else. Offsets are
file names, so a batch is the files between two names: the same after a restart, without a log of files.
New files must sort behind the older ones, as names that begin with a time do.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from clicktide.streaming.load import LoadBoard

_BATCH_LINES = 10_000


def _data_files(system: fs.FileSystem, folder: str) -> list[str]:
    """Names of the whole files of a folder, in order; none if it does not exist yet."""
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    names = (f.base_name for f in found if f.type == fs.FileType.File)
    return sorted(n for n in names if not n.startswith(("_", ".")))


class FilePart(InputPartition):
    def __init__(self, name: str) -> None:
        super().__init__(name)


class PacedReader(DataSourceStreamReader):
    """Plans batches on the driver; ``read`` runs in tasks, one per file."""

    def __init__(self, options: dict) -> None:
        self.folder, self.state = options["path"], options["state"]
        self.limit = int(options.get("files", 100))
        self.slowdown = int(options.get("slowdown", 3))
        self.board = options.get("board")
        self.high, self.low = float(options.get("high", 0.85)), float(options.get("low", 0.30))
        if self.limit < 1 or self.slowdown < 1:
            raise ValueError("files and slowdown are at least 1")
        self.last: str | None = None

    def initialOffset(self) -> dict:
        return {"file": ""}

    def latestOffset(self) -> dict:
        """The last file of the next batch. Spark asks once per batch and does not say where it
        stands, so the last answer is kept in the state folder before it is given: a restarted
        query then never gets an earlier offset than the one it has processed."""
        if self.last is None:
            self.last = self._kept()
        system, folder = fs.FileSystem.from_uri(self.folder)
        waiting = [n for n in _data_files(system, folder) if n > self.last]
        if waiting:
            self.last = waiting[: self._bound()][-1]
            self._keep(self.last)
        return {"file": self.last}

    def _bound(self) -> int:
        hot = bool(self.board) and LoadBoard(self.board).is_high(self.high, self.low)
        return max(1, self.limit // self.slowdown) if hot else self.limit

    def _kept(self) -> str:
        system, folder = fs.FileSystem.from_uri(self.state)
        names = _data_files(system, folder)
        return names[-1].removeprefix("at-") if names else ""

    def _keep(self, name: str) -> None:
        """The state is the name of an empty file; names only grow, so the greatest counts."""
        system, folder = fs.FileSystem.from_uri(self.state)
        system.create_dir(folder, recursive=True)
        old = _data_files(system, folder)
        with system.open_output_stream(f"{folder}/at-{name}"):
            pass
        for other in old:
            if other != f"at-{name}":
                system.delete_file(f"{folder}/{other}")

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        system, folder = fs.FileSystem.from_uri(self.folder)
        return [FilePart(n) for n in _data_files(system, folder) if start["file"] < n <= end["file"]]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(self.folder)
        with system.open_input_stream(f"{folder}/{partition.value}") as raw:
            lines = (line.rstrip("\n") for line in io.TextIOWrapper(raw, encoding="utf-8"))
            while part := list(islice(lines, _BATCH_LINES)):
                yield pa.RecordBatch.from_pydict({"value": part})


class PacedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paced_lines"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> PacedReader:
        return PacedReader(self.options)


def read_paced_lines(
    spark: SparkSession,
    path: str,
    state: str,
    files_per_batch: int,
    board: str | None = None,
    slowdown: int = 3,
    high: float = 0.85,
    low: float = 0.30,
) -> DataFrame:
    """Lines of the files of ``path`` in ``value``, ``files_per_batch`` files at a time, or that many
    through ``slowdown`` while the load on ``board`` is high.

    ``state`` is a folder of this query's own, kept like its checkpoint. Start the query with a
    processing-time trigger: with ``availableNow`` Spark asks this kind of source for one batch only.
    """
    spark.dataSource.register(PacedLines)
    options = {"path": path, "state": state, "files": files_per_batch, "slowdown": slowdown, "high": high, "low": low}
    if board:
        options["board"] = board
    reader = spark.readStream.format("paced_lines")
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader.load()
