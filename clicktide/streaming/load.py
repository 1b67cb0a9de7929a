"""Load samples that running queries write and sources read: a folder with one empty file per sample."""

from __future__ import annotations

from datetime import datetime

from pyarrow import fs
from pyspark.sql.streaming import StreamingQueryListener


class LoadBoard:
    """Samples of a load between 0 and 1, named by time, with the rule of ``series.hysteresis``.

    The folder may be any that pyarrow knows (file, hdfs, s3, gs, abfs)."""

    def __init__(self, folder: str) -> None:
        self.system, self.folder = fs.FileSystem.from_uri(folder)

    def samples(self) -> list[tuple[int, float]]:
        """(time in ms, load), oldest first."""
        found = self.system.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        parts = (f.base_name.split("-") for f in found if f.base_name.startswith("load-"))
        return sorted((int(at), float(load)) for _, at, load in parts)

    def report(self, at_ms: int, load: float, high: float = 0.85, low: float = 0.30) -> None:
        """Add a sample. One beyond a bound decides alone, so what is older is removed."""
        self.system.create_dir(self.folder, recursive=True)
        older = [s for s in self.samples() if s[0] < at_ms] if load >= high or load <= low else []
        with self.system.open_output_stream(self._path(at_ms, load)):
            pass
        for sample in older:
            self.system.delete_file(self._path(*sample))

    def _path(self, at_ms: int, load: float) -> str:
        return f"{self.folder}/load-{at_ms:015d}-{load:.6f}"

    def is_high(self, high: float = 0.85, low: float = 0.30) -> bool:
        """State after the newest sample: on at ``high``, off at ``low``, else as before; starts off."""
        for _, load in reversed(self.samples()):
            if load >= high or load <= low:
                return load >= high
        return False


class BatchLoad(StreamingQueryListener):
    """Reports the share of its time budget that each batch of a query took."""

    def __init__(self, folder: str, budget_ms: int, query_name: str | None = None) -> None:
        self.folder, self.budget_ms, self.query_name = folder, budget_ms, query_name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.numInputRows == 0 or self.query_name not in (None, progress.name):
            return
        at = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        took = progress.durationMs.get("triggerExecution", 0)
        LoadBoard(self.folder).report(int(at.timestamp() * 1000), took / self.budget_ms)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
