"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators rely on. Partition counts stay with the cluster: AQE coalesces
#: small shuffle partitions and splits skewed ones from the real sizes.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Session windows of one user are merged before the shuffle, so a hot user sends few rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        base = str(Path(tempfile.mkdtemp(prefix="clicktide-")) / root.name)
        context.addPyFile(shutil.make_archive(base, "zip", root.parent, root.name))
        _shipped.add(context.applicationId)


def build_session(app: str = "clicktide", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def small_batches(spark: SparkSession, rows: int = 512, size: int = 8 << 20) -> None:
    """Bound the rows and bytes of the Arrow batches of texts that Python gets, for this session.

    A longer text is a batch of its own; smaller bounds that are set already stay."""
    for key, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        name = f"spark.sql.execution.arrow.{key}"
        held = spark.conf.get(name)
        before = int(held) if held.lstrip("-").isdigit() else most + 1
        if not 0 < before <= most:
            spark.conf.set(name, str(most))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    A machine-local folder is made only where neither that setting nor a checkpoint
    directory exists, which is the case in local tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="clicktide-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path inside this application's part of the shared folder."""
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/clicktide/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, when no result is read any more."""
    own = spark._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[SparkSession]:
    """A job with intermediate tables; they go when it ends, whether it succeeds or not."""
    try:
        yield spark
    finally:
        clear_scratch(spark)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Fixes values that must not change when a lost task is run again (range partition
    numbers) and keeps the result columnar, so later readers still prune columns.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
