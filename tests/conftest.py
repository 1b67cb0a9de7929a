import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from clicktide.session import build_session, clear_scratch

    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            # Small range partitions stay apart, so that values carried between chunks matter.
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture()
def many_chunks(spark):
    """Switches off what joins small partitions; registered queries switch it on again."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield spark
    spark.conf.set(key, before)


@pytest.fixture(scope="session")
def duck():
    from compare import connect

    return connect(SF)


LOG = "user_id bigint, item_id bigint, category_id bigint, behavior_type string, timestamp bigint"


@pytest.fixture()
def log(spark):
    return lambda rows: spark.createDataFrame(rows, LOG)
