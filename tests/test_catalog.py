"""Every registered query against its SQL text."""

import pytest
from compare import mismatch
from conftest import SF

from clicktide import catalog

catalog.load_all()


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_sql(spark, duck, name):
    assert mismatch(catalog.QUERIES[name](spark, SF), duck, catalog.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize(
    "name",
    ["recent_view", "hysteresis", "backlog", "slope", "running_position", "impute_median",
     "ordinal_encode", "sessionize_global", "roc_auc", "metrics_summary"],
)
def test_equals_sql_in_many_chunks(many_chunks, duck, monkeypatch, name):
    """The same with small partitions kept apart, so that every carry is used."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    monkeypatch.setitem(catalog.DEFAULTS, key, "false")
    assert mismatch(catalog.QUERIES[name](many_chunks, SF), duck, catalog.ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
