"""Every query against its SQL on DuckDB."""

import pytest
from compare import compare

import __spark_entry__ as entry


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sf, name):
    difference, _, _ = compare(spark, name, sf)
    assert difference is None, difference


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert "revenue_7d_avg" in df.columns and df.count() > 0
