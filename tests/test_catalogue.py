"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.registry import ORACLE, QUERIES
from checks.lake import drop_scratch
from checks.verify import compare, duck


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, con, name):
    assert name in ORACLE
    assert compare(QUERIES[name](spark, small), con, ORACLE[name]) == []
    drop_scratch(spark)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["cob_dt", "hh", "mi", "twr_type", "status", "sl"] and df.count() > 0
