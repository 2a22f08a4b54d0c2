"""Every named query against its SQL check; those without one must give rows."""

import pytest
from oracle import compare, connect

import __spark_entry__
from millrace.plans import all_cases

CASES = all_cases()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("key", [k for k, c in CASES.items() if c.sql])
def test_agrees_with_sql(spark, con, sf, key):
    assert compare(spark, con, CASES[key], sf) is None


@pytest.mark.parametrize("key", [k for k, c in CASES.items() if not c.sql])
def test_gives_rows(spark, sf, key):
    assert CASES[key].run(spark, sf).collect()


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["countryCode", "n"]
    counts = [r["n"] for r in df.collect()]
    assert len(counts) == 5 and counts == sorted(counts, reverse=True)


def test_entry_points_agree():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
