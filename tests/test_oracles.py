"""Every registered query against its SQL twin on the smallest tables."""

import re
import sys
from concurrent.futures import ThreadPoolExecutor

import pytest

import oracle_check

sys.path.insert(0, oracle_check.ROOT)
import __spark_entry__ as entry  # noqa: E402

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def results(spark):
    """All queries, a few at a time: at this scale each one is mostly planning."""
    with ThreadPoolExecutor(6) as pool:
        yield {name: pool.submit(run, QUERIES[name], spark) for name in SQL}


def run(query, spark):
    frame = query(spark, SMALL)
    return frame.toPandas(), oracle_check.spark_kinds(frame)


@pytest.fixture(scope="module")
def con():
    return oracle_check.duck(SMALL)


def test_registry():
    assert set(SQL) <= set(QUERIES)
    # What has no SQL twin belongs to the training-data operators, which have tests of their own.
    assert all(name == "pipeline" or re.match(r"op\d+_", name) for name in set(QUERIES) - set(SQL))


def test_entry(spark):
    assert entry.entry(spark).count() == 15


@pytest.mark.parametrize("name", list(SQL))
def test_query(results, con, name):
    rows, kinds = results[name].result()
    assert oracle_check.differences(rows, con.execute(SQL[name]).df(), kinds, oracle_check.duck_kinds(con, SQL[name])) == []
