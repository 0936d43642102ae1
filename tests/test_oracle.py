"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry
from compare import connect, spark_rows, sql_rows
from suite import ORACLE, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
#: Random seeds, and a search whose recall is measured in test_similar.py.
UNCHECKED = {"m2_cluster_sizes", "q7_recommended_locations", "s7_nearest_items"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    df = QUERIES[key](spark, FOLDER)
    got = spark_rows(df)
    assert got, "no rows: the check would be empty"
    if key in UNCHECKED:
        return
    want, names = sql_rows(con, ORACLE[key])
    assert sorted(df.columns) == names
    assert len(got) == len(want)
    assert got == want


def test_every_query_is_checked():
    assert set(QUERIES) - set(ORACLE) == UNCHECKED


def test_entry(spark):
    assert entry(spark).count() > 0
