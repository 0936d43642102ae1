"""Keys at given places, found without a sort of all keys."""

from __future__ import annotations

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from placemill import operators as op
from placemill.operators import rowindex


def ordered(df, order_by):
    return [tuple(row) for row in df.select(*order_by).orderBy(*order_by).collect()]


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    """Many equal and null first values, in no order, in several files."""
    path = str(tmp_path_factory.mktemp("keys") / "rows")
    a = F.pmod(F.xxhash64("id"), F.lit(400))
    df = spark.range(0, 30_000, 1, 8).select(
        F.when(a > 150, a).alias("a"), F.col("id").cast("string").alias("b"), "id"
    )
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(("sort", "sample", "cuts", "windows"), [(20_000, 20_000, 256, 16), (300, 500, 64, 2), (50, 200, 16, 16)])
def test_keys_at_places(rows, monkeypatch, sort, sample, cuts, windows):
    monkeypatch.setattr(rowindex, "SORT_KEYS", sort)
    monkeypatch.setattr(rowindex, "SAMPLE_KEYS", sample)
    monkeypatch.setattr(rowindex, "CUTS", cuts)
    monkeypatch.setattr(rowindex, "_WINDOWS", windows)
    places = [0, 1, 2, 9_999, 11_000, 11_001, 20_000, 29_999, 30_000, -1]
    want = ordered(rows, ["a", "b"])
    got = op.keys_at_places(rows, ["a", "b"], places)
    assert got == {place: want[place] for place in places if 0 <= place < 30_000}


def test_a_key_of_most_rows_ends_the_search(spark, monkeypatch):
    monkeypatch.setattr(rowindex, "SORT_KEYS", 10)
    monkeypatch.setattr(rowindex, "SAMPLE_KEYS", 50)
    df = spark.range(10_000).select(F.when(F.col("id") % 1000 > 0, 7).otherwise(F.col("id")).alias("k"))
    want = ordered(df, ["k"])
    got = op.keys_at_places(df, ["k"], [0, 1, 2, 5_000, 9_998, 9_999])
    assert got == {place: want[place] for place in got} and len(got) == 6
    with pytest.raises(ValueError, match="not unique"):
        op.row_range(df, ["k"], 10, 20)


def test_kinds_of_keys(spark, monkeypatch):
    monkeypatch.setattr(rowindex, "SORT_KEYS", 2)
    monkeypatch.setattr(rowindex, "SAMPLE_KEYS", 4)
    at = datetime.datetime(2020, 1, 1, 0, 0, 0, 123456)
    data = [
        (float("nan"), decimal.Decimal("1.10"), datetime.date(2020, 1, 1), at, b"\x00\xff", "é"),
        (float("inf"), decimal.Decimal("1.20"), datetime.date(2020, 1, 2), at, b"\x01", '"\\'),
        (0.1, decimal.Decimal("-3.00"), None, at + datetime.timedelta(microseconds=1), b"", "a\nb"),
        (None, None, datetime.date(1, 1, 1), None, None, None),
        (-0.5, decimal.Decimal("7.77"), datetime.date(9999, 12, 31), at, b"z", ""),
    ] + [(float(n), decimal.Decimal(n), None, at + datetime.timedelta(days=n), bytes([n]), str(n)) for n in range(2, 30)]
    df = spark.createDataFrame(data, "a double, b decimal(9,2), c date, d timestamp, e binary, f string")
    for name in "abcdef":
        keys = [name, "f"] if name in "cd" else [name]
        want = ordered(df, keys)
        got = op.keys_at_places(df, keys, range(33))
        assert [repr(got[at]) for at in range(33)] == [repr(key) for key in want], name


def test_pages(rows):
    pages = [page.select("id") for page in op.row_pages(rows, ["a", "b"], 7_000)]
    assert [page.count() for page in pages] == [7_000] * 4 + [2_000]
    want = [row.id for row in rows.orderBy("a", "b").select("id").collect()]
    assert {row.id for row in pages[1].collect()} == set(want[7_000:14_000])
    assert list(op.row_pages(rows.limit(0), ["a", "b"], 5)) == []


def test_the_range_reaches_the_scan_and_nothing_is_checkpointed(spark, rows):
    items = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    page = op.row_range(items, ["o_totalprice", "o_orderkey"], 100, 200)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert page.count() == 100
    assert "GreaterThanOrEqual(o_totalprice" in plan and "LessThanOrEqual(o_totalprice" in plan
    assert "Sort" not in plan and "Exchange" not in plan and "ExistingRDD" not in plan
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before


def test_split_with_many_boundaries(rows):
    parts = op.split_contiguous(rows, 100, ["a", "b"]).groupBy("part").count().collect()
    assert sorted((r.part, r["count"]) for r in parts) == [(n, 300) for n in range(100)]
