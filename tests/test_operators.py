"""Operators on hand-made rows, with the traps each one has."""

from __future__ import annotations

from datetime import datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from placemill import operators as op
from placemill import schemas as S
from placemill.functions import from_millis, parse_timestamp, split_list, strip_ws

FAILURE = (PySparkException, Py4JJavaError)


def values(df, *cols):
    return sorted((tuple(row) for row in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def states(spark):
    rows = [
        ("Alabama ", "AL", " 1"),
        ("Alaska ", "AK", " 2"),
        ("Florida ", "FL", " 3"),
        ("Texas ", "TX", " 4"),
    ]
    return spark.createDataFrame(rows, S.STATE_DIM).coalesce(1)


def addresses(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "address string")


@pytest.mark.parametrize(
    ("address", "exact", "containing"),
    [
        ("Joe, 1 Main St, Tampa, FL 33601", ("Tampa", "Florida"), ("Tampa", "Florida")),
        ("1 Main St, Tampa,FL 33601", None, None),
        ("12 Long Road, Somewhere,", None, ("Somewhere", "Alabama")),
        ("12 Long Road, Somewhere, A", None, ("Somewhere", "Alabama")),
        ("12 Long Road, Somewhere, K", None, ("Somewhere", "Alaska")),
        ("12 Long Road, Some.where, (New) Place", None, None),
        ("12 Long Road, Some.where, A. Place", None, None),
        ("a, b, FL 1", None, None),
        ("12 Long Road Somewhere, FL 33601", None, None),
        ("x, \tMiami , FL 33601", ("Miami", "Florida"), ("Miami", "Florida")),
        ("x, Miami, ZZ 33601", None, None),
        (None, None, None),
    ],
)
def test_addresses(spark, states, address, exact, containing):
    none = ("SIN DATO", "SIN DATO")
    df = addresses(spark, address)
    assert values(op.parse_address(df, states), "city", "state") == [exact or none]
    by_piece = op.parse_address(df, states, mode="contains")
    assert values(by_piece, "city", "state") == [containing or none]


def test_address_mode_is_checked(spark, states):
    with pytest.raises(ValueError, match="mode"):
        op.parse_address(addresses(spark, "x"), states, mode="regex")


def test_state_names(spark, states):
    df = spark.createDataFrame([(1, "FL"), (2, "QC"), (3, None)], "id long, state string")
    named = op.attach_state(df, states, "state")
    assert values(named, "id", "estado") == [(1, "Florida"), (2, None), (3, None)]


def test_category_is_a_whole_item(spark):
    rows = [(1, ["Restaurant"]), (2, ["Thai Restaurant"]), (3, None), (4, ["Bar", "Restaurant"])]
    df = spark.createDataFrame(rows, "id long, category array<string>")
    assert values(op.has_category(df, "category", "Restaurant"), "id") == [(1,), (4,)]


def test_tokens_are_not_trimmed(spark):
    rows = [(1, "Restaurants, Burgers"), (2, "Burgers, Restaurants"), (3, "Burgers,Restaurants")]
    df = spark.createDataFrame([*rows, (4, None), (5, "")], "id long, categories string")
    assert values(op.has_token(df, "categories", "Restaurants"), "id") == [(1,), (3,)]
    trimmed = op.has_token(df, "categories", "Restaurants", trim_tokens=True)
    assert values(trimmed, "id") == [(1,), (2,), (3,)]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_years(spark, kind):
    texts = [
        "2009-12-31 23:59:59.999",
        "2010-01-01 00:00:00",
        "2021-12-31 23:59:59.999",
        "2022-01-01 00:00:00",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    df = df.withColumn("date", F.col("text").cast(kind))
    assert values(op.year_between(df, "date"), "id") == [(1,), (2,)]


def test_sentinel_keeps_nulls(spark):
    df = spark.createDataFrame([("SIN DATO",), (None,), ("-58.4",)], "LONGITUD string")
    kept = op.not_sentinel(df, "LONGITUD", "SIN DATO")
    assert values(kept, "LONGITUD") == [("-58.4",), (None,)]
    assert values(op.exclude_values(df, "LONGITUD", ["-58.4"]), "LONGITUD") == [
        ("SIN DATO",),
        (None,),
    ]
    assert op.exclude_values(df, "LONGITUD", []).count() == 3


def test_states_filter_drops_null(spark):
    df = spark.createDataFrame([("Texas",), ("Utah",), (None,)], "state string")
    assert values(op.in_states(df, "state"), "state") == [("Texas",)]


def test_first_per_key(spark):
    rows = [("a", 1, "f1", 1), ("a", 3, "f1", 3), ("a", 2, "f2", 1), (None, 9, "f1", 4)]
    rows.append((None, 8, "f1", 5))
    df = spark.createDataFrame(rows, "k string, v int, source_file string, source_seq int")
    order = ["source_file", "source_seq"]
    everywhere = op.dedupe_first(df, ["k"], order, scope="global")
    assert values(everywhere, "k", "v") == [("a", 1), (None, 9)]
    per_file = op.dedupe_first(df, ["k"], order, scope="file")
    assert values(per_file, "k", "v") == [("a", 1), ("a", 2), (None, 9)]
    with pytest.raises(ValueError, match="scope"):
        op.dedupe_first(df, ["k"], order, scope="folder")


def test_explode(spark):
    rows = [(1, []), (2, None), (3, ["a", None])]
    df = spark.createDataFrame(rows, "id long, items array<string>")
    inner = op.explode_option(df, "id", "items", "item")
    assert values(inner, "id", "item") == [(3, "a"), (3, None)]
    outer = op.explode_option(df, "id", "items", "item", outer=True)
    assert values(outer, "id", "item") == [(1, None), (2, None), (3, "a"), (3, None)]


def test_map_columns(spark):
    rows = [(1, {"a": "x", "b": None}), (2, None), (3, {})]
    df = spark.createDataFrame(rows, "id long, m map<string,string>")
    assert values(op.map_columns(df, "m", ["a", "b"], "None"), "id", "a", "b") == [
        (1, "x", "None"),
        (2, "None", "None"),
        (3, "None", "None"),
    ]
    assert values(op.map_columns(df, "m", ["z"]), "z") == [(None,)] * 3


def test_strict_drop_and_duplicate_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert op.drop_strict(df, "a").columns == ["b", "c"]
    with pytest.raises(ValueError, match="z"):
        op.drop_strict(df, "a", "z")
    twice = df.toDF("a", "b", "a")
    assert values(op.dedupe_column_names(twice), "a", "b") == [(1, 2)]


def test_a_repeated_code_doubles_no_address(spark):
    states = spark.createDataFrame(
        [("Texas", "TX"), ("Tejas", "TX")], "nombre_largo string, nombre_corto string"
    )
    places = spark.createDataFrame([("Shop, 1 Road, Austin, TX 78701",)], "address string")
    assert values(op.parse_address(places, states), "city", "state") == [("Austin", "Tejas")]


def test_only_new(spark):
    schema = "id string, stars int, text string"
    target = spark.createDataFrame([("a", 1, "old"), ("n", None, "old")] * 3, schema)
    rows = [("a", 1, "old"), ("a", 1, "new"), ("a", 2, "old"), ("n", None, "old")]
    batch = spark.createDataFrame([*rows, ("c", 5, "x"), ("c", 5, "x")], schema)
    want = [("a", 2, "old"), ("c", 5, "x"), ("c", 5, "x"), ("n", None, "old")]
    assert values(op.only_new(batch, target), "id", "stars", "text") == want
    assert values(op.only_new(batch, target, prune_on="stars"), "id", "stars", "text") == want


def test_restrict_does_not_multiply(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert values(op.restrict_to(df, keys, "k"), "k", "v") == [("a", 1)]


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("a", 3), (None, 4)], "k string, v int")
    assert [tuple(r) for r in op.value_counts(df, "k").collect()] == [("a", 2), ("b", 1)]
    assert op.null_counts(df).first().asDict() == {"k": 1, "v": 1}
    assert values(op.profile(df), "column", "dtype", "non_null", "nulls", "row_count") == [
        ("k", "string", 3, 1, 4),
        ("v", "int", 3, 1, 4),
    ]


def test_fill_nulls_needs_the_column(spark):
    df = spark.createDataFrame([(None, "b")], "price string, other string")
    assert values(op.fill_nulls(df, {"price": "SIN DATO"}), "price") == [("SIN DATO",)]
    with pytest.raises(FAILURE):
        op.fill_nulls(df, {"absent": "x"}).collect()


def test_expressions(spark):
    row = spark.range(1).select(
        strip_ws(F.lit("\t　 a b  \r\n")).alias("strip"),
        split_list(F.lit("")).alias("empty"),
        split_list(F.lit("a,,b,")).alias("parts"),
        from_millis(F.lit(1262304000123)).alias("at"),
        from_millis(F.lit(-1)).alias("before"),
        parse_timestamp(F.lit("2012-02-29 10:11:12")).alias("parsed"),
    ).first()
    assert row.strip == "a b"
    assert row.empty == [""]
    assert row.parts == ["a", "", "b", ""]
    assert row.at == datetime(2010, 1, 1, 0, 0, 0, 123000)
    assert row.before == datetime(1969, 12, 31, 23, 59, 59, 999000)
    assert row.parsed == datetime(2012, 2, 29, 10, 11, 12)
    with pytest.raises(FAILURE):
        spark.range(1).select(parse_timestamp(F.lit("no date"))).collect()


# ---- positions -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def shuffled(spark):
    """25 rows in random order; the order key is (g, id), with a null group."""
    rows = [(None if n < 5 else n // 10, n) for n in range(25)]
    df = spark.createDataFrame(rows, "g int, id long")
    return df.repartition(7, F.hash("id"))


def test_row_index_is_dense(shuffled):
    got = op.with_row_index(shuffled, ["g", "id"]).collect()
    assert sorted((r.idx, r.id) for r in got) == [(n, n) for n in range(25)]


@pytest.mark.parametrize(
    ("n", "mode", "sizes"),
    [
        (10, "floor", [2] * 9 + [7]),
        (10, "ceil", [3] * 8 + [1]),
        (1, "floor", [25]),
        (25, "floor", [1] * 25),
        (30, "ceil", [1] * 25),
        (4, "ceil", [7, 7, 7, 4]),
    ],
)
def test_parts(shuffled, n, mode, sizes):
    rows = op.split_contiguous(shuffled, n, ["g", "id"], mode=mode).collect()
    rows.sort(key=lambda r: r.id)
    assert [r.part for r in rows] == sorted(r.part for r in rows)
    assert [sum(r.part == p for r in rows) for p in range(len(sizes))] == sizes


def test_fewer_rows_than_parts(spark):
    parts = op.split_contiguous(spark.range(7), 10, ["id"])
    assert {r.part for r in parts.collect()} == {9}
    assert op.split_contiguous(spark.range(0), 3, ["id"]).count() == 0


def test_row_range(shuffled):
    for start, stop in [(0, 5), (3, 9), (20, 99), (0, 99), (30, 40), (4, 4)]:
        got = op.row_range(shuffled, ["g", "id"], start, stop)
        assert sorted(r.id for r in got.collect()) == list(range(25))[start:stop]


def test_order_must_be_unique_at_boundaries(spark):
    df = spark.createDataFrame([(1,)] * 10, "k int")
    with pytest.raises(ValueError, match="not unique"):
        op.split_contiguous(df, 2, ["k"])


@pytest.mark.parametrize("bad", [(0, "floor"), (3, "round")])
def test_part_arguments(spark, bad):
    with pytest.raises(ValueError, match="need n"):
        op.split_contiguous(spark.range(3), bad[0], ["id"], mode=bad[1])
