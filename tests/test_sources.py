"""Readers, inventories and sinks on hand-made files."""

from __future__ import annotations

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from placemill import schemas as S
from placemill import sinks, sources
from placemill.operators import dedupe_first, split_contiguous

FAILURE = (PySparkException, Py4JJavaError)


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_semicolon_file_with_bom_keeps_trailing_blanks(spark, tmp_path):
    text = "nombre_largo;nombre_corto;codigos\nAlabama ;AL; 35004 a 36925\nWyoming ;WY; 82001.\n"
    path = put(tmp_path / "states.csv", b"\xef\xbb\xbf" + text.encode())
    rows = sources.read_delimited(spark, path, S.STATE_DIM, sep=";").collect()
    assert rows[0].asDict() == {
        "nombre_largo": "Alabama ",
        "nombre_corto": "AL",
        "codigos": " 35004 a 36925",
    }
    assert len(rows) == 2


def test_delimited_header_must_match(spark, tmp_path):
    path = put(tmp_path / "x.csv", "city,state\na,b\n")
    with pytest.raises(FAILURE):
        sources.read_delimited(spark, path, S.table(state=S.STR, city=S.STR)).collect()


def test_quoted_text_with_line_breaks(spark, tmp_path):
    schema = S.table(id=S.LONG, text=S.STR)
    rows = spark.createDataFrame([(1, 'say "hi",\nthen go'), (2, None)], schema)
    path = sinks.write_csv(rows, str(tmp_path / "out"))
    read = sources.read_delimited(spark, path, schema, multiline=True)
    assert sorted(map(tuple, read.collect())) == [(1, 'say "hi",\nthen go'), (2, None)]


def test_long_ids_keep_their_digits(spark, tmp_path):
    path = put(
        tmp_path / "r.json",
        '{"user_id": "108472640021823464212"}\n{"user_id": 108472640021823464212}\n',
    )
    rows = sources.read_json(spark, path, S.table(user_id=S.STR)).collect()
    assert {row.user_id for row in rows} == {"108472640021823464212"}


def test_malformed_json_is_an_error_unless_permitted(spark, tmp_path):
    path = put(tmp_path / "bad.json", '{"a": 1}\n{"a": \n')
    schema = S.table(a=S.LONG)
    with pytest.raises(FAILURE):
        sources.read_json(spark, path, schema).collect()
    rows = sources.read_json(spark, path, schema, mode="PERMISSIVE").collect()
    assert sorted(str(row.a) for row in rows) == ["1", "None"]


def test_json_array_files_are_valid_json(spark, tmp_path):
    schema = S.table(id=S.LONG, text=S.STR)
    rows = spark.createDataFrame([(n, f'line "{n}"\n') for n in range(25)], schema)
    path = tmp_path / "arrays"
    sinks.write_json_arrays(rows.repartition(4), str(path))
    found = [json.loads(part.read_text()) for part in path.glob("part-*")]
    assert sorted(row["id"] for part in found for row in part) == list(range(25))
    read = sources.read_json(spark, str(path), schema, array=True)
    assert sorted(map(tuple, read.collect())) == [(n, f'line "{n}"\n') for n in range(25)]


def test_json_array_of_no_rows(spark, tmp_path):
    path, schema = str(tmp_path / "none"), S.table(id=S.LONG)
    sinks.write_json_arrays(spark.range(9).filter("id > 10").repartition(2), path)
    assert sources.read_json(spark, path, schema, array=True).count() == 0


def test_many_files_keep_file_order(spark, tmp_path):
    """The first row in file order survives, per file or over all files."""
    for name, values in {"a/1.json": [3, 1, 2], "b/2.json": [9, 8]}.items():
        lines = "".join(json.dumps({"k": "x", "v": v}) + "\n" for v in values)
        put(tmp_path / "in" / name, lines)
    put(tmp_path / "in" / "a" / "skip.txt", "not json")
    schema = S.table(k=S.STR, v=S.LONG)
    read = sources.read_many(spark, str(tmp_path / "in"), "json", schema, glob="*.json")
    assert read.count() == 5
    assert sorted(r.v for r in dedupe_first(read, ["k"]).collect()) == [3, 9]
    assert [r.v for r in dedupe_first(read, ["k"], scope="global").collect()] == [3]


def test_file_order_holds_over_many_splits(spark, tmp_path):
    lines = "".join(json.dumps({"k": n % 100, "v": n}) + "\n" for n in range(20_000))
    put(tmp_path / "big" / "one.json", lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        schema = S.table(k=S.LONG, v=S.LONG)
        read = sources.read_many(spark, str(tmp_path / "big"), "json", schema, glob="*.json")
        assert read.rdd.getNumPartitions() > 5
        assert sorted(r.v for r in dedupe_first(read, ["k"]).collect()) == list(range(100))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_listing_and_parent_globs(spark, tmp_path):
    for name in ("a/1.csv", "a/2.csv", "b/3.csv", "b/4.txt"):
        put(tmp_path / name, "x")
    folder = str(tmp_path)
    assert sources.list_files(spark, folder, ".csv").count() == 3
    files = sources.list_files(spark, folder)
    assert files.columns == ["path", "length", "modificationTime"]
    globs = [r.glob for r in sources.parent_globs(files).collect()]
    assert sorted(g.split("/")[-2] for g in globs) == ["a", "b"]
    assert all(g.endswith("/*.csv") for g in globs)


def test_append_creates_then_appends(spark, tmp_path):
    schema = S.table(id=S.LONG, name=S.STR)
    rows = spark.createDataFrame([("a", 1, "extra")], "name string, id int, other string")
    for times in (1, 2):
        sinks.append_table(rows, "append_me", schema, path=str(tmp_path / "t"))
        stored = spark.table("append_me")
        assert stored.schema == schema
        assert stored.count() == times
    with pytest.raises(ValueError, match="missing"):
        sinks.append_table(rows.drop("id"), "append_me", schema)


def test_csv_is_written_in_parallel_and_replaced(spark, tmp_path):
    for rows in (40, 11):
        path = sinks.write_csv(spark.range(rows).repartition(4), str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("part-*"))) == 4
    assert spark.read.option("header", True).csv(path).count() == 11


def test_runs_stay_side_by_side(spark, tmp_path):
    for run in ("1", "2"):
        assert sinks.write_csv(spark.range(2), str(tmp_path), run_id=run).endswith(f"run={run}")
    assert spark.read.option("header", True).csv(str(tmp_path)).count() == 4


def test_parts_are_written_apart(spark, tmp_path):
    parts = split_contiguous(spark.range(25), 10, ["id"])
    sinks.write_parts(parts, str(tmp_path / "parts"))
    sizes = spark.read.parquet(str(tmp_path / "parts")).groupBy("part").count().collect()
    assert sorted(map(tuple, sizes)) == [(p, 2) for p in range(9)] + [(9, 7)]


def test_shared_parent_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def tick(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    parent = spark.range(100).repartition(2).mapInPandas(tick, "id long")
    tables = sinks.TableSet(
        {"even": parent.filter("id % 2 = 0"), "odd": parent.filter("id % 2 = 1")}, shared=[parent]
    )
    sinks.write_all(tables, lambda name, df: df.write.parquet(str(tmp_path / name)))
    assert seen.value == 100
    assert spark.read.parquet(str(tmp_path / "odd")).agg(F.count("*")).first()[0] == 50
    assert not parent.is_cached
