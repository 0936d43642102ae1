"""Loads that count once, sums kept up to date, split arrays, open keys and place indexes."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from placemill import operators as op
from placemill import plans, sinks, sources
from placemill import schemas as S
from placemill.operators import geo
from placemill.sinks import loads

ROW = S.table(k=S.LONG, v=S.STR)


def rows(spark, *keys):
    return spark.createDataFrame([(key, "x") for key in keys], ROW)


def keys_of(spark, root):
    return sorted(row.k for row in sinks.read_loads(spark, root, ROW).collect())


def test_a_load_counts_once(spark, tmp_path):
    root = str(tmp_path / "table")
    assert keys_of(spark, root) == []
    assert sinks.load_once(rows(spark, 1, 2), root, ROW, "a")
    assert not sinks.load_once(rows(spark, 1, 2), root, ROW, "a")
    assert sinks.load_once(rows(spark, 2, 3), root, ROW, "b")
    assert sinks.load_once(rows(spark), root, ROW, "none")
    assert keys_of(spark, root) == [1, 2, 2, 3]
    assert set(sinks.committed_loads(spark, root)) == {"a", "b", "none"}
    with pytest.raises(ValueError, match="load id"):
        sinks.load_once(rows(spark, 1), root, ROW, "../a")


def test_a_failure_between_the_steps_leaves_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(loads, "_commit", lost)
        with pytest.raises(RuntimeError):
            sinks.load_once(rows(spark, 1), root, ROW, "a")
    assert keys_of(spark, root) == []
    assert sinks.load_once(rows(spark, 1), root, ROW, "a")
    assert keys_of(spark, root) == [1]


def test_an_entry_that_was_cut_short_does_not_count(spark, tmp_path):
    root = tmp_path / "table"
    (root / "_loads").mkdir(parents=True)
    (root / "_loads" / "a").write_text("a-1")
    assert keys_of(spark, str(root)) == []
    assert sinks.load_once(rows(spark, 1), str(root), ROW, "a")
    assert keys_of(spark, str(root)) == [1]


def test_two_runs_of_a_load_and_two_first_loads(spark, tmp_path, monkeypatch):
    """The second run commits while the first one is still writing."""
    root, commit = str(tmp_path / "table"), loads._commit

    def overtaken(session, place, load_id, folder):
        monkeypatch.setattr(loads, "_commit", commit)
        assert sinks.load_once(rows(spark, 1), root, ROW, load_id)
        assert sinks.load_once(rows(spark, 7), root, ROW, "other")
        return commit(session, place, load_id, folder)

    monkeypatch.setattr(loads, "_commit", overtaken)
    assert not sinks.load_once(rows(spark, 1), root, ROW, "a")
    assert keys_of(spark, root) == [1, 7]


FACTS = "user_id string, genres string, release_year long, playtime_forever long"


def test_sums_are_kept_up_to_date(spark, tmp_path):
    root = str(tmp_path / "sums")
    batches = [
        [("u", "rpg", 2000, 5), ("v", "rpg", 2000, 6), ("v", None, 2000, 1), ("v", "act", 2001, None)],
        [("u", "rpg", 2000, 1), ("w", "sim", 1999, 2)],
        [],
        [("u", "act", 2001, 9), ("w", "sim", 1999, 3)],
    ]
    seen = []
    assert plans.kept_playtime(spark, root).count() == 0
    assert not plans.compact_playtime(spark, root)
    for number, batch in enumerate(batches):
        facts = spark.createDataFrame(batch, FACTS)
        assert plans.add_playtime(facts, root, f"b{number}")
        assert not plans.add_playtime(facts, root, f"b{number}")
        if number != 1:
            assert plans.compact_playtime(spark, root)
            assert not plans.compact_playtime(spark, root)
        seen += batch
        want = plans.playtime_by_genre_year(spark.createDataFrame(seen, FACTS))
        got = plans.kept_playtime(spark, root)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))




def test_an_array_file_is_read_by_many_tasks(spark, tmp_path):
    objects = [{"id": n, "text": f'é "{{[,]}}" {n}', "tags": ["a", "b]"]} for n in range(3000)]
    path = tmp_path / "in" / "array.json"
    path.parent.mkdir()
    path.write_text("﻿ [" + ",\n".join(json.dumps(o, ensure_ascii=False) for o in objects) + "]\n")
    schema = spark.createDataFrame([], "id long, text string, tags array<string>").schema
    whole = sources.read_json(spark, str(path), schema, array=True)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        split = sources.read_json_objects(spark, str(path), schema)
        assert split.rdd.getNumPartitions() > 5
        assert sorted(split.collect()) == sorted(whole.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


@pytest.mark.parametrize(
    "text", ['[{"id":1},{"id":2}]', "[]", "[\n]", "", '[{"id":1}]', '[\n{"id":1}\n,\n{"id":2}\n]', '[{"id":1},\r\n {"id":2} ]', '{"id":1}\n{"id":2}']
)
def test_forms_of_arrays(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    got = sources.read_json_objects(spark, str(tmp_path), S.table(id=S.LONG), glob="*.json")
    assert sorted(row.id for row in got.collect()) == [n for n in (1, 2) if f'"id":{n}' in text]


@pytest.mark.parametrize("text", ['[{"id":1} {"id":2}]', '[{"id":\n1}]', "[1,\n2]", '[{"id":"x"}]'])
def test_pieces_that_are_no_objects_are_errors(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="not a JSON object|MALFORMED|Malformed"):
        sources.read_json_objects(spark, str(tmp_path / "a.json"), S.table(id=S.LONG)).collect()


def test_columns_for_keys_that_are_found(spark):
    maps = [{"a": "1", "b": "2"}, {"a": "3", "c": None}, {}, None, {"b": "4", "a": "5"}]
    df = spark.createDataFrame(list(enumerate(maps)), "id int, m map<string,string>")
    got = op.open_map_columns(df, "m")
    assert got.columns == ["id", "a", "b", "c"]
    assert [tuple(r) for r in got.orderBy("id").collect()][:2] == [(0, "1", "2", None), (1, "3", None, None)]
    two = op.open_map_columns(df, "m", most=2, rest="more", fill="-")
    assert two.columns == ["id", "more", "a", "b"]
    assert [r.more for r in two.orderBy("id").collect()] == [{}, {"c": None}, {}, None, {}]
    assert op.open_map_columns(df, "m", least_rows=2, rest="more").columns == ["id", "more", "a", "b"]
    with pytest.raises(ValueError, match="more than 2 keys"):
        op.open_map_columns(df, "m", most=2)
    assert {(r.key, r.n) for r in op.map_keys(df, "m").collect()} == {("a", 3), ("b", 2), ("c", 1)}
    assert op.open_map_columns(df.limit(0), "m").columns == ["id"]


def test_many_thousand_keys_and_keys_that_names_cannot_tell_apart(spark):
    key = F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))
    df = spark.range(20_000).select("id", F.create_map(key, F.col("id"), F.lit("ID"), F.col("id")).alias("m"))
    got = op.open_map_columns(df, "m", most=20, rest="rest")
    assert len(got.columns) == 2 + 19  # "ID" is a column of the rows
    assert got.where("map_contains_key(rest, 'ID')").count() == 20_000
    clash = spark.createDataFrame([(1, {"x": 1, "X": 2})], "id int, m map<string,int>")
    with pytest.raises(ValueError, match="tells apart"):
        op.open_map_columns(clash, "m")


def test_one_lookup_whatever_the_depth(spark):
    """Thousands of places within a kilometre: deep cells, but no more joins."""
    dense = spark.range(3000).select(
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("city"),
        F.lit("s").alias("state"),
        (10 + F.pmod(F.xxhash64("id"), F.lit(10_000)) / 1_000_000).alias("latitude"),
        (-10 - F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000)) / 1_000_000).alias("longitude"),
    )
    index = op.place_index(dense, max_km=5)
    assert index.most_ranges > 16
    points = spark.range(200).select(
        "id",
        (9.98 + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(50_000)) / 1_000_000).alias("latitude"),
        (-10.03 + F.pmod(F.xxhash64("id", F.lit(3)), F.lit(50_000)) / 1_000_000).alias("longitude"),
    )
    placed = op.attach_place(points, index)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashJoin") + plan.count("SortMergeJoin") == 2
    km = geo.haversine_km(F.col("p.latitude"), F.col("p.longitude"), F.col("d.latitude"), F.col("d.longitude"))
    best = (
        points.alias("p").join(dense.alias("d"), km <= 5)
        .groupBy("p.id").agg(F.min(F.struct(km.alias("km"), "d.city", "d.state")).alias("b"))
    )
    want = {r.id: r.b.city for r in best.collect()}
    assert {r.id: r.ciudad for r in placed.collect() if r.ciudad} == want
    assert len(want) > 100


def test_ranges_do_not_overlap(spark):
    places = spark.range(500).select(
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("city"), F.lit("s").alias("state"),
        (F.pmod(F.xxhash64("id"), F.lit(1800)) / 10 - 90).alias("latitude"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(300)) / 1000 + 179.8).alias("longitude"),
    )
    index = op.place_index(places, max_km=100)
    by_cell = {}
    for row in index.ranges.collect():
        by_cell.setdefault((row["_row"], row["_col"]), []).append((row["_start"], row["_end"]))
    assert all(0 <= a < b <= 4**geo.MAX_LEVEL for spans in by_cell.values() for a, b in spans)
    for spans in by_cell.values():
        spans.sort()
        assert all(one[1] <= two[0] for one, two in zip(spans, spans[1:], strict=False))
