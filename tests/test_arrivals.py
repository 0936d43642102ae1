"""Arriving files: state that keeps known rows out, and the router over file names."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from placemill import plans, streaming
from placemill import schemas as S

MS_2015 = 1_420_070_400_000


def put(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(row) for row in rows))


def review(n, **more):
    row = {"gmap_id": "g", "user_id": f"{n}", "time": MS_2015 + n, "rating": 5, "text": "t"}
    return row | more


def take(spark, tmp_path, known_by, sink=None, **options):
    sink = sink or streaming.BatchFolders(str(tmp_path / "out"), S.OUTPUT_TABLES)
    query = streaming.ingest(
        spark,
        str(tmp_path / "in"),
        S.MAPS_REVIEWS,
        plans.build_maps_reviews,
        sink,
        glob="*.json",
        checkpoint=str(tmp_path / "cp"),
        name="reviews",
        known_by=known_by,
        **options,
    )
    query.awaitTermination()
    return query, sink


def users(spark, sink):
    return sorted(int(r.user_id) for r in sink.read(spark, "reviews").collect())


KEYS = ["gmap_id", "user_id", "time", "rating"]


def test_known_rows_stay_out_over_restarts(spark, tmp_path):
    reply = {"time": MS_2015, "text": "x"}
    put(tmp_path / "in" / "1.json", [review(1, resp=reply), review(2), review(2), review(2, text="b")])
    _, sink = take(spark, tmp_path, KEYS)
    assert users(spark, sink) == [1, 2]
    put(tmp_path / "in" / "2.json", [review(1, resp=reply), review(3), review(2, text="c")])
    take(spark, tmp_path, KEYS)
    take(spark, tmp_path, KEYS)
    assert users(spark, sink) == [1, 2, 3]
    assert sink.read(spark, "resp_reviews").count() == 1


def test_nulls_are_alike_and_places_of_nulls_are_not(spark, tmp_path):
    rows = [review(1, text=None), review(1, text=None), review(1, gmap_id=None), review(1, gmap_id=None)]
    put(tmp_path / "in" / "1.json", rows)
    _, sink = take(spark, tmp_path, S.MAPS_REVIEWS.names)
    assert users(spark, sink) == [1, 1]


def test_a_failed_batch_loses_and_doubles_nothing(spark, tmp_path):
    class Failing(streaming.BatchFolders):
        def write(self, name, df, batch_id):
            super().write(name, df, batch_id)
            if name == "resp_reviews":
                raise RuntimeError("lost")

    put(tmp_path / "in" / "1.json", [review(1), review(1), review(2)])
    with pytest.raises(Exception, match="lost"):
        take(spark, tmp_path, KEYS, Failing(str(tmp_path / "out"), S.OUTPUT_TABLES))
    put(tmp_path / "in" / "2.json", [review(2), review(3)])
    _, sink = take(spark, tmp_path, KEYS)
    assert users(spark, sink) == [1, 2, 3]


def test_a_batch_reads_its_own_files_only(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    for n in range(4):
        put(tmp_path / "in" / f"{n}.json", [review(at) for at in range(10 * n, 10 * n + 20)])
    query, sink = take(spark, tmp_path, KEYS, max_files=1)
    read = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert read == [20] * 4
    kept = query.recentProgress[-1]["stateOperators"][0]
    assert kept["numRowsTotal"] == 50
    assert any("rocksdb" in name for name in kept["customMetrics"])
    assert users(spark, sink) == list(range(50))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


def test_timestamps_that_differ_in_microseconds_are_different(spark):
    rows = spark.range(2).select(F.timestamp_micros(F.col("id")).alias("at"), F.lit(1).alias("_digest"))
    assert streaming.first_arrivals(rows, ["at"]).count() == 2
    assert streaming.first_arrivals(rows, ["at"]).columns == rows.columns


# --- the router

ROW = S.table(v=S.STR)


def route(glob, table, fmt="json"):
    def build(sides):
        return {table: sides["rows"].select("v")}

    return streaming.Route(glob, ROW, build, "rows", fmt)


def sink_of(tmp_path):
    return streaming.BatchFolders(str(tmp_path / "out"), {"a": ROW, "b": ROW, "rest": ROW})


def deal_all(spark, tmp_path, sink, **options):
    streaming.ingest_by_name(
        spark,
        str(tmp_path / "in"),
        [route("tip*.json", "a"), route("*.json", "b"), route("deep/*", "a")],
        sink,
        checkpoint=str(tmp_path / "cp"),
        **options,
    ).awaitTermination()


def found(spark, sink):
    return {
        table: sorted(r.v for r in sink.read(spark, table).collect()) for table in ("a", "b", "rest")
    }


NAMES = ["tip.json", "x.json", "tip [1].json", "user{1,2}.log", "what?*.txt", "100%25 #1.dat", "é.dat"]


def test_every_file_is_loaded_once(spark, tmp_path):
    sink, rest = sink_of(tmp_path), route("never", "rest")
    for name in NAMES:
        put(tmp_path / "in" / name, [{"v": name}])
    deal_all(spark, tmp_path, sink, default=rest, max_files=3)
    want = {"a": ["tip [1].json", "tip.json"], "b": ["x.json"], "rest": sorted(NAMES[3:])}
    assert found(spark, sink) == want
    put(tmp_path / "in" / "deep" / "tip.log", [{"v": "deep"}])
    put(tmp_path / "in" / "deep" / "er" / "noname", [{"v": "deeper"}])
    put(tmp_path / "in" / "other" / "noname", [{"v": "other"}])
    for _ in range(2):
        deal_all(spark, tmp_path, sink, default=rest)
    want["a"] = ["deep", "deeper", *want["a"]]
    want["rest"] = sorted([*want["rest"], "other"])
    assert found(spark, sink) == want


def test_a_file_without_a_route_fails_its_batch(spark, tmp_path):
    sink = sink_of(tmp_path)
    put(tmp_path / "in" / "tip.json", [{"v": "1"}])
    put(tmp_path / "in" / "odd", [{"v": "2"}])
    with pytest.raises(Exception, match="no route for the file odd"):
        deal_all(spark, tmp_path, sink)
    assert found(spark, sink) == {"a": [], "b": [], "rest": []}
    deal_all(spark, tmp_path, sink, default=route("*", "rest"))
    assert found(spark, sink) == {"a": ["1"], "b": [], "rest": ["2"]}


def test_a_failed_router_batch_is_replaced(spark, tmp_path):
    class Failing(streaming.BatchFolders):
        def write(self, name, df, batch_id):
            super().write(name, df, batch_id)
            if name == "b":
                raise RuntimeError("lost")

    put(tmp_path / "in" / "tip.json", [{"v": "1"}])
    put(tmp_path / "in" / "x.json", [{"v": "2"}])
    sink = sink_of(tmp_path)
    with pytest.raises(Exception, match="lost"):
        deal_all(spark, tmp_path, Failing(sink.root, sink.schemas))
    put(tmp_path / "in" / "y.json", [{"v": "3"}])
    deal_all(spark, tmp_path, sink)
    assert found(spark, sink) == {"a": ["1"], "b": ["2", "3"], "rest": []}


def test_deal():
    first, second, last = route("t*", "a"), route("*", "b"), route("x", "rest")
    assert streaming.deal(["u", "t", "d/t"], [first, second], last) == {first: ["d/t", "t"], second: ["u"]}
    assert streaming.deal(["u", "t"], [first], last) == {first: ["t"], last: ["u"]}
    assert streaming.deal([], [first], last) == {}
