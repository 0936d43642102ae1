"""File-arrival ingestion: restarts, copies, routes and side tables."""

from __future__ import annotations

import json

import pytest

from placemill import plans, streaming
from placemill import schemas as S

MS_2015 = 1_420_070_400_000


def put(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(row) for row in rows))


def review(n, **more):
    row = {"gmap_id": "g", "user_id": f"{n}", "time": MS_2015 + n, "rating": 5, "text": "t"}
    return row | more


def run(spark, folder, sink, checkpoint, **options):
    query = streaming.ingest(
        spark,
        str(folder),
        S.MAPS_REVIEWS,
        plans.build_maps_reviews,
        sink,
        glob="*.json",
        checkpoint=str(checkpoint),
        name="reviews",
        **options,
    )
    query.awaitTermination()


def users(spark, sink):
    return sorted(int(r.user_id) for r in sink.read(spark, "reviews").collect())


def test_each_file_is_taken_once(spark, tmp_path):
    sink = streaming.BatchFolders(str(tmp_path / "out"), S.OUTPUT_TABLES)
    assert sink.read(spark, "reviews").count() == 0
    put(tmp_path / "in" / "1.json", [review(1), review(2, resp={"time": MS_2015, "text": "x"})])
    put(tmp_path / "in" / "notes.txt", [review(99)])
    run(spark, tmp_path / "in", sink, tmp_path / "cp")
    assert users(spark, sink) == [1, 2]
    run(spark, tmp_path / "in", sink, tmp_path / "cp")
    assert users(spark, sink) == [1, 2]
    put(tmp_path / "in" / "deep" / "2.json", [review(3)])
    run(spark, tmp_path / "in", sink, tmp_path / "cp")
    assert users(spark, sink) == [1, 2, 3]
    assert sink.read(spark, "resp_reviews").count() == 1
    assert sink.read(spark, "reviews").schema == S.REVIEWS


@pytest.mark.parametrize("prune", [False, True])
def test_known_rows_are_left_out(spark, tmp_path, prune):
    sink = streaming.BatchFolders(
        str(tmp_path / "out"),
        S.OUTPUT_TABLES,
        new_only={"reviews": ("text",)},
        prune_on={"reviews": "date"} if prune else {},
    )
    put(tmp_path / "in" / "1.json", [review(1), review(2)])
    run(spark, tmp_path / "in", sink, tmp_path / "cp")
    put(tmp_path / "in" / "2.json", [review(2, text="edited"), review(3)])
    run(spark, tmp_path / "in", sink, tmp_path / "cp")
    assert users(spark, sink) == [1, 2, 3]


def test_a_failed_batch_is_replaced(spark, tmp_path):
    """The second table of a batch fails after the first was written."""

    class Failing(streaming.BatchFolders):
        def write(self, name, df, batch_id):
            super().write(name, df, batch_id)
            if name == "resp_reviews":
                raise RuntimeError("lost")

    put(tmp_path / "in" / "1.json", [review(1, resp={"time": MS_2015, "text": "x"})])
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path / "in", Failing(str(tmp_path / "out"), S.OUTPUT_TABLES), tmp_path / "cp")
    sink = streaming.BatchFolders(str(tmp_path / "out"), S.OUTPUT_TABLES)
    put(tmp_path / "in" / "2.json", [review(2)])
    run(spark, tmp_path / "in", sink, tmp_path / "cp")
    assert users(spark, sink) == [1, 2]
    assert sink.read(spark, "resp_reviews").count() == 1


def test_files_can_be_taken_in_small_batches(spark, tmp_path):
    for n in range(4):
        put(tmp_path / "in" / f"{n}.json", [review(n)])
    sink = streaming.BatchFolders(str(tmp_path / "out"), S.OUTPUT_TABLES)
    run(spark, tmp_path / "in", sink, tmp_path / "cp", max_files=1)
    assert users(spark, sink) == [0, 1, 2, 3]
    assert len(list((tmp_path / "out" / "reviews").glob("batch_id=*"))) == 4


def test_position_and_side_tables(spark, tmp_path):
    """Places are deduplicated in file order; the states are read for each batch."""

    def site(key, name, state):
        address = f"1 Main St, Town, {state} 33601"
        return {"gmap_id": key, "name": name, "address": address, "category": ["Restaurant"]}

    states = [("Florida ", "FL", "")]
    sink = streaming.BatchFolders(str(tmp_path / "out"), S.OUTPUT_TABLES)

    def take():
        streaming.ingest(
            spark,
            str(tmp_path / "in"),
            S.MAPS_SITES,
            plans.build_maps_sites,
            sink,
            glob="*.json",
            checkpoint=str(tmp_path / "cp"),
            name="sites",
            static=lambda session: {"states": session.createDataFrame(states, S.STATE_DIM)},
        ).awaitTermination()

    put(tmp_path / "in" / "1.json", [site("1", "first", "FL"), site("1", "copy", "FL")])
    take()
    states.append(("Texas ", "TX", ""))
    put(tmp_path / "in" / "2.json", [site("2", "second", "TX")])
    take()
    found = sink.read(spark, "business").select("name", "state").collect()
    assert sorted(map(tuple, found)) == [("first", "Florida"), ("second", "Texas")]


def test_routes(spark, tmp_path):
    tip = {"business_id": "b", "user_id": "u", "date": "2015-01-01 00:00:00", "text": "t"}
    put(tmp_path / "in" / "tip.json", [tip])
    schema = S.table(**{f.name: f.dataType for f in S.USERS} | {"yelping_since": S.STR})
    rows = [("u", "n", 1, "2010-02-03 04:05:06", 0, 0, 0, 0, 4.0)] * 2
    frame = spark.createDataFrame(rows, schema).coalesce(1)
    frame.write.parquet(str(tmp_path / "in" / "users"))
    sink = streaming.BatchFolders(str(tmp_path / "out"), S.OUTPUT_TABLES)
    routes = [
        streaming.Route("tip*.json", S.YELP_TIPS, plans.build_yelp_tips, "tips"),
        streaming.Route("*.parquet", schema, plans.build_yelp_users, "users", "parquet"),
    ]
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    for query in streaming.ingest_routes(spark, folder, routes, sink, checkpoint=checkpoint):
        query.awaitTermination()
    assert sink.read(spark, "tips_yelp").count() == 1
    assert sink.read(spark, "users_yelp").count() == 1
