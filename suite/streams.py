"""Streaming ingestion of files written from whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from placemill import plans, streaming
from placemill import schemas as S
from placemill.runtime import scratch_path
from suite import inputs
from suite.tables import MAPS_REVIEWS_RESULT, REPLIES_RESULT, YELP_REVIEWS_RESULT
from suite.registry import query


def _run(start) -> None:
    started = start()
    for one in started if isinstance(started, list) else [started]:
        one.awaitTermination()


@query("t1_arriving_reviews", MAPS_REVIEWS_RESULT)
def arriving_reviews(t):
    """Three runs: some files, no new file, the remaining files."""
    raw, out = scratch_path(t.spark, "t1-raw"), scratch_path(t.spark, "t1-out")
    sink = streaming.BatchFolders(out, S.OUTPUT_TABLES)
    reviews = inputs.maps_reviews(t)

    def run():
        return streaming.ingest(
            t.spark,
            raw,
            S.MAPS_REVIEWS,
            plans.build_maps_reviews,
            sink,
            glob="*.json",
            checkpoint=f"{out}/_checkpoint",
            name="reviews",
        )

    early = F.col("rating") <= 5
    reviews.filter(early).write.json(f"{raw}/early")
    _run(run)
    _run(run)
    reviews.filter(~early).write.json(f"{raw}/late")
    _run(run)
    return sink.read(t.spark, "reviews")


@query("t1_arriving_copies", MAPS_REVIEWS_RESULT)
def arriving_copies(t):
    """All files arrive twice; rows that are known are not written again."""
    raw, out = scratch_path(t.spark, "t1c-raw"), scratch_path(t.spark, "t1c-out")
    sink = streaming.BatchFolders(out, S.OUTPUT_TABLES, new_only={"reviews": ("text",)})
    reviews = inputs.maps_reviews(t).drop("resp")

    def run():
        return streaming.ingest(
            t.spark,
            raw,
            reviews.schema,
            plans.build_maps_reviews,
            sink,
            glob="*.json",
            checkpoint=f"{out}/_checkpoint",
            name="reviews",
        )

    for arrival in ("first", "second"):
        reviews.write.json(f"{raw}/{arrival}")
        _run(run)
    return sink.read(t.spark, "reviews")


@query(
    "t2_routed_files",
    f"""SELECT 'tips_yelp' AS name, user_id, date AS at FROM ({inputs.TIPS_RESULT})
    UNION ALL
    SELECT 'users_yelp', user_id, yelping_since FROM ({inputs.USERS_RESULT})""",
)
def routed_files(t):
    """Tips as JSON and users as parquet arrive in one folder."""
    raw, out = scratch_path(t.spark, "t2-raw"), scratch_path(t.spark, "t2-out")
    inputs.yelp_tips(t).write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").json(
        f"{raw}/tips"
    )
    users = inputs.yelp_users(t).drop("source_seq")
    users.write.parquet(f"{raw}/users")
    sink = streaming.BatchFolders(out, S.OUTPUT_TABLES)
    routes = [
        streaming.Route("*.json", S.YELP_TIPS, plans.build_yelp_tips, "tips"),
        streaming.Route(
            "*.parquet",
            users.schema,
            lambda sides: plans.build_yelp_users(
                {"users": sides["users"]}, order_by=["review_count"], scope="global"
            ),
            "users",
            "parquet",
        ),
    ]
    _run(lambda: streaming.ingest_routes(t.spark, raw, routes, sink, checkpoint=f"{out}/_checkpoint"))
    tips = sink.read(t.spark, "tips_yelp")
    found = sink.read(t.spark, "users_yelp")
    return tips.select(F.lit("tips_yelp").alias("name"), "user_id", F.col("date").alias("at")).union(
        found.select(F.lit("users_yelp").alias("name"), "user_id", "yelping_since")
    )


@query("t3_static_sides", YELP_REVIEWS_RESULT)
def static_sides(t):
    """Arriving reviews are restricted by business and state tables read per batch."""
    raw, out = scratch_path(t.spark, "t3-raw"), scratch_path(t.spark, "t3-out")
    reviews = inputs.yelp_reviews(t)
    reviews.write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").json(raw)
    sink = streaming.BatchFolders(out, S.OUTPUT_TABLES)

    def build(sides):
        return plans.build_yelp_reviews(sides, order_by=["source_seq"], scope="global")

    _run(
        lambda: streaming.ingest(
            t.spark,
            raw,
            S.YELP_REVIEWS,
            build,
            sink,
            glob="*.json",
            checkpoint=f"{out}/_checkpoint",
            name="reviews",
            static=lambda _: {"business": inputs.yelp_business(t), "states": inputs.states(t)},
        )
    )
    return sink.read(t.spark, "reviews")


@query(
    "t1_first_arrivals",
    f"""SELECT 'reviews' AS name, business_id, date AS at, text FROM ({MAPS_REVIEWS_RESULT})
    UNION ALL
    SELECT 'resp_reviews', business_id, time, text FROM ({REPLIES_RESULT})""",
)
def first_arrivals(t):
    """Rows arrive twice in one run and again in the next; state keeps each from loading twice."""
    raw, out = scratch_path(t.spark, "t1f-raw"), scratch_path(t.spark, "t1f-out")
    sink = streaming.BatchFolders(out, S.OUTPUT_TABLES)
    reviews = inputs.maps_reviews(t)

    def run():
        return streaming.ingest(
            t.spark,
            raw,
            S.MAPS_REVIEWS,
            plans.build_maps_reviews,
            sink,
            glob="*.json",
            checkpoint=f"{out}/_checkpoint",
            name="reviews",
            known_by=S.MAPS_REVIEWS.names,
        )

    early = F.col("rating") <= 5
    for arrivals in ({"1": reviews.filter(early), "2": reviews.filter(early)}, {"3": reviews}):
        for folder, rows in arrivals.items():
            rows.write.json(f"{raw}/{folder}")
        _run(run)
    found = sink.read(t.spark, "reviews")
    replies = sink.read(t.spark, "resp_reviews")
    return found.select(
        F.lit("reviews").alias("name"), "business_id", F.col("date").alias("at"), "text"
    ).union(replies.select(F.lit("resp_reviews"), "business_id", "time", "text"))


@query(
    "t2_catch_all",
    f"""SELECT 'tips_yelp' AS name, user_id, date AS at FROM ({inputs.TIPS_RESULT})
    UNION ALL
    SELECT 'users_yelp', user_id, yelping_since FROM ({inputs.USERS_RESULT})""",
)
def catch_all(t):
    """Tips go by their name, although a later route matches them as well; all other files are users."""
    raw, out = scratch_path(t.spark, "t2c-raw"), scratch_path(t.spark, "t2c-out")
    users = inputs.yelp_users(t).drop("source_seq")
    sink = streaming.BatchFolders(out, S.OUTPUT_TABLES)

    def build_users(sides):
        return plans.build_yelp_users(
            {"users": sides["users"]}, order_by=["review_count"], scope="global"
        )

    routes = [
        streaming.Route("tip.json/*", S.YELP_TIPS, plans.build_yelp_tips, "tips"),
        streaming.Route("*.json", users.schema, build_users, "users"),
    ]
    rest = streaming.Route("*", users.schema, build_users, "users", "parquet")

    def run():
        return streaming.ingest_by_name(
            t.spark, raw, routes, sink, checkpoint=f"{out}/_checkpoint", default=rest
        )

    tips = inputs.yelp_tips(t)
    third = F.pmod(F.xxhash64("user_id"), F.lit(3))
    tips.write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").json(f"{raw}/tip.json")
    users.where(third == 0).write.parquet(f"{raw}/users [old]")
    _run(run)
    users.where(third == 1).write.json(f"{raw}/users {{new}}")
    users.where(third == 2).write.parquet(f"{raw}/tip.json.copy")
    _run(run)
    _run(run)
    found = sink.read(t.spark, "tips_yelp")
    people = sink.read(t.spark, "users_yelp")
    return found.select(F.lit("tips_yelp").alias("name"), "user_id", F.col("date").alias("at")).union(
        people.select(F.lit("users_yelp").alias("name"), "user_id", "yelping_since")
    )
