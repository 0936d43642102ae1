"""Questions to the game catalogue: playtime, recommendation and similarity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placemill.operators.dedupe import dedupe_first
from placemill.operators.filters import not_null


def playtime_by_genre_year(facts: DataFrame) -> DataFrame:
    """Playtime per ``(genres, release_year)``; null keys are dropped."""
    keys = ["genres", "release_year"]
    total = F.coalesce(F.sum("playtime_forever"), F.lit(0)).alias("playtime_forever")
    return not_null(facts, *keys).groupBy(*keys).agg(total)


def best_year(agg: DataFrame, genre: str | None = None) -> DataFrame:
    """The release year with most playtime, for one genre or for each.

    ``agg`` is the result of ``playtime_by_genre_year``. Ties go to the earlier
    year. The argument is lower-cased, the stored genre is not.
    """
    if genre is not None:
        agg = agg.filter(F.col("genres") == genre.lower())
    rank = F.struct(-F.col("playtime_forever"), "release_year")
    best = F.min_by(F.struct("release_year", "playtime_forever"), rank).alias("best")
    return agg.groupBy("genres").agg(best).select("genres", "best.*")


def top_user(facts: DataFrame, genre: str | None = None) -> DataFrame:
    """The user with the largest playtime in one release year, with all years.

    For one genre or for each: the user is taken from the single largest
    (user, year) sum, not from the total per user. Ties go to the smaller user,
    then to the earlier year.
    """
    if genre is not None:
        facts = facts.filter(F.col("genres") == genre.lower())
    keys = ["genres", "user_id", "release_year"]
    total = F.coalesce(F.sum("playtime_forever"), F.lit(0)).alias("playtime_forever")
    sums = not_null(facts, *keys).groupBy(*keys).agg(total)
    years = F.collect_list(F.struct("release_year", "playtime_forever")).alias("years")
    best = F.min(F.struct((-F.col("playtime_forever")).alias("least"), "release_year")).alias("best")
    users = sums.groupBy("genres", "user_id").agg(years, best)
    rank = F.struct("best.least", "user_id", "best.release_year", "years")
    winners = users.groupBy("genres").agg(F.min(rank).alias("winner"))
    return winners.select("genres", "winner.user_id", F.inline("winner.years")).orderBy(
        "genres", F.desc("playtime_forever"), "release_year"
    )


def top_items(
    reviews: DataFrame,
    games: DataFrame,
    year: int,
    *,
    positive: bool,
    k: int = 3,
    order_by: Sequence = ("game_name",),
) -> DataFrame:
    """The ``k`` games most often recommended, or not recommended, in a year.

    ``positive`` counts recommending reviews with a positive or neutral text,
    otherwise non-recommending ones with a negative text. Games without a
    catalogue entry are left out before the ranking. A game listed several times
    is named by its first row under ``order_by``.
    """
    score = F.col("sentiment_analysis")
    opinion = F.col("recommend") & (score > 0) if positive else ~F.col("recommend") & (score == 0)
    counts = (
        reviews.filter(opinion & (F.col("year") == year) & F.col("game_id").isNotNull())
        .groupBy("game_id")
        .agg(F.count("*").alias("size"))
    )
    named = dedupe_first(games, ["game_id"], order_by, scope="global")
    order = [F.desc("size"), F.col("game_id")]
    best = (
        counts.join(named.select("game_id", "game_name"), "game_id").orderBy(*order).limit(k)
    )
    place = F.row_number().over(Window.orderBy(*order))
    return best.select(place.alias("position"), "game_id", "game_name", "size")


def sentiment_counts(
    games: DataFrame, reviews: DataFrame, year: int, order_by: Sequence = ("release_year",)
) -> DataFrame:
    """Negative, neutral and positive reviews of the games released in a year.

    A game listed several times is released when its first row under
    ``order_by`` says. Classes are keyed by value: a missing class counts 0.
    """
    released = dedupe_first(games, ["game_id"], order_by, scope="global").filter(
        (F.col("release_year") == year) & F.col("game_id").isNotNull()
    )
    score = F.col("sentiment_analysis")
    classes = {"negative": 0, "neutral": 1, "positive": 2}
    # Counted per game before the join: a game with very many reviews moves as one row.
    per_game = reviews.groupBy("game_id").agg(
        *[F.count_if(score == value).alias(name) for name, value in classes.items()]
    )
    return per_game.join(released.select("game_id"), "game_id").agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in classes]
    )


def canonical_genre(games: DataFrame, genre: str) -> DataFrame:
    """One row: the catalogue's spelling of a genre, or ``''`` if unknown."""
    same = F.lower("genres") == genre.lower()
    return games.filter(same).agg(F.coalesce(F.min("genres"), F.lit("")).alias("genre"))


def similar_items(
    items: DataFrame, sims_or_vectors: DataFrame, item_id: int, k: int = 5
) -> DataFrame:
    """The ``k`` items most similar to an item; no rows if it is unknown.

    The second input is a similarity table ``(i, j, sim)`` or a vector table
    ``(idx, embedding)`` scored by cosine. Candidates rank by similarity, then by
    index, and the first place is skipped: usually the item itself, but a copy
    with a smaller index can stand there.
    """
    wanted = items.filter(F.col("game_id") == item_id).orderBy("idx").limit(1)
    if "sim" in sims_or_vectors.columns:
        anchor = wanted.select(F.col("idx").alias("i"))  # one row by its limit
        scored = sims_or_vectors.join(F.broadcast(anchor), "i").select("j", "sim")
    else:
        scored = cosine_to(sims_or_vectors, wanted.select("idx"))
    # Null similarities order last, so they can go after the limit.
    order = [F.desc("sim"), F.col("j")]
    ranked = (
        scored.orderBy(*order)
        .limit(k + 1)
        .withColumn("position", F.row_number().over(Window.orderBy(*order)) - 1)
        .filter((F.col("position") > 0) & F.col("sim").isNotNull())
    )
    names = items.select(F.col("idx").alias("j"), "game_id", "game_name")
    # At most k rows: they go to the items, not the items to them.
    named = names.join(F.broadcast(ranked), "j")
    return named.select("position", "game_id", "game_name", "sim").orderBy("position")


def cosine_to(vectors: DataFrame, anchor: DataFrame) -> DataFrame:
    """``(j, sim)``: cosine of every vector with the one whose ``idx`` is in ``anchor``.

    The anchor's vector is a scalar subquery: one scan scores all vectors. A
    vector of length zero has no direction, its similarity is null.
    """
    zero = F.lit(0.0)
    norm = F.sqrt(F.aggregate("embedding", zero, lambda s, x: s + x.cast("double") * x))
    own = (
        vectors.join(F.broadcast(anchor), "idx")
        .select(F.struct("embedding", norm.alias("norm")))
        .limit(1)
        .scalar()
    )
    products = F.zip_with("embedding", "_own.embedding", lambda x, y: x.cast("double") * y)
    dot = F.aggregate(products, zero, lambda s, x: s + x)
    return vectors.withColumn("_own", own).select(
        F.col("idx").alias("j"), F.try_divide(dot, norm * F.col("_own.norm")).alias("sim")
    )


def neighbours(sims: DataFrame, k: int = 5) -> DataFrame:
    """Ranks 2 to ``k + 1`` of every row of a similarity table, as ``position``.

    The rank limit also runs before the shuffle, so a row with very many entries
    sends only its best ones.
    """
    order = Window.partitionBy("i").orderBy(F.desc("sim"), "j")
    ranked = sims.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k + 1)
    return (
        ranked.filter(F.col("_rank") > 1).withColumn("position", F.col("_rank") - 1).drop("_rank")
    )
