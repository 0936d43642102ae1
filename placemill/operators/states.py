"""Joins with the state dimension ``(nombre_largo, nombre_corto)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.constants import NO_DATA
from placemill.functions.address import address_city, address_code
from placemill.functions.text import strip_ws
from placemill.runtime import broadcast_if_small


def attach_state(
    df: DataFrame, states: DataFrame, code_col: str, how: str = "left", out: str = "estado"
) -> DataFrame:
    """Add the long state name ``out``, replacing an old one, for the code in ``code_col``.

    A join as it stands: a code that occurs twice in ``states`` gives two rows.
    """
    names = states.select(
        F.col("nombre_corto").alias(code_col), strip_ws("nombre_largo").alias(out)
    )
    return df.drop(out).join(broadcast_if_small(names), code_col, how)


def parse_address(
    df: DataFrame,
    states: DataFrame,
    col: str = "address",
    *,
    mode: str = "exact",
    order_by: str | None = None,
) -> DataFrame:
    """Add ``city`` and ``state`` read from an address, replacing old ones.

    ``mode="exact"`` looks the code fragment up as it is; of a code that occurs
    again the smallest name counts, so no row is doubled. ``mode="contains"``
    takes the first state, in dimension order (``order_by``, or scan order),
    whose code contains the fragment. Without a state both are ``SIN DATO``.
    """
    if mode == "exact":
        lookup = states.groupBy(F.col("nombre_corto").alias("_code")).agg(
            F.min(strip_ws("nombre_largo")).alias("_state")
        )
    elif mode == "contains":
        lookup = _states_by_fragment(states, order_by)
    else:
        raise ValueError(f"unknown mode: {mode}")
    coded = df.drop("city", "state").withColumn("_code", address_code(F.col(col)))
    found = coded.join(broadcast_if_small(lookup), "_code", "left")
    city = F.when(F.col("_state").isNotNull(), address_city(F.col(col)))
    return found.withColumns(
        {
            "city": F.coalesce(city, F.lit(NO_DATA)),
            "state": F.coalesce(F.col("_state"), F.lit(NO_DATA)),
        }
    ).drop("_code", "_state")


def _states_by_fragment(states: DataFrame, order_by: str | None) -> DataFrame:
    """``(_code, _state)``: every piece of a code that a fragment can equal.

    A fragment has at most two characters. It is contained in a code exactly if
    it is one of the code's pieces of that length, so containment becomes an
    equality join on the pieces.
    """
    code = F.col("nombre_corto")
    place = F.col(order_by) if order_by else F.monotonically_increasing_id()
    starts = F.sequence(F.lit(1), F.length(code))
    singles = F.transform(starts, lambda at: F.substring(code, at, F.lit(1)))
    pairs = F.transform(starts, lambda at: F.substring(code, at, F.lit(2)))
    pieces = F.array_distinct(F.concat(F.array(F.lit("")), singles, pairs))
    return (
        states.select(strip_ws("nombre_largo").alias("_name"), code, place.alias("_place"))
        .select("_name", "_place", F.explode(pieces).alias("_code"))
        .groupBy("_code")
        .agg(F.min_by("_name", "_place").alias("_state"))
    )
