"""The homicide fact table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from placemill import schemas
from placemill.constants import HOMICIDE_DROPPED, NO_DATA
from placemill.functions.temporal import parse_timestamp
from placemill.operators.columns import drop_strict
from placemill.operators.filters import not_sentinel
from placemill.sinks.tables import TableSet, conform


def build_homicides(inputs: Mapping[str, DataFrame]) -> TableSet:
    """``homicides`` with a known longitude (null counts as known), dated."""
    facts = drop_strict(inputs["homicides"], *HOMICIDE_DROPPED)
    facts = not_sentinel(facts, "LONGITUD", NO_DATA)
    facts = facts.withColumn("FECHA", parse_timestamp("FECHA"))
    return TableSet({"hechos_homicidios": conform(facts, schemas.HOMICIDE_FACTS)})
