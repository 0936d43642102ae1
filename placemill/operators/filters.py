"""Row filters. Each is a plain predicate, so Catalyst can push it down."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.constants import FIRST_YEAR, LAST_YEAR, STATES
from placemill.functions.temporal import year_bounds
from placemill.functions.text import contains_token


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """Rows without a null in the given columns.

    Spelled as ``IS NOT NULL``, which scans can use and which joins on the same
    columns would add anyway, so equal subplans stay equal and are reused.
    """
    for name in cols:
        df = df.filter(F.col(name).isNotNull())
    return df


def has_category(df: DataFrame, col: str, value: str) -> DataFrame:
    """Rows whose array column holds ``value`` as a whole item."""
    return df.filter(F.array_contains(F.col(col), value))


def has_token(
    df: DataFrame, col: str, value: str, *, sep: str = ",", trim_tokens: bool = False
) -> DataFrame:
    """Rows whose separated list holds ``value``; see ``contains_token``."""
    return df.filter(contains_token(col, value, sep=sep, trim_tokens=trim_tokens))


def in_states(df: DataFrame, col: str, states: Sequence[str] = STATES) -> DataFrame:
    """Rows of the given states; null is dropped."""
    return df.filter(F.col(col).isin(*states))


def year_between(
    df: DataFrame, col: str, lo: int = FIRST_YEAR, hi: int = LAST_YEAR
) -> DataFrame:
    """Rows dated in the years ``lo`` to ``hi``; null is dropped.

    Written as a range on the column itself, so parquet can skip row groups.
    """
    kind = df.schema[col].dataType
    first, after = [F.lit(str(moment)).cast(kind) for moment in year_bounds(lo, hi)]
    return df.filter((F.col(col) >= first) & (F.col(col) < after))


def not_sentinel(df: DataFrame, col: str, value: str) -> DataFrame:
    """Rows other than ``value``; null rows are kept."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(value)))


def exclude_values(df: DataFrame, col: str, values: Iterable[str]) -> DataFrame:
    """Rows whose value is not listed; null rows are kept."""
    values = list(values)
    return df.filter(~F.coalesce(F.col(col).isin(*values), F.lit(False))) if values else df
