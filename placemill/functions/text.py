"""Text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from placemill.constants import WHITESPACE


def strip_ws(col: Column | str) -> Column:
    """Remove all leading and trailing white space, not only blanks."""
    return F.btrim(_col(col), F.lit(WHITESPACE))


def split_list(col: Column | str, sep: str = ",") -> Column:
    """Split on a literal separator. Empty text gives one empty item."""
    return F.split(_col(col), re.escape(sep))


def contains_token(
    col: Column | str, value: str, *, sep: str = ",", trim_tokens: bool = False
) -> Column:
    """Whether a separated list holds ``value`` as a whole item.

    Items are compared as they stand: in ``"Burgers, Restaurants"`` the second
    item starts with a blank. ``trim_tokens`` strips them first.
    """
    items = split_list(col, sep)
    return F.array_contains(F.transform(items, strip_ws) if trim_tokens else items, value)


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
