"""Address expressions.

An address such as ``Name, Street, City, FL 33601`` is read from its end: the
state code is the second and third character of the last comma part, the city
the part before it. Shorter addresses carry neither.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placemill.functions.text import split_list, strip_ws

# An address must be longer than this and have more parts.
MIN_LENGTH = 10
MIN_PARTS = 2


def address_code(address: Column) -> Column:
    """The state-code fragment (at most two characters), or null."""
    parts = split_list(address)
    readable = (F.length(address) > MIN_LENGTH) & (F.size(parts) > MIN_PARTS)
    return F.when(readable, F.substring(F.try_element_at(parts, F.lit(-1)), 2, 2))


def address_city(address: Column) -> Column:
    """The next-to-last comma part without surrounding white space, or null."""
    return strip_ws(F.try_element_at(split_list(address), F.lit(-2)))
