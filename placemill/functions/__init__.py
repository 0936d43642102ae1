"""Column expressions: text, time and address parsing."""

from placemill.functions.address import address_city, address_code
from placemill.functions.temporal import from_millis, parse_timestamp, year_bounds
from placemill.functions.text import contains_token, split_list, strip_ws

__all__ = [
    "address_city",
    "address_code",
    "contains_token",
    "from_millis",
    "parse_timestamp",
    "split_list",
    "strip_ws",
    "year_bounds",
]
