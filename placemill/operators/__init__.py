"""DataFrame-to-DataFrame operators."""

from placemill.operators.columns import dedupe_column_names, drop_strict
from placemill.operators.dedupe import dedupe_first, first_rows
from placemill.operators.filters import (
    exclude_values,
    has_category,
    has_token,
    in_states,
    not_null,
    not_sentinel,
    year_between,
)
from placemill.operators.geo import PlaceIndex, attach_place, place_index
from placemill.operators.incremental import only_new, restrict_to
from placemill.operators.keyfilter import maybe_among
from placemill.operators.nested import (
    explode_option,
    fill_nulls,
    map_columns,
    map_keys,
    open_map_columns,
)
from placemill.operators.profiling import null_counts, profile, value_counts
from placemill.operators.rowindex import (
    keys_at_places,
    row_pages,
    row_range,
    split_contiguous,
    with_row_index,
)
from placemill.operators.similar import similarity_table
from placemill.operators.spread import spread_join
from placemill.operators.states import attach_state, parse_address

__all__ = [
    "PlaceIndex",
    "attach_place",
    "attach_state",
    "dedupe_column_names",
    "dedupe_first",
    "drop_strict",
    "exclude_values",
    "explode_option",
    "fill_nulls",
    "first_rows",
    "has_category",
    "has_token",
    "in_states",
    "keys_at_places",
    "map_columns",
    "map_keys",
    "maybe_among",
    "not_null",
    "not_sentinel",
    "null_counts",
    "only_new",
    "open_map_columns",
    "parse_address",
    "place_index",
    "profile",
    "restrict_to",
    "row_pages",
    "row_range",
    "similarity_table",
    "split_contiguous",
    "spread_join",
    "value_counts",
    "with_row_index",
    "year_between",
]
