"""Bitmaps of key hashes: a compact filter that a large scan can be tested against.

The filter keeps every row whose key occurs among the given keys, and a few others
whose hash falls on the same bit. It is sent to all tasks, so the scanned side moves only
rows that pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one bitmap row, fixed by the bitmap functions.
ROW_BITS = 1 << 15
#: The largest filter: 2**27 bits, 16 MB in all.
MAX_BITS = 1 << 27
#: Bits a key. One row in about so many passes without having a key.
BITS_PER_KEY = 16
#: Beyond so many keys most bits would be set, and the filter would hold nothing back.
MAX_KEYS = MAX_BITS // 2


def bits_for(keys: int) -> int:
    """Size of a filter for so many keys: a power of two, of one row at least."""
    wanted = max(ROW_BITS, keys * BITS_PER_KEY)
    return min(MAX_BITS, 1 << math.ceil(math.log2(wanted)))


def _place(on: Sequence[str], bits: int) -> Column:
    """The bit of a key, counted from 1 as the bitmap functions do."""
    return F.pmod(F.xxhash64(*on), F.lit(bits)) + 1


def _free(df: DataFrame, wish: str) -> str:
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def maybe_among(df: DataFrame, keys_df: DataFrame, on: Sequence[str], *, keys: int) -> DataFrame:
    """Rows of ``df`` whose key may occur in ``keys_df``; a key that does occur always stays.

    ``keys`` is the number of rows of ``keys_df`` or more; it sets the size of the
    filter, 16 MB at most. Rows with a null in a key column go. ``df`` is not shuffled.
    """
    bits = bits_for(keys)
    on = list(on)
    place = _place(on, bits)
    known = keys_df.dropna(subset=on).select(place.alias("place"))
    row, bitmap = _free(df, "_bitmap_row"), _free(df, "_bitmap")
    filled = known.groupBy(F.bitmap_bucket_number("place").alias(row)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias(bitmap)
    )
    # At most MAX_BITS / ROW_BITS rows of 4 kB.
    joined = df.dropna(subset=on).join(
        F.broadcast(filled), F.bitmap_bucket_number(place) == F.col(row), "inner"
    )
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(bitmap, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = F.expr(f"getbit(cast({_free(df, '_byte')} as int), {_free(df, '_bit')})")
    tested = joined.withColumns(
        {_free(df, "_byte"): byte, _free(df, "_bit"): F.pmod(bit, F.lit(8)).cast("int")}
    )
    return tested.where(is_set == 1).select(*[F.col(name) for name in df.columns])
