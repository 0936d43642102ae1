"""Sharding by a permutation-filled lookup table.

Each shard has a preference order over the slots of a prime-sized table, given by an
offset and a step from digests of its name. Shards take turns, each claiming the first
free slot it prefers, until the table is full. Adding or removing a shard moves few
other keys. A key's slot is its hash modulo the size, and the table is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemill.llm.shared import free_name

#: A prime; with up to a hundredth as many shards the loads differ by about a hundredth.
TABLE_SIZE = 65_537


def _digest(name: str, use: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{use}:{name}".encode()).digest()[:8], "big")


def is_prime(number: int) -> bool:
    return number > 1 and all(number % at for at in range(2, int(number**0.5) + 1))


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """The position in sorted ``shards`` that holds each slot.

    Does not depend on the order of ``shards``. Raises for no shards, a name that occurs
    twice, more shards than slots or a size that is not prime.
    """
    names = sorted(shards)
    if not names or len(set(names)) < len(names):
        raise ValueError("give one or more shards with different names")
    if not is_prime(size) or size < len(names):
        raise ValueError("the table size must be a prime not below the number of shards")
    slot = [_digest(name, "offset") % size for name in names]
    step = [_digest(name, "step") % (size - 1) + 1 for name in names]
    table, free = [-1] * size, size
    while True:
        for shard in range(len(names)):
            at = slot[shard]
            while table[at] >= 0:
                at = (at + step[shard]) % size
            table[at] = shard
            slot[shard] = at
            free -= 1
            if not free:
                return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(size)).cast("int")


def place(
    docs: DataFrame, shards: Sequence[str], *, key_column: str = "doc_id", size: int = TABLE_SIZE
) -> DataFrame:
    """``docs`` with ``slot`` (int) and ``shard`` (string), without a shuffle.

    The table has ``size`` rows, whatever the data, and is broadcast. Equal keys go to
    the same shard; a null key is a key like others. An empty table gives no rows.
    Underscores go in front of ``slot`` or ``shard`` where ``docs`` has such a column.
    """
    names = sorted(shards)
    slot, shard = free_name(docs, "slot"), free_name(docs, "shard")
    rows = [(at, names[own]) for at, own in enumerate(lookup_table(shards, size))]
    table = docs.sparkSession.createDataFrame(rows, f"`{slot}` int, `{shard}` string")
    return docs.withColumn(slot, slot_of(F.col(key_column), size)).join(F.broadcast(table), slot).select(
        *[docs[name] for name in docs.columns], slot, shard
    )
