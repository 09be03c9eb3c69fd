"""Sharding by a permutation-filled lookup table.

Every shard walks the slots of a prime-sized table in an order of its own
(offset and step from a digest of its name).  In turns, each claims the next
slot of its order that is still free, until all are taken; so shards hold
equal numbers of slots (off by one at most), and adding or removing a shard
moves few slots besides its own.  A key's slot is its digest modulo the table
size; the table, whose size is a parameter and doesn't depend on the data,
goes into the plan, so a placement is one array lookup per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 4099       # prime; about 64 slots for each of 64 shards
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _digest(text: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{text}".encode()).digest()[:8], "big")


def lookup_table(shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index of the shard in ``shards``.

    The outcome depends on the shards' names, not on the order given.
    """
    if len(set(shards)) != len(shards) or not 0 < len(shards) <= size:
        raise ValueError("shards: distinct names, one at least, not more than slots")
    if size > 2 and any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("size must be prime")
    order = sorted(range(len(shards)), key=lambda i: shards[i])
    at = {i: _digest(shards[i], "offset") % size for i in order}
    step = {i: _digest(shards[i], "step") % max(1, size - 1) + 1 for i in order}
    table, free = [-1] * size, size
    while free:
        for i in order:
            if not free:
                break
            while table[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % size
            table[at[i]] = i
            free -= 1
    return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """A key's slot: the first 32 bits of the MD5 of its text, modulo size.
    Null keys go by the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(size))


def place(docs: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """(key, slot, shard) per row of ``docs``, repeated rows included.

    Null keys have a slot like any other (that of the empty text); rows with
    equal keys share a shard; an empty table gives no rows; other columns of
    ``docs`` play no part, whatever their names.  No shuffle.
    """
    table = F.array(*[F.lit(shards[i]) for i in lookup_table(shards, size)])
    placed = docs.select(F.col(key).alias(key), slot_of(F.col(key), size).alias("slot"))
    return placed.select(key, "slot", F.get(table, F.col("slot").cast("int")).alias("shard"))
