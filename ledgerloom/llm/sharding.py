"""Placement of rows on shards by a permutation-filled lookup table.

Every shard has its own order of the slots of a table of prime size: offset, offset + skip,
offset + 2 skip and so on, both from hashes of its name. The shards take turns, each claiming its
next free slot, until all slots are taken. A row's key gives a slot, and the slot its shard. Shards get
equal numbers of slots, give or take one, and when a shard goes few rows of the others move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A prime; one hundred times the number of shards or more keeps the loads within one percent.
SLOTS = 8191


def _hash(name: str) -> int:
    return int(hashlib.md5(name.encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """For each slot the number of its shard."""
    if not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("There must be shards, no more of them than slots, with names of their own")
    if any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)) or slots < 2:
        raise ValueError("The number of slots must be a prime")
    orders = [(_hash(f"{s}/offset") % slots, _hash(f"{s}/skip") % (slots - 1) + 1) for s in shards]
    table, steps, free = [-1] * slots, [0] * len(shards), slots
    while True:
        for shard, (offset, skip) in enumerate(orders):
            while table[slot := (offset + steps[shard] * skip) % slots] >= 0:
                steps[shard] += 1
            table[slot] = shard
            free -= 1
            if not free:
                return table


def slot_of(key: str, slots: int = SLOTS) -> Column:
    """The slot of a key, from the first 60 bits of the MD5 of its text; a null key is the empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long") % slots


def place(rows: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """rows with `slot` and `shard` (both replace columns of that name).

    Rows with equal keys go to one shard; those without a key to the shard of the empty text. The
    table travels with the plan as a literal of `slots` numbers, so nothing is shuffled.
    """
    names = F.array(*[F.lit(s) for s in shards])
    table = F.lit(lookup_table(shards, slots))
    return rows.withColumn("slot", slot_of(key, slots)).withColumn("shard", F.element_at(names, F.element_at(table, (F.col("slot") + 1).cast("int")) + 1))


def write(rows: DataFrame, key: str, shards: Sequence[str], path: str, files: int = 1, slots: int = SLOTS) -> None:
    """One folder per shard, of about `files` Parquet files each; rows of a shard are dealt to them by a hash of all columns."""
    placed = place(rows, key, shards, slots)
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(files))
    placed.repartition(len(shards) * files, "shard", part).write.partitionBy("shard").parquet(path)
