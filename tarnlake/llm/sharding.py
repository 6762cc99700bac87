"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size: from an offset in steps of
a skip, both drawn from the shard's name. Shards take turns; each claims the next free slot of its order, until all
slots are taken. Slots per shard differ by one at most, and when a shard leaves, few of the others' slots
change hands. A document is placed by one hash and one lookup.

The table has ``slots`` rows whatever the corpus, so it is broadcast. A null key is placed as the text "null". Repeated
rows share a shard, as do all rows of one key; rows are neither dropped nor merged. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537


def draw(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """Index of the shard that owns each slot."""
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the table size must be prime, so that every skip reaches every slot")
    if not 0 < len(set(shards)) == len(shards) <= slots:
        raise ValueError("shard names must be distinct, at least one and no more than slots")
    now = [draw(f"offset:{s}") % slots for s in shards]
    skip = [draw(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    owner, free = [-1] * slots, slots
    while free:
        for k in range(min(len(shards), free)):
            while owner[now[k]] >= 0:
                now[k] = (now[k] + skip[k]) % slots
            owner[now[k]] = k
            free -= 1
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    text = F.coalesce(key.cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % slots


def place(df: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """Add ``slot`` and ``shard`` (replacing columns of these names)."""
    names = df.sparkSession.createDataFrame(list(enumerate(shards[k] for k in fill(shards, slots))), "slot long, shard string")
    placed = df.drop(*({"slot", "shard"} - {key})).withColumn("slot", slot_of(F.col(key), slots))
    return placed.join(F.broadcast(names), "slot", "left")
