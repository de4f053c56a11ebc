"""Sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size: offset + j * skip modulo
the size, both from a hash of its name. Shards take turns, each claiming the first free slot of its
order, until the table is full; so shards differ by one slot at most, and when a shard goes,
few slots change hands but its own. A row's key is hashed to a slot; the table, whose size is a
parameter, is broadcast, and the placement is one lookup, without a shuffle.

Defined results: a null key is hashed like the empty string, so all its rows are in one slot; equal
keys share a slot; no rows give no rows. Columns of the input stay as they are; where the input has a
column ``slot``, ``shard`` or ``_shard`` of any case, the operator's own takes underscores in front.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import free_name

HEX = 15  # digits of the md5 that make the key's hash


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:HEX], 16)


def lookup_table(shards: list[str], size: int) -> list[int]:
    """Slot -> place of its shard in ``shards``."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct, one at least")
    if size <= len(shards) or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table's size must be a prime above the number of shards")
    at = [_hash(f"offset {s}") % size for s in shards]
    skip = [_hash(f"skip {s}") % (size - 1) + 1 for s in shards]
    table, left = [-1] * size, size
    while left:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            table[at[i]] = i
            left -= 1
            if not left:
                break
    return table


def place(df: DataFrame, key: str, shards: list[str], size: int = 10_007, slot: str = "slot",
          shard: str = "shard") -> DataFrame:
    """``df`` with the slot (long) and the shard (place in ``shards``, int) of every row."""
    slot = free_name(slot, df.columns)
    shard = free_name(shard, [*df.columns, slot])
    spark, table = df.sparkSession, lookup_table(shards, size)
    slots = spark.createDataFrame(list(enumerate(table)), f"`{slot}` long, `{shard}` int")  # size rows
    digest = F.md5(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary"))
    hashed = F.conv(F.substring(digest, 1, HEX), 16, 10).cast("long") % size
    return df.withColumn(slot, hashed).join(F.broadcast(slots), slot).select(*[F.col(f"`{c}`") for c in df.columns], slot, shard)


def write_shards(df: DataFrame, key: str, shards: list[str], path: str, size: int = 10_007,
                 files_per_shard: int = 8) -> None:
    """Write ``df`` as Parquet, one folder ``_shard=<place>`` a shard; slots are dealt to
    ``files_per_shard`` files, so that a shard is not one task."""
    slot, shard = free_name("_slot", df.columns), free_name("_shard", df.columns)
    part = free_name("_part", df.columns)
    placed = place(df, key, shards, size, slot, shard).withColumn(part, F.col(slot) % files_per_shard)
    (placed.repartition(len(shards) * files_per_shard, shard, part).drop(slot, part)
     .write.partitionBy(shard).parquet(path))
