"""Sharding by a permutation-filled lookup table (operator 7); DataFrame functions only.

The table has a prime number of slots. Every shard prefers the slots in its own
order (offset + j * skip modulo the prime, from its name's hash), and the shards
take turns, each claiming its first free slot, until the table is full. A key
hashes to a slot and so to a shard: slots differ by one at most between shards,
and a changed shard list moves few keys. The table's size is a parameter, never
the data's, so it is part of the plan as a constant and placement is one lookup.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 4099    # prime
SHARDS = tuple(f"shard-{i:02d}" for i in range(32))
_HEX = 13       # hex digits of an MD5 taken as a number: 52 bits


def _number(text: str) -> int:
    return int(md5(text.encode()).hexdigest()[:_HEX], 16)


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """Slot -> position in ``shards``. Needs a prime number of slots, no fewer than shards, and distinct names."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and distinct")
    if slots < max(2, len(shards)) or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("slots must be a prime no smaller than the number of shards")
    at = [_number("offset:" + s) % slots for s in shards]
    skip = [_number("skip:" + s) % (slots - 1) + 1 for s in shards]
    table = [-1] * slots
    for turn in range(slots):
        i = turn % len(shards)
        while table[at[i]] >= 0:
            at[i] = (at[i] + skip[i]) % slots
        table[at[i]] = i
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key (null: the empty text's slot)."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, _HEX), 16, 10).cast("long"), F.lit(slots)).cast("int")


def assign(df: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS,
           slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``df`` with its slot and shard; no shuffle, and all rows and other columns stay.

    Equal keys share a shard; a null key goes where the empty text goes. Columns
    already named ``slot_col`` or ``shard_col`` are refused. Empty tables are fine.
    """
    taken = {c.lower() for c in df.columns} & {slot_col.lower(), shard_col.lower()}
    if taken:
        raise ValueError(f"columns already there: {sorted(taken)}")
    names = F.split(F.lit("\x1f".join(shards)), "\x1f")
    table = F.split(F.lit(",".join(map(str, lookup_table(shards, slots)))), ",").cast("array<int>")
    return (df.withColumn(slot_col, slot_of(F.col(key), slots))
            .withColumn(shard_col, F.get(names, F.get(table, F.col(slot_col)))))


def write_shards(df: DataFrame, path: str, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS,
                 files_per_shard: int = 1) -> None:
    """One folder per shard under ``path``. One shuffle; rows are dealt by (shard, hash of the whole row's key,
    salted), so that a key with a large part of all rows is spread over a shard's files."""
    placed = assign(df, key, shards, slots, "__slot", "__shard").drop("__slot")
    salt = F.pmod(F.xxhash64(*(c for c in df.columns)), F.lit(files_per_shard)) if files_per_shard > 1 else F.lit(0)
    (placed.withColumn("__salt", salt).repartition("__shard", "__salt").drop("__salt")
     .withColumnRenamed("__shard", "shard").write.mode("errorifexists").partitionBy("shard").parquet(path))


def shard_balance(df: DataFrame, shard_col: str = "shard", size: Column | None = None) -> DataFrame:
    """Rows and size of each shard that has rows."""
    return df.groupBy(shard_col).agg(F.count("*").alias("rows"),
                                     F.sum(size if size is not None else F.lit(1)).cast("long").alias("size"))
