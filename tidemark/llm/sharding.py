"""Sharding (operator 10): a permutation-filled lookup table.

Every shard has a preference order of the table's slots, the permutation
``(offset + j * skip) mod size`` of a prime size. Shards take turns; in its
turn a shard claims the first slot of its order that is free, until all are
taken. A key's slot is its hash modulo the size, so the broadcast table (of
fixed size) places any row in constant time, shards differ by at most one slot,
and when a shard goes few keys move beside its own.

Defined results: a null key hashes as the empty string; equal keys share a
shard, whatever else their rows hold; an empty table gives an empty result;
``place`` keeps all columns, under new names of its own; shard names must be
distinct and not more than the slots.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _number(text: str) -> int:
    """60-bit hash, the same in SQL: the first 15 hex digits of MD5."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], size: int) -> np.ndarray:
    """Index of the shard that owns each slot."""
    if not is_prime(size):
        raise ValueError(f"{size} isn't prime")
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct, and from one to the number of slots")
    offset = [_number(f"offset:{s}") % size for s in shards]
    skip = [_number(f"skip:{s}") % (size - 1) + 1 for s in shards]
    table = np.full(size, -1, np.int32)
    at = list(offset)
    taken = 0
    while taken < size:
        for k in range(len(shards)):
            while table[at[k]] >= 0:
                at[k] = (at[k] + skip[k]) % size
            table[at[k]] = k
            taken += 1
            if taken == size:
                break
    return table


def key_slot(key: Column, size: int) -> Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(size)).cast("int")


def place(rows: DataFrame, key: str, shards: list[str], size: int = 65537, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """rows with the slot and the shard of their key."""
    table = lookup_table(shards, size).tolist()
    spark = rows.sparkSession
    # one row for each slot: a bound that doesn't grow with the data
    slots = spark.createDataFrame([(i, shards[k]) for i, k in enumerate(table)], "_slot int, _shard string")
    found = rows.select(*(rows[c] for c in rows.columns if c not in (slot, shard)), key_slot(rows[key], size).alias(slot))
    return found.join(F.broadcast(slots), found[slot] == slots["_slot"]).drop("_slot").withColumnRenamed("_shard", shard)


def write_shards(rows: DataFrame, key: str, shards: list[str], path: str, size: int = 65537, files_per_shard: int = 1) -> None:
    """Writes rows below ``path``, a folder for each shard. A shard's rows are
    dealt to ``files_per_shard`` tasks by their whole content, so that one key
    that holds very many rows isn't written by one task."""
    placed = place(rows, key, shards, size)
    spread = F.pmod(F.xxhash64(F.to_json(F.struct(*placed.columns))), F.lit(files_per_shard))
    placed.repartition(len(shards) * files_per_shard, "shard", spread).write.mode("overwrite").partitionBy("shard").parquet(path)
