"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a prime-sized table:
(offset + j * skip) modulo the size visits each slot once, since the size is prime.
Shards take turns, and in its turn a shard claims the first slot of its order that
is free, until the table is full. A key's slot is its hash modulo the size, so a
key is placed by one lookup. The sizes of two shards' shares differ by a slot at
most, and when a shard leaves, few keys of the others move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots of the table: a prime, a hundred times the number of shards or more.
SLOTS = 65537
#: Fixed salts of the two hashes that make a shard's order, and of the keys' hash.
OFFSET_SALT, SKIP_SALT, KEY_SALT = "offset", "skip", "key"


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The table: for each slot the number of its shard."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names, one at least")
    if not _is_prime(slots) or slots < len(shards):
        raise ValueError("slots must be a prime, not less than the number of shards")
    nexts = [_number(f"{OFFSET_SALT}:{s}") % slots for s in shards]
    skips = [_number(f"{SKIP_SALT}:{s}") % (slots - 1) + 1 for s in shards]
    table, free = [-1] * slots, slots
    while True:
        for shard, skip in enumerate(skips):
            at = nexts[shard]
            while table[at] >= 0:
                at = (at + skip) % slots
            table[at] = shard
            nexts[shard] = (at + skip) % slots
            free -= 1
            if not free:
                return table


def slot(key: Column | str, slots: int = SLOTS) -> Column:
    """A key's slot; null keys share the slot of the empty string."""
    text = F.concat(F.lit(f"{KEY_SALT}:"), F.coalesce(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint") % slots).cast("int")


def table_frame(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    rows = [(i, shards[s]) for i, s in enumerate(fill(shards, slots))]
    return spark.createDataFrame(rows, "_slot int, _shard string")


def assign(docs: DataFrame, shards: Sequence[str], key: str = "doc_id", slots: int = SLOTS, into: str = "shard") -> DataFrame:
    """The rows with one more column, the name of the shard each goes to.

    The table is broadcast: it has `slots` rows, however many documents there are.
    Equal keys go to one shard; null keys go together. Rows are neither dropped nor
    repeated. A column named like `into` is replaced.
    """
    table = F.broadcast(table_frame(docs.sparkSession, shards, slots))
    # the row travels as one value, so that none of its columns can clash with ours
    placed = docs.drop(into) if into != key else docs
    placed = placed.select(F.struct("*").alias("_row"), slot(F.col(key), slots).alias("_slot_of_key"))
    rest = placed.join(table, F.col("_slot_of_key") == F.col("_slot"))
    return rest.select("_row.*", F.col("_shard").alias(into))


def write_shards(docs: DataFrame, path: str, shards: Sequence[str], key: str = "doc_id", slots: int = SLOTS) -> None:
    """Write the rows as Parquet, one folder for each shard; large shards get several files."""
    placed = assign(docs, shards, key, slots)
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
