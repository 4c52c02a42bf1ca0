"""Placement of rows in shards by a permutation-filled lookup table.

Each shard has its own order of preference over a table of prime size; the shards take turns,
each claiming its most preferred slot that is still free.  Shares are equal to within one
slot, and adding or removing a shard moves little else.  A row's slot is a hash of its key; the
table has a fixed size and goes to all tasks.

A key that owns more than half a shard's fair share of all rows is split into pieces that are
placed on their own.  Null keys are a key like any other.  Repeated rows are all placed; an
empty table gives none.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65537
SHARDS = 64


def permutation(shard: str, slots: int) -> tuple[int, int]:
    """First slot and step of the shard's order of preference."""
    digest = hashlib.sha256(shard.encode()).digest()
    offset = int.from_bytes(digest[:8], "big") % slots
    return offset, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The number of the shard that owns each slot; ``slots`` is a prime above their number."""
    orders = [permutation(name, slots) for name in shards]
    turns = [0] * len(shards)
    owner = [-1] * slots
    free = slots
    while True:
        for i, (offset, step) in enumerate(orders):
            while owner[slot := (offset + turns[i] * step) % slots] >= 0:
                turns[i] += 1
            owner[slot] = i
            turns[i] += 1
            free -= 1
            if not free:
                return owner


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    rows = list(enumerate(lookup_table(shards, slots)))
    return spark.createDataFrame(rows, "slot int, shard int")


def assign(
    df: DataFrame, keys: list[str], shards: list[str] | None = None, slots: int = SLOTS
) -> DataFrame:
    """``df`` with ``slot``, ``shard`` and ``piece`` (0 but for split keys).

    Columns of these names are replaced.
    """
    shards = shards or [f"shard-{i:04d}" for i in range(SHARDS)]
    most = 2 * len(shards)  # no more keys than that can own so large a part of the rows
    df = df.drop("slot", "shard", "piece")
    key = F.xxhash64(*keys)
    home = F.pmod(key, F.lit(slots)).cast("int")
    # Counts per slot are combined in the tasks: at most a table's worth of rows per task.
    per_slot = df.groupBy(home.alias("at")).agg(F.count("*").alias("n"))
    total = per_slot.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    limit = max(1, total // most)
    full = [r.at for r in per_slot.where(F.col("n") > limit).collect()]  # at most ``most``
    piece = F.lit(0)
    if full:
        # Only keys in overfull slots are counted one by one.
        hot = (
            df.where(home.isin(full)).groupBy(key.alias("key")).agg(F.count("*").alias("n"))
            .where(F.col("n") > limit).collect()
        )
        for row in hot:
            parts = 4 * -(-row.n // limit)  # small enough for the shards to stay even
            spread = F.pmod(F.xxhash64(*df.columns, F.monotonically_increasing_id()), F.lit(parts))
            piece = F.when(key == row.key, spread.cast("int")).otherwise(piece)
    placed = df.withColumn("piece", piece)
    slot = F.when(F.col("piece") == 0, home).otherwise(
        F.pmod(F.xxhash64(*keys, "piece"), F.lit(slots)).cast("int"))
    # The table has a fixed number of slots.
    lookup = F.broadcast(table_frame(df.sparkSession, shards, slots))
    return placed.withColumn("slot", slot).join(lookup, "slot").select(
        *df.columns, "slot", "shard", "piece")
