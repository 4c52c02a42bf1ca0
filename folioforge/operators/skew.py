"""Joins, rankings and numberings that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SALTS = 16
HOT_KEYS = 1000
SALT_ROWS = 1_000_000


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: list[str],
    spread_by: str,
    how: str = "inner",
    condition: Column | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join many rows with a much smaller lookup side, the rows of a hot key in ``salts`` tasks.

    The lookup side is repeated once per salt, so every match is found exactly once.  If
    it turns out small enough, adaptive execution broadcasts it and nothing is shuffled.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    if condition is None:
        return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
    left, right = salted.alias("rows"), repeated.alias("lookup")
    equal = condition
    for name in [*on, "_salt"]:
        equal = equal & (F.col(f"rows.{name}") == F.col(f"lookup.{name}"))
    return left.join(right, equal, how)


def hot_join(
    rows: DataFrame, lookup: DataFrame, key: str, spread_by: str, counts: DataFrame
) -> DataFrame:
    """Inner join of two large sides, of which ``rows`` may have hot keys.

    ``counts`` holds the number ``n`` of rows per key.  A key is hot if it owns one in
    ``HOT_KEYS`` rows, so the broadcast list of hot keys is no longer than that.  Only hot
    keys are salted, into one part per ``SALT_ROWS`` rows; the lookup side is repeated for
    them alone.
    """
    total = counts.agg(F.sum("n")).scalar()
    salts = F.greatest(F.lit(SALTS), F.ceil(F.col("n") / SALT_ROWS)).cast("int")
    hot = F.broadcast(
        counts.where(F.col("n") * HOT_KEYS >= total).select(key, salts.alias("_salts"))
    )
    salt = F.pmod(F.xxhash64(spread_by), F.coalesce("_salts", F.lit(1))).cast("int")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted = rows.join(hot, key, "left").withColumn("_salt", salt).drop("_salts")
    repeated = lookup.join(hot, key, "left").withColumn("_salt", F.explode(every)).drop("_salts")
    return salted.join(repeated, [key, "_salt"]).drop("_salt")


def top_per_group(
    df: DataFrame, group: str, order: list[Column], limit: int, spread_by: str, salts: int = SALTS
) -> DataFrame:
    """The first ``limit`` rows of every group with their ``rank``.

    Ranked within (group, salt) first, so that the task that ranks a whole group receives
    at most ``salts * limit`` rows of it.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts))
    part = Window.partitionBy(group, "_salt").orderBy(*order)
    whole = Window.partitionBy(group).orderBy(*order)
    return (
        df.withColumn("_salt", salt)
        .withColumn("rank", F.row_number().over(part))
        .where(F.col("rank") <= limit)
        .withColumn("rank", F.row_number().over(whole))
        .where(F.col("rank") <= limit)
        .drop("_salt")
    )


def number_rows(
    df: DataFrame, order: list[Column], name: str, group: str | None = None, start: int = 0
) -> DataFrame:
    """Add consecutive numbers in the given order, per ``group`` or over the whole table.

    ``df`` is written once first, as range partitioning reads its input twice to sample it.
    The rows are range-partitioned and sorted, each takes its place within its partition,
    and the partitions are shifted by the number of rows before them.  No task sees more
    than its own range, even if one group holds most of the rows.  ``order`` must be total
    within the group.
    """
    keys = [F.col(group)] if group else []
    df = materialize(df, "unnumbered")
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    # The generated id is (partition << 33) + place in the partition.
    placed = materialize(ranged.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    by = [group] if group else []
    sizes = placed.groupBy("_part", *by).agg(
        F.count("*").alias("_rows"), F.min("_place").alias("_first")
    )
    # One row per partition (and per group in it): a group's rows are a contiguous range.
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "_part", *by, "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"),
    )
    number = (F.col("_place") - F.col("_first") + F.col("_shift") + start).alias(name)
    return salted_join(placed, shifts, ["_part", *by], "_place").select(*df.columns, number)
