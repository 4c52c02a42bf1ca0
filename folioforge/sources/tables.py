"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Input of one task of costly narrow work.
TASK_BYTES = 16 << 20


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input of a few splits, such as one parquet row group.

    The narrow work downstream (regular expressions, sorting of words) is far more
    expensive than moving the rows once.  A large input makes a task for each
    ``TASK_BYTES``, however large its row groups are; inputs with that many splits are
    returned as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-input_bytes(df) // TASK_BYTES))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# Spark's estimate where it knows nothing is about this or more.
UNKNOWN_BYTES = 1 << 60


def input_bytes(df: DataFrame) -> int:
    """Size of the files ``df`` reads; inputs of unknown size count as empty."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(size for size in sizes if size < UNKNOWN_BYTES)
