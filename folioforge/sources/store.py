"""Tables addressed by document id, and tables that are built once."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .tables import input_bytes

#: Buckets of a new store: one for each ``BUCKET_BYTES`` of input, within these bounds.
MIN_BUCKETS, MAX_BUCKETS = 64, 16_384
BUCKET_BYTES = 256 << 20
#: Input of one writing task.
TASK_BYTES = 512 << 20
#: Ids written into the scan itself, and ids that may be broadcast, 8 to 16 bytes each.
PUSHED_IDS = 500
BROADCAST_IDS = 1_000_000

ROW, KEY = "store_row", "store_key"


def latest_by_id(writes: DataFrame, key: str = "id", order: str | None = "seq") -> DataFrame:
    """The last write of every id; of equal ``order`` the row that comes last in the input.

    Without an ``order`` the place in the input alone decides.  Only ids, orders and row numbers
    are aggregated, combined per task, so an id written very often shrinks before anything is
    shuffled; the documents join the rows that are left.
    """
    numbered = materialize(writes.withColumn(ROW, F.monotonically_increasing_id()), "writes")
    rank = F.max(F.struct(*([F.col(order)] if order else []), ROW)).alias("last")
    last = numbered.groupBy(key).agg(rank).select(F.col(f"last.{ROW}").alias(ROW))
    kept = numbered.join(last, ROW, "left_semi").drop(ROW)
    return kept.drop(order) if order else kept


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on any file system the session can reach."""
    where, files = _file_system(spark, path)
    return files.exists(where)


# --- keyed store -----------------------------------------------------------------------
#
# A Parquet table partitioned by bucket of the documents' ids.  Writes replace whole buckets by
# Spark's dynamic partition overwrite.  Inside a bucket rows are sorted by id, and the id has
# bloom filters, so a lookup opens few buckets and skips most row groups of those.

BUCKET, BUCKETS = "store_bucket", "store_buckets"


def key_bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def stored_buckets(spark: SparkSession, path: str) -> int | None:
    """The bucket count of the store at ``path``, which its folders are named by."""
    where, files = _file_system(spark, path)
    if not files.exists(where):
        return None
    names = [str(entry.getPath().getName()) for entry in files.listStatus(where)]
    return next((int(n.split("=")[1]) for n in names if n.startswith(BUCKETS + "=")), None)


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """All documents of a store and their bucket; documents may differ in columns."""
    if stored_buckets(spark, path) is None:
        raise ValueError(f"nothing is stored at {path}")
    return spark.read.option("mergeSchema", "true").parquet(path).drop(BUCKETS)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """All documents of a store."""
    return open_store(spark, path).drop(BUCKET)


def write_buckets(
    docs: DataFrame, path: str, key: str, buckets: int, size: int = 0, mode: str = "overwrite"
) -> None:
    """Write documents to their buckets; ``overwrite`` replaces the buckets that they have.

    A bucket is written by one task for each ``TASK_BYTES`` of its share of ``size``.
    """
    slices = max(1, -(-size // (buckets * TASK_BYTES)))
    place = F.pmod(F.xxhash64(F.lit("slice"), F.col(key)), F.lit(slices))
    (
        docs.withColumn(BUCKETS, F.lit(buckets))
        .withColumn(BUCKET, key_bucket(key, buckets))
        .repartition(BUCKET, place)
        .sortWithinPartitions(BUCKET, key)
        .write.partitionBy(BUCKETS, BUCKET)
        .option("compression", "zstd")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("partitionOverwriteMode", "dynamic")
        .mode(mode)
        .parquet(path)
    )


def bucket_count(size: int) -> int:
    """Buckets of a new store for ``size`` bytes of input."""
    return min(MAX_BUCKETS, max(MIN_BUCKETS, size // BUCKET_BYTES))


def upsert(docs: DataFrame, path: str, key: str = "id", buckets: int | None = None) -> None:
    """Write documents to the store at ``path``; each replaces the one stored under its id.

    Only the buckets that the new ids fall into are read and written anew.  Of several new
    documents with one id the last in the input is stored; null ids are one id.  The bucket
    count of an existing store is its own; that of a new one follows from the input's size.
    """
    spark = docs.sparkSession
    size = input_bytes(docs)
    stored = stored_buckets(spark, path)
    buckets = stored or buckets or bucket_count(size)
    new = latest_by_id(docs, key, None)
    if stored:
        ids = materialize(
            new.select(F.col(key).alias(KEY), key_bucket(key, buckets).alias(BUCKET)), "new-ids")
        touched = [r[0] for r in ids.select(BUCKET).distinct().collect()]  # at most all buckets
        kept = open_store(spark, path).where(F.col(BUCKET).isin(touched)).drop(BUCKET).join(
            ids.select(KEY), F.col(key).eqNullSafe(F.col(KEY)), "left_anti")
        new = new.unionByName(kept, allowMissingColumns=True)
    write_buckets(new, path, key, buckets, size)


def pushed_ids(stored: DataFrame, key: str, ids: DataFrame, buckets: int) -> DataFrame:
    """The rows of ``stored`` whose ids are among those of ``ids``, one column of unique ids.

    A few ids go into the scan, where folders, row groups and bloom filters are tested; more are
    broadcast, and very many are joined.  The documents are never moved for fewer.
    """
    (name,) = ids.columns
    few = [r[0] for r in ids.limit(PUSHED_IDS + 1).collect()]
    if len(few) <= PUSHED_IDS:
        places = {r[0] for r in ids.select(key_bucket(name, buckets)).collect()}
        return stored.where(F.col(BUCKET).isin(sorted(places)) & F.col(key).isin(sorted(few)))
    wanted = ids.select(F.col(name).alias(KEY), key_bucket(name, buckets).alias("of_bucket"))
    if ids.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    same = (F.col(key) == F.col(KEY)) & (F.col(BUCKET) == F.col("of_bucket"))
    return stored.join(wanted, same, "left_semi")


def lookup(spark: SparkSession, path: str, ids: DataFrame, key: str = "id") -> DataFrame:
    """The stored documents with the ids in the one column of ``ids``; a null id finds none."""
    (name,) = ids.columns
    wanted = materialize(ids.where(F.col(name).isNotNull()).distinct(), "asked-ids")
    found = pushed_ids(open_store(spark, path), key, wanted, stored_buckets(spark, path))
    return found.drop(BUCKET)


# --- tables that are built once --------------------------------------------------------


def publish_once(spark: SparkSession, path: str, build: Callable[[str], None]) -> bool:
    """Whether this call made the folder ``path``, whole, by ``build`` writing to a folder aside.

    The folder aside gets the name ``path`` in one step, which fails if another builder was
    faster; then its folder stays and this one is removed.  So ``path`` is whole if it is there.
    """
    if path_exists(spark, path):
        return False
    aside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    build(aside)
    jvm = spark._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(aside), jvm.org.apache.hadoop.fs.Path(path)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration())
    never_replace = spark._sc._gateway.new_array(
        jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(source, target, never_replace)
    except Py4JJavaError:
        if not path_exists(spark, path):
            raise
        files.delete(source, True)
        return False
    return True


def build_if_absent(
    spark: SparkSession, path: str, build: Callable[[], DataFrame]
) -> tuple[DataFrame, bool]:
    """The table at ``path`` and whether this call built it; an existing one is reused."""
    new = publish_once(
        spark, path, lambda aside: build().write.option("compression", "zstd").parquet(aside))
    return spark.read.parquet(path), new
