"""A fielded index that takes new and rewritten documents between searches.

Its tables only grow: an update appends its rows under a number of its own, a segment, and a row
in the table of segments, written last, makes them count.  Searches see whole updates or none;
rows of an update that was interrupted are never seen.

* ``postings``: the terms of the documents of each segment, by term bucket.
* ``gone``: documents that a segment rewrote; their postings of earlier segments are dead.
* ``dictionary`` and ``stats``: how much each segment changes the counts.  The terms of a document
  that is rewritten are taken off, so sums over segments are the counts of the live documents.
* ``versions``: the documents themselves, by bucket of their id, from which those terms come.

Compaction rewrites folders in place by dynamic partition overwrite, each with the same content:
live rows under the last segment's number.  One update or compaction runs at a time; documents
without an id are left out.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources import store
from ..sources.tables import input_bytes
from . import index

SEGMENTS = "segment bigint, term_buckets int"
GONE = "doc_id string, segment bigint"
POSTINGS = f"{index.FIELD_POSTING}, segment bigint, bucket int"
DICTIONARY = index.FIELDED["dictionary"].replace("bucket int", "segment bigint, bucket int")
STATS = index.FIELDED["stats"] + ", segment bigint"
DOCUMENT = ["id", "title", "type", "fields"]
#: Segments that are written into a scan; more are joined.
PUSHED_SEGMENTS = 500


class _Tables:
    """The tables of a live index, cut down to the segments that count."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        rows = []
        if store.path_exists(spark, f"{path}/segments"):
            rows = spark.read.schema(SEGMENTS).parquet(f"{path}/segments").collect()
        self.numbers = sorted(r.segment for r in rows)
        self.last = max(self.numbers, default=0)
        self.term_buckets = rows[0].term_buckets if rows else None

    def read(self, name: str, schema: str) -> DataFrame:
        return self.counting(self.spark.read.schema(schema).parquet(f"{self.path}/{name}"))

    def counting(self, df: DataFrame) -> DataFrame:
        if len(self.numbers) <= PUSHED_SEGMENTS:
            return df.where(F.col("segment").isin(self.numbers))
        known = self.spark.createDataFrame([(n,) for n in self.numbers], "segment bigint")
        return df.join(known, "segment", "left_semi")

    def postings(self) -> DataFrame:
        """Those of live documents, with their segment."""
        gone = self.read("gone", GONE).groupBy(F.col("doc_id").alias("gone_id")).agg(
            F.max("segment").alias("until"))
        dead = (F.col("doc_id") == F.col("gone_id")) & (F.col("segment") < F.col("until"))
        return self.read("postings", POSTINGS).join(gone, dead, "left_anti")

    def dictionary(self) -> DataFrame:
        counts = self.read("dictionary", DICTIONARY).groupBy("bucket", "field", "term")
        return counts.agg(F.sum("df").alias("df")).where(F.col("df") > 0)

    def stats(self) -> DataFrame:
        counts = self.read("stats", STATS).groupBy("field").agg(
            F.sum("n_docs").alias("n_docs"), F.sum("total_len").alias("total_len"))
        return counts.where(F.col("n_docs") > 0)

    def versions(self) -> DataFrame:
        return self.counting(store.open_store(self.spark, f"{self.path}/versions"))


def _latest(versions: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct(*DOCUMENT[1:]), "segment").alias("newest")
    return versions.groupBy("id").agg(newest).select("id", "newest.*")


def current_documents(spark: SparkSession, path: str, ids: DataFrame | None = None) -> DataFrame:
    """The documents of a live index, or those with the ids in the one column of ``ids``."""
    tables = _Tables(spark, path)
    found = tables.versions()
    if ids is not None:
        buckets = store.stored_buckets(spark, f"{path}/versions")
        found = store.pushed_ids(found, "id", ids, buckets)
    return _latest(found)


def _changes(added: DataFrame, removed: DataFrame, segment: int, buckets: int, path: str) -> None:
    """Append what a segment changes in the counts of terms and fields."""
    signed = added.withColumn("sign", F.lit(1)).unionByName(removed.withColumn("sign", F.lit(-1)))
    number = F.lit(segment).cast("bigint").alias("segment")
    terms = signed.groupBy("field", "term").agg(F.sum("sign").cast("bigint").alias("df"))
    terms = terms.where("df != 0").select(
        "field", "term", "df", number, index.term_bucket(buckets).alias("bucket"))
    terms.repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy(
        "bucket").mode("append").option("compression", "zstd").parquet(f"{path}/dictionary")
    fields = signed.where("leads").groupBy("field").agg(
        F.sum("sign").cast("bigint").alias("n_docs"),
        F.sum(F.col("sign") * F.col("field_len")).cast("bigint").alias("total_len"))
    fields.select("*", number).coalesce(1).write.mode("append").parquet(f"{path}/stats")


def upsert(docs: DataFrame, path: str) -> None:
    """Add (id, title, type, fields) documents; each replaces the one indexed under its id.

    Of several documents with one id the last in the input counts.  Work and shuffles grow with
    the update, not with the index, which is not rewritten.
    """
    spark = docs.sparkSession
    tables = _Tables(spark, path)
    size = input_bytes(docs)
    buckets = tables.term_buckets or index.bucket_count(docs)
    # Larger than any before, interrupted ones included.
    segment = max(tables.last + 1, time.time_ns() // 1_000_000)
    number = F.lit(segment).cast("bigint")
    new = materialize(
        store.latest_by_id(docs.select(DOCUMENT).where("id is not null"), "id", None), "new-documents")
    ids = new.select("id")
    added = materialize(index.field_postings(new), "new-postings")
    if tables.numbers:
        old = materialize(current_documents(spark, path, ids), "old-documents")
        id_buckets = store.stored_buckets(spark, f"{path}/versions")
    else:
        old, id_buckets = new.limit(0), store.bucket_count(size)
    removed = index.field_postings(old)
    index.append_postings(added.withColumn("segment", number), f"{path}/postings", buckets)
    _changes(added, removed, segment, buckets, path)
    old.select(F.col("id").alias("doc_id"), number.alias("segment")).write.mode("append").parquet(
        f"{path}/gone")
    store.write_buckets(
        new.withColumn("segment", number), f"{path}/versions", "id", id_buckets, size, "append")
    # Written last: from here on the segment counts.
    done = spark.createDataFrame([(segment, buckets)], SEGMENTS)
    done.coalesce(1).write.mode("append").parquet(f"{path}/segments")


def open_live(spark: SparkSession, path: str) -> index.Index:
    """The index as all updates so far left it."""
    tables = _Tables(spark, path)
    if not tables.numbers:
        raise ValueError(f"nothing is indexed at {path}")
    return index.Index(
        tables.postings(), tables.dictionary(), tables.stats(), buckets=tables.term_buckets)


def compact(spark: SparkSession, path: str) -> None:
    """Drop dead postings and old versions, and sum up the counts of terms, folder by folder."""
    tables = _Tables(spark, path)
    number = F.lit(tables.last).cast("bigint")

    def rewrite(df: DataFrame, name: str, order: list[str], place: Column) -> None:
        df.withColumn("segment", number).repartition("bucket", place).sortWithinPartitions(
            "bucket", *order).write.partitionBy("bucket").option("compression", "zstd").option(
            "partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{path}/{name}")

    postings = tables.postings()
    slices = index.slice_count(input_bytes(postings), tables.term_buckets)
    rewrite(postings, "postings", ["term", "doc_id"],
            F.pmod(F.xxhash64("doc_id"), F.lit(slices)))
    rewrite(tables.dictionary(), "dictionary", ["term"], F.lit(0))
    buckets = store.stored_buckets(spark, f"{path}/versions")
    versions = tables.versions()
    store.write_buckets(_latest(versions).withColumn("segment", number), f"{path}/versions", "id",
                        buckets, input_bytes(versions))
    # A folder without any live row is not replaced; its dead rows must stay marked.
    if tables.read("postings", POSTINGS).where(F.col("segment") < tables.last).isEmpty():
        spark.createDataFrame([], GONE).write.mode("overwrite").parquet(f"{path}/gone")
