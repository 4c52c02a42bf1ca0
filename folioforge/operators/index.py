"""Inverted indexes: positional over whole documents, and per field.

Postings come out of each document's own row without a shuffle; only the counts per term
are shuffled, combined per task first.  A built index is a folder of tables that searches
read, so the texts are analysed once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.terms import field_terms, positioned_terms, term_runs
from ..sources.documents_json import KEY_FIELDS, flat_names
from ..sources.tables import input_bytes
from .skew import hot_join, salted_join

BUCKETS, MAX_BUCKETS = 16, 4096
BUCKET_BYTES = 1 << 30
# Input per block of documents, and the fewest blocks.
BLOCK_BYTES = 1 << 20
BLOCKS = 64
# Input of one writing task; its postings take about ten times as much while they are sorted.
TASK_BYTES = 16 << 20
LOG_BASE = 10.0


def with_index_text(docs: DataFrame, separator: str = "") -> DataFrame:
    """(doc_id, text) to index: title and text glued together.

    The default glues the last word of the title to the first of the text, which is what
    existing extracts were indexed with; pass a space to keep them apart.
    """
    whole = F.concat(F.col("title"), F.lit(separator), F.col("text"))
    return docs.select("doc_id", whole.alias("text"))


def index_tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, term, pos): one row per accepted word."""
    return docs.select("doc_id", F.inline(positioned_terms(F.col("text"))))


def index_postings(docs: DataFrame) -> DataFrame:
    """(doc_id, term, tf, pos_list): one row per term of a document; doc_id is unique."""
    return docs.select("doc_id", F.inline(term_runs(positioned_terms(F.col("text")))))


def document_frequencies(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term").agg(F.count("*").alias("df"))


# Okapi BM25 with its usual constants.
K1 = 1.2
B = 0.75


def bm25(tf: Column, length: Column, mean_length: Column) -> Column:
    """What a term's count adds to a field's score, before its weight."""
    return tf / (tf + K1 * ((1 - B) + B * length / mean_length))


def idf(n_docs: Column, df: Column) -> Column:
    return F.greatest(F.log(LOG_BASE, n_docs / df), F.lit(0.0))


def tfidf_weights(postings: DataFrame, dictionary: DataFrame, n_docs: Column) -> DataFrame:
    """(doc_id, term, tf_idf) for every posting.

    Both sides are large, and a common term has a row per document.
    """
    weighted = dictionary.select("term", idf(n_docs, F.col("df")).alias("idf"))
    counts = dictionary.select("term", F.col("df").alias("n"))
    rows = postings.select("doc_id", "term", "tf")
    return hot_join(rows, weighted, "term", "doc_id", counts).select(
        "doc_id", "term", (F.col("tf") * F.col("idf")).alias("tf_idf")
    )


def field_values(docs: DataFrame) -> DataFrame:
    """(doc_id, field, value) of documents, key columns included.

    A field named like a key column is found as ``=title`` and by searches of all fields.
    """
    keys = F.create_map(*(part for k in KEY_FIELDS for part in (F.lit(k), F.col(k))))
    own = flat_names(F.col("fields"))
    return docs.select(
        F.col("id").alias("doc_id"), F.explode(F.map_concat(keys, own)).alias("field", "value")
    )


def field_postings(docs: DataFrame) -> DataFrame:
    """(doc_id, field, term, tf, field_len, leads): one row per term of a field of a document.

    ``leads`` marks the first of them, so that fields can be counted without a distinct.
    """
    terms = field_values(docs).select(
        "doc_id", "field", field_terms(F.col("value")).alias("terms")
    )
    return terms.select(
        "doc_id", "field", F.size("terms").cast("bigint").alias("field_len"),
        F.posexplode(term_runs(F.col("terms"))).alias("place", "run"),
    ).select(
        "doc_id", "field", "run.term", "run.tf", "field_len", (F.col("place") == 0).alias("leads")
    )


def field_statistics(postings: DataFrame) -> DataFrame:
    """(field, n_docs, total_len): how many documents have words in a field, and how many."""
    return postings.where("leads").groupBy("field").agg(
        F.count("*").alias("n_docs"), F.sum("field_len").alias("total_len")
    )


@dataclass(frozen=True)
class Index:
    """Tables of a built index; ``blocks`` bounds what postings of a term add to a score."""

    postings: DataFrame
    dictionary: DataFrame
    stats: DataFrame
    buckets: int
    blocks: DataFrame | None = None


def term_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")


def bucket_count(df: DataFrame) -> int:
    """Term buckets for an index of ``df``: one per ``BUCKET_BYTES`` of input, within bounds."""
    return min(MAX_BUCKETS, max(BUCKETS, input_bytes(df) // BUCKET_BYTES))


def slice_count(size: int, buckets: int) -> int:
    """Document slices per bucket, so that ``size`` bytes make tasks of ``TASK_BYTES``."""
    return max(1, -(-size // (buckets * TASK_BYTES)))


def append_postings(
    postings: DataFrame, path: str, buckets: int, order: tuple[str, ...] = ("doc_id",)
) -> None:
    """Add postings in folders by term bucket, sorted by term and ``order`` inside each file.

    Every (bucket, document slice) is one writing task, and the number of slices follows from
    the size of the input, so a term that owns a third of the postings is written by as many
    tasks as there are slices.
    """
    slices = slice_count(input_bytes(postings), buckets)
    out = postings.withColumn("bucket", term_bucket(buckets))
    place = F.col("bucket") * slices + F.pmod(F.xxhash64("doc_id"), F.lit(slices)).cast("int")
    (
        out.repartitionById(buckets * slices, place)
        .sortWithinPartitions("bucket", "term", *order)
        .write.partitionBy("bucket")
        .option("compression", "zstd")
        .mode("append")
        .parquet(path)
    )


def _write_dictionary(counted: DataFrame, path: str) -> None:
    """Counts per term in folders by term bucket, sorted by term inside each file."""
    counted.repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy(
        "bucket").option("compression", "zstd").mode("overwrite").parquet(path)


def _write_layout(spark: SparkSession, path: str, buckets: int) -> None:
    layout = spark.createDataFrame([(buckets,)], LAYOUT)
    layout.coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")


def build_index(docs: DataFrame, path: str, buckets: int | None = None) -> None:
    """Write the positional index of (doc_id, text) documents to a new folder."""
    spark = docs.sparkSession
    buckets = buckets or bucket_count(docs)
    _write_layout(spark, path, buckets)
    append_postings(index_postings(docs), f"{path}/postings", buckets)
    written = spark.read.schema(POSITIONAL["postings"]).parquet(f"{path}/postings")
    counted = written.groupBy("bucket", "term").agg(F.count("*").alias("df"))
    _write_dictionary(counted, f"{path}/dictionary")
    # Written last: its presence marks the index as complete.
    docs.agg(F.count("*").alias("n_docs")).write.mode("overwrite").parquet(f"{path}/stats")


def build_field_index(
    docs: DataFrame, path: str, buckets: int | None = None, blocks: int | None = None
) -> None:
    """Write the fielded index of (id, title, type, fields) documents to a new folder.

    Documents fall into ``blocks``.  The postings of a term are sorted by them, and a directory
    holds for every term, field and block what bounds the score of its documents.
    """
    spark = docs.sparkSession
    buckets = buckets or bucket_count(docs)
    blocks = blocks or max(BLOCKS, input_bytes(docs) // BLOCK_BYTES)
    _write_layout(spark, path, buckets)
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")
    append_postings(field_postings(docs).withColumn("block", block), f"{path}/postings", buckets,
                    ("field", "block", "doc_id"))
    written = spark.read.schema(FIELDED["postings"]).parquet(f"{path}/postings")
    field_statistics(written).write.parquet(f"{path}/stats")
    stats = spark.read.schema(FIELDED["stats"]).parquet(f"{path}/stats").select(
        "field", (F.col("total_len") / F.col("n_docs")).alias("mean_len"))
    part = bm25(F.col("tf"), F.col("field_len"), F.col("mean_len"))
    directory = salted_join(written, stats, ["field"], "block").groupBy(
        "bucket", "term", "field", "block").agg(F.count("*").alias("n"), F.max(part).alias("most"))
    place = F.pmod(F.col("block"), F.lit(max(1, blocks // BLOCKS)))
    directory.repartition("bucket", place).sortWithinPartitions(
        "bucket", "term", "field", "block").write.partitionBy("bucket").option(
        "compression", "zstd").parquet(f"{path}/blocks")
    counted = spark.read.schema(FIELDED["blocks"]).parquet(f"{path}/blocks").groupBy(
        "bucket", "field", "term").agg(F.sum("n").alias("df"))
    _write_dictionary(counted, f"{path}/dictionary")


LAYOUT = "buckets int"

# Schemas of the tables of an index; stating them saves a look into the files.
POSITIONAL = {
    "postings": "doc_id bigint, term string, tf bigint, pos_list array<int>, bucket int",
    "dictionary": "term string, df bigint, bucket int",
    "stats": "n_docs bigint",
}
FIELD_POSTING = (
    "doc_id string, field string, term string, tf bigint, field_len bigint, leads boolean"
)
FIELDED = {
    "postings": f"{FIELD_POSTING}, block int, bucket int",
    "dictionary": "field string, term string, df bigint, bucket int",
    "stats": "field string, n_docs bigint, total_len bigint",
    "blocks": "term string, field string, block int, n bigint, most double, bucket int",
}


def open_index(
    spark: SparkSession, path: str, schemas: dict[str, str], buckets: int | None = None
) -> Index:
    """The index at ``path``, which knows its own bucket count; another one is an error."""
    stored = spark.read.schema(LAYOUT).parquet(f"{path}/layout").first()["buckets"]
    if buckets not in (None, stored):
        raise ValueError(f"the index at {path} has {stored} buckets, not {buckets}")
    tables = {
        name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in schemas.items()
    }
    return Index(**tables, buckets=stored)
