"""Pages appended to an extract while dump files arrive.

Each micro-batch takes the next dump files, extracts their pages and appends CSV files, so
memory holds one batch at most and a restart goes on after the last finished batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.counters import count_pages
from ..operators.pages import extract_pages, number_pages
from ..session import materialize
from ..sources.csv import LAYOUT
from ..sources.store import path_exists
from ..sources.xml import PAGE_END, REJECT, page_text, parse_pages

BATCH = "batch"
COUNTS = "pages_read long, pages_complete long, pages_kept long, pages_rejected long, batch long"
NUMBERED = "page_no long, id string, title string, text string, batch long"


def _records(spark: SparkSession, dumps: str, files_per_batch: int) -> DataFrame:
    return (
        spark.readStream.option("lineSep", PAGE_END)
        .option("maxFilesPerTrigger", files_per_batch)
        .text(dumps)
    )


def stream_extracts(
    spark: SparkSession, dumps: str, target: str, progress: str, files_per_batch: int = 64
) -> StreamingQuery:
    """Extract all dump files under ``dumps`` that ``progress`` does not list as done, then stop.

    ``progress`` is a folder on shared storage and belongs to one ``target``.
    """
    records = _records(spark, dumps, files_per_batch)
    return (
        extract_pages(page_text(parse_pages(records)))
        .writeStream.format("csv")
        .options(**LAYOUT)
        .option("path", target)
        .option("checkpointLocation", progress)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _replace_batch(rows: DataFrame, path: str, batch: int) -> None:
    """Write the rows of a batch; those of an earlier attempt at it go."""
    rows.withColumn(BATCH, F.lit(batch).cast("long")).write.partitionBy(BATCH).option(
        "partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


_COUNTED = ("pages_read", "pages_complete", "pages_kept", "pages_rejected")


def _append_batch(records: DataFrame, batch: int, target: str) -> None:
    """Number the pages of one batch from where the batches before it ended, and count them.

    The counts are written last and hold the number of pages; the next batch starts from the
    sum over all batches before it.  A batch that is tried again reads the same sum and
    replaces what it wrote, so every page is numbered exactly once.
    """
    spark = records.sparkSession
    counts = f"{target}/counts"
    start = 0
    if path_exists(spark, counts):
        earlier = spark.read.schema(COUNTS).parquet(counts).where(F.col(BATCH) < batch)
        start = earlier.agg(F.coalesce(F.sum("pages_kept"), F.lit(0))).first()[0]
    pages, seen = count_pages(page_text(parse_pages(records), REJECT))
    extracted = materialize(extract_pages(pages.where(F.col(REJECT).isNull())), "batch")
    numbered = number_pages(extracted).withColumn("page_no", F.col("page_no").cast("long") + start)
    _replace_batch(numbered.select("page_no", "id", "title", "text"), f"{target}/pages", batch)
    row = spark.createDataFrame(
        [tuple(seen.get[n] for n in _COUNTED)], ", ".join(f"{n} long" for n in _COUNTED))
    _replace_batch(row.coalesce(1), counts, batch)


def stream_numbered(
    spark: SparkSession, dumps: str, target: str, progress: str, files_per_batch: int = 64
) -> StreamingQuery:
    """``stream_extracts`` with page numbers 0, 1, ... through all batches, and counts of each.

    ``target`` gets the tables ``pages`` and ``counts``, both by batch.  Pages of a batch are
    numbered by their ids.
    """
    return (
        _records(spark, dumps, files_per_batch)
        .writeStream.foreachBatch(lambda records, batch: _append_batch(records, batch, target))
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def numbered_pages(spark: SparkSession, target: str) -> DataFrame:
    """(page_no, id, title, text, batch) of all batches that ended."""
    pages = spark.read.schema(NUMBERED).parquet(f"{target}/pages")
    return pages.join(batch_counts(spark, target).select(BATCH), BATCH, "left_semi")


def batch_counts(spark: SparkSession, target: str) -> DataFrame:
    """What each batch read, kept and rejected."""
    return spark.read.schema(COUNTS).parquet(f"{target}/counts")
