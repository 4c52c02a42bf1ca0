"""Page dumps in XML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.stage import compute_once

# Element names of a page dump and the columns taken from a page.
ROOT_TAG = "mediawiki"
ROW_TAG = "page"
PAGE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("revision", T.StructType([T.StructField("text", T.StringType())])),
])


# A page's start tag with or without attributes, whose values may hold any sign.
PAGE_START = rf"""<{ROW_TAG}(?:\s(?:"[^"]*"|'[^']*'|[^'">])*)?>"""
PAGE_END = f"</{ROW_TAG}>"
REJECT = "reject"


def parse_pages(records: DataFrame) -> DataFrame:
    """(id, title, revision, reject) of text records that each end where a page ends.

    ``reject`` holds a page that cannot be parsed, as it was read and without its end tag; the
    other columns of such a row are null.  Records without a page, such as the end of the
    dump, are no rows.
    """
    body = F.regexp_replace("value", f"(?s)^.*?{PAGE_START}", "")
    element = F.concat(F.lit(f"<{ROW_TAG}>"), body, F.lit(PAGE_END))
    schema = T.StructType([*PAGE_SCHEMA.fields, T.StructField("_bad", T.StringType())])
    page = F.from_xml(
        element, schema.simpleString(),
        {"ignoreSurroundingSpaces": "false", "columnNameOfCorruptRecord": "_bad"},
    )
    found = compute_once(records.where(F.col("value").rlike(PAGE_START)), "value", page=page)
    bad = F.col("page").isNull() | F.col("page._bad").isNotNull()
    field = lambda name: F.when(~bad, F.col(f"page.{name}")).alias(name)
    return found.select(
        *(field(f.name) for f in PAGE_SCHEMA.fields),
        F.when(bad, F.regexp_extract("value", f"(?s){PAGE_START}.*", 0)).alias(REJECT),
    )


def read_pages_and_rejects(spark: SparkSession, path: str) -> DataFrame:
    """One row per page of a dump, malformed ones included.

    A dump is one huge file, and the XML reader does not split files.  The text reader
    does, at the ends of pages, which cannot occur inside a page: there ``<`` is escaped.
    """
    return parse_pages(spark.read.option("lineSep", PAGE_END).text(path))


def read_page_dump(spark: SparkSession, path: str) -> DataFrame:
    """One row per well-formed page; elements outside the schema are skipped, text is verbatim."""
    return read_pages_and_rejects(spark, path).where(F.col(REJECT).isNull()).drop(REJECT)


def page_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The malformed pages of a dump, as text."""
    return read_pages_and_rejects(spark, path).where(F.col(REJECT).isNotNull()).select(REJECT)


def write_page_dump(pages: DataFrame, path: str) -> None:
    """Write (id, title, text) as a page dump; a null text leaves out the revision."""
    body = F.when(F.col("text").isNotNull(), F.struct("text"))
    (
        pages.select("id", "title", body.alias("revision"))
        .write.format("xml")
        .option("rootTag", ROOT_TAG)
        .option("rowTag", ROW_TAG)
        .mode("errorifexists")
        .save(path)
    )


def page_text(dump: DataFrame, *more: str, wrapped: bool = False) -> DataFrame:
    """Flatten to (id, title, text) and the columns ``more``.

    ``wrapped`` gives the text as a cast of the revision struct does, in braces; it exists
    for comparison with extracts made that way.
    """
    text = F.col("revision").cast("string") if wrapped else F.col("revision.text")
    return dump.select("id", "title", text.alias("text"), *more)


def title_and_text(dump: DataFrame) -> DataFrame:
    return dump.select("title", F.col("revision.text").alias("text"))
