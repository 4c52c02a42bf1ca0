"""From raw pages to extracted pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import markup
from ..functions.boxes import box_and_tail_text, box_text
from ..functions.text import flatten_newlines, normalize_text
from .skew import number_rows
from .stage import compute_once


def drop_null_pages(pages: DataFrame) -> DataFrame:
    """Keep pages whose columns are all present; empty text stays."""
    return pages.na.drop("any")


def keep_relevant(pages: DataFrame) -> DataFrame:
    """Complete pages that have a class.

    One cheap test on the raw text.  Everything later is computed on the survivors only,
    and no later step filters on a computed text, which would compute it twice.
    """
    complete = F.col("id").isNotNull() & F.col("title").isNotNull()
    return pages.where(complete & markup.is_relevant(F.col("text")))


def classify(pages: DataFrame) -> DataFrame:
    """Add ``page_class``; null for irrelevant pages."""
    return pages.withColumn("page_class", markup.page_class(F.col("text")))


def page_class_counts(pages: DataFrame) -> DataFrame:
    page_class = F.coalesce(markup.page_class(F.col("text")), F.lit("none"))
    return pages.groupBy(page_class.alias("page_class")).agg(F.count("*").alias("n_pages"))


def extract_pages(pages: DataFrame, drop_noinclude: bool = True) -> DataFrame:
    """Extracted text of all relevant pages: class, box lines, fields, normalised."""
    body, subtype = F.col("body"), F.col("subtype")
    boxed = F.when(F.col("page_class") == "writer", F.col("text")).otherwise(
        box_text(F.col("text"))
    )
    box_subtype = F.when(body.rlike(markup.INFOBOX_BOOK), "book").when(
        body.rlike(markup.INFOBOX_FILM), "film"
    )
    extracted = (
        F.when(subtype == "book", markup.book_fields(body))
        .when(subtype == "film", markup.film_fields(body))
        .when(subtype == "navbox", markup.navbox_fields(body))
        .when(subtype == "writer", markup.works_section(body))
        .otherwise(body)
    )
    bodies = compute_once(
        classify(keep_relevant(pages)), "id", "title", "page_class", body=boxed
    ).withColumn(
        "subtype",
        F.when(F.col("page_class") == "infobox", box_subtype).otherwise(F.col("page_class")),
    )
    raw = compute_once(bodies, "id", "title", raw=extracted)
    return compute_once(
        raw, "id", "title", text=normalize_text(F.col("raw"), drop_noinclude)
    )


def selected_text(pages: DataFrame) -> DataFrame:
    """(id, title, body) of the relevant pages: box lines and the works tail."""
    return compute_once(
        keep_relevant(pages), "id", "title", body=box_and_tail_text(F.col("text"))
    )


def extract_or_keep(bodies: DataFrame) -> DataFrame:
    """Extraction of already selected text that returns what it cannot extract unchanged.

    Differs from ``extract_pages`` in three points: writer boxes are a subtype of their
    own, a works section counts only at the very start, and the marker word stays.
    """
    body, subtype = F.col("body"), F.col("subtype")
    routed = (
        F.when(F.col("page_class") == "infobox", markup.infobox_subtype(body))
        .when(F.col("page_class") == "writer", "works")
        .otherwise(F.col("page_class"))
    )
    extracted = (
        F.when(subtype == "book", markup.book_fields(body))
        .when(subtype == "writer", markup.writer_box_fields(body))
        .when(subtype == "film", markup.film_fields(body))
        .when(subtype == "navbox", markup.navbox_fields(body))
        .when(subtype == "works", markup.works_section_at_start(body))
        .otherwise(body)
    )
    flat = bodies.select("id", "title", flatten_newlines(body).alias("body"))
    classed = compute_once(flat, "id", "title", "body", page_class=markup.page_class(body))
    raw = compute_once(classed.withColumn("subtype", routed), "id", "title", raw=extracted)
    return compute_once(
        raw, "id", "title", text=normalize_text(F.col("raw"), drop_noinclude=False)
    )


def number_pages(pages: DataFrame) -> DataFrame:
    """Add dense ``page_no`` 0..n-1 in the order of the numeric page id; other ids come last."""
    number = F.col("id").try_cast("bigint").asc_nulls_last()
    return number_rows(pages, [number, F.col("id").asc_nulls_last()], "page_no")
