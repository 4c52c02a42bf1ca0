"""Counts of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import markup
from .documents import document_type
from .pages import extract_pages


def count_pages(pages: DataFrame) -> tuple[DataFrame, Observation]:
    """(id, title, text, reject) pages that are counted while they are used, and the counts.

    Kept, irrelevant and rejected pages add up to those read.
    """
    text, rejected = F.col("text"), F.col("reject").isNotNull()
    complete = ~rejected & F.col("id").isNotNull() & F.col("title").isNotNull() & text.isNotNull()
    kept = ~rejected & F.col("id").isNotNull() & F.col("title").isNotNull() & markup.is_relevant(text)
    seen = Observation()
    observed = pages.observe(
        seen, F.count(F.lit(1)).alias("pages_read"), F.count_if(complete).alias("pages_complete"),
        F.count_if(kept).alias("pages_kept"), F.count_if(rejected).alias("pages_rejected"),
    )
    return observed, seen


def count_run(pages: DataFrame) -> DataFrame:
    """One row of all counters of (id, title, text, reject) pages, in one pass.

    Pages are counted while the documents made of them are.
    """
    observed, seen = count_pages(pages)
    docs = count_documents(extract_pages(observed.where("reject is null"))).first()
    return pages.sparkSession.createDataFrame(
        [tuple(int(v) for v in (*seen.get.values(), *docs))],
        ", ".join(f"{name} long" for name in (*seen.get, *docs.asDict())),
    )


def count_documents(extracts: DataFrame) -> DataFrame:
    """One row: extracts that become documents and those that cannot."""
    has_type = document_type(F.col("text")).isNotNull()
    return extracts.agg(
        F.count_if(has_type).alias("docs_indexed"), F.count_if(~has_type).alias("docs_failed")
    )


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows while it is written, without a pass of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
