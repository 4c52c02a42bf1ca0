"""The whole way from a page dump to indexes, as one job per stored result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import documents, index, pages
from ..sources import csv, store, xml


def dump_to_extract(spark: SparkSession, dump: str, target: str, parts: int | None = None) -> None:
    """XML dump -> relevant pages -> extracted text -> CSV."""
    extracted = pages.extract_pages(xml.page_text(xml.read_page_dump(spark, dump)))
    csv.write_extract(extracted, target, parts)


def extract_to_documents(spark: SparkSession, source: str) -> DataFrame:
    return documents.build_documents(csv.read_extract(spark, source))


def positional_index(
    spark: SparkSession, path: str, docs: Callable[[], DataFrame], buckets: int | None = None
) -> index.Index:
    """The positional index of (doc_id, text) at ``path``, built only if it is not there."""
    store.publish_once(spark, path, lambda aside: index.build_index(docs(), aside, buckets))
    return index.open_index(spark, path, index.POSITIONAL, buckets)


def field_index(
    spark: SparkSession, path: str, docs: Callable[[], DataFrame], buckets: int | None = None
) -> index.Index:
    """The fielded index of documents at ``path``, built only if it is not there."""
    store.publish_once(spark, path, lambda aside: index.build_field_index(docs(), aside, buckets))
    return index.open_index(spark, path, index.FIELDED, buckets)
