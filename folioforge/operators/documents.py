"""From extracted pages to documents with named fields.

The text of an extract is ``type | name = value | more value | name = value | ...``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let, squeeze
from ..sources.documents_json import KEY_FIELDS
from .stage import compute_once

UNNAMED = "none"


def document_type(text: Column) -> Column:
    """First word of the text, where ``|`` and ``=`` are words of their own."""
    first = F.regexp_extract(text, r"[^ \t\n\x0B\f\r\x1c\x1d\x1e\x1f]", 0)
    word = F.regexp_extract(text, r"[^ \t\n\x0B\f\r\x1c\x1d\x1e\x1f|=]+", 0)
    return F.when(first.isin("|", "="), first).when(first != "", word)


def field_pairs(text: Column) -> Column:
    """(pos, name, value) of every field of the text, in order.

    A field begins at each segment holding ``=`` and reaches to the segment before the
    next such one.  The segment before the first ``|`` never counts, and a last segment
    that holds ``=`` only ends the field before it.
    """
    def pair(segments: Column, begin: Column, n: Column) -> Column:
        first = F.get(begin, n)
        end = F.coalesce(F.get(begin, n + 1), F.size(segments) + 1)
        joined = F.array_join(F.slice(segments, first, end - first), "=")
        return let(
            F.transform(F.split(joined, "="), squeeze),
            lambda parts: F.struct(
                (n + 1).alias("pos"),
                F.get(parts, F.lit(0)).alias("name"),
                F.array_join(
                    F.filter(parts, lambda part, i: (i > 0) & (part != "")), ", "
                ).alias("value"),
            ),
        )

    def pairs(segments: Column) -> Column:
        begins = F.filter(
            F.transform(
                segments,
                lambda s, i: F.when((i > 0) & F.contains(s, F.lit("=")), i + 1),
            ),
            lambda line: line.isNotNull(),
        )
        return let(
            begins,
            lambda begin: F.filter(
                F.transform(begin, lambda first, n: F.when(
                    first < F.size(segments), pair(segments, begin, n))),
                lambda p: p.isNotNull(),
            ),
        )

    return let(F.split(text, r"\|"), pairs)


def field_map(pairs: Column) -> Column:
    """Map of name to value; the last field of a name wins, the empty name becomes 'none'.

    A field without a name replaces one that is called 'none'.
    """
    keyed = F.transform(
        pairs,
        lambda p: F.struct(
            F.when(p["name"] == "", UNNAMED).otherwise(p["name"]).alias("key"),
            (p["name"] == "").alias("unnamed"),
            p["pos"].alias("pos"),
            p["value"].alias("value"),
        ),
    )
    last = lambda ordered: F.filter(
        ordered,
        lambda p, i: (i + 1 == F.size(ordered)) | (F.get(ordered, i + 1)["key"] != p["key"]),
    )
    entries = let(F.sort_array(keyed), last)
    return F.map_from_entries(
        F.transform(entries, lambda p: F.struct(p["key"].alias("k"), p["value"].alias("v")))
    )


def with_pairs(extracts: DataFrame) -> DataFrame:
    """(id, title, type, pairs); extracts without any word have a null type."""
    text = F.col("text")
    return compute_once(
        extracts, "id", "title", type=document_type(text), pairs=field_pairs(text)
    )


def document_fields(extracts: DataFrame) -> DataFrame:
    """One row per field as written, in order, repeated names included."""
    return with_pairs(extracts).select("id", F.inline("pairs"))


def build_documents(extracts: DataFrame) -> DataFrame:
    """(id, title, type, fields); an extract without a type is no document."""
    typed = with_pairs(extracts).where(F.col("type").isNotNull())
    return compute_once(typed, "id", "title", "type", fields=field_map(F.col("pairs")))


def rejected_documents(extracts: DataFrame) -> DataFrame:
    return extracts.where(document_type(F.col("text")).isNull())


def documents_long(docs: DataFrame) -> DataFrame:
    """One row per field of a document."""
    return docs.select("id", F.explode("fields").alias("name", "value"))


def document_overrides(docs: DataFrame) -> DataFrame:
    """Fields named like a key column, with both values."""
    columns = F.create_map(*(part for k in KEY_FIELDS for part in (F.lit(k), F.col(k))))
    return docs.select(
        "id",
        columns.alias("columns"),
        F.explode(F.map_filter("fields", lambda n, _: n.isin(*KEY_FIELDS))).alias("name", "value"),
    ).select("id", "name", F.element_at("columns", F.col("name")).alias("kept"), "value")
