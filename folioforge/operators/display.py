"""Printable forms of hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHITE, let
from ..sources.documents_json import KEY_FIELDS, flat_names

TYPE_PREFIX = r"^[^|]+\|"


def display_body(text: Column) -> Column:
    """Segments of a text without its type; every further ``:`` segment on a new line."""
    def lay_out(segments: Column) -> Column:
        first = F.array_position(F.transform(segments, lambda s: F.contains(s, F.lit(":"))), True)
        return let(
            first,
            lambda f: F.array_join(
                F.transform(
                    segments,
                    lambda s, i: F.concat(
                        F.when(F.contains(s, F.lit(":")) & (i + 1 > f), "\n ").otherwise(" "), s
                    ),
                ),
                "",
            ),
        )

    shown = F.regexp_replace(text, TYPE_PREFIX, "")
    return let(F.split(F.ltrim(shown, F.lit(WHITE)), r"\|"), lay_out)


def hit_display(extracts: DataFrame) -> DataFrame:
    """(id, name, type, body) as shown to a reader."""
    def no_breaks(col: Column) -> Column:
        return F.replace(col, F.lit(" br "), F.lit(" "))

    text = F.replace(no_breaks(F.col("text")), F.lit("="), F.lit(":"))
    return extracts.select(
        "id", no_breaks(F.col("title")).alias("name"), text.alias("text")
    ).select(
        "id", "name",
        F.replace(F.regexp_extract("text", TYPE_PREFIX, 0), F.lit("|"), F.lit("")).alias("type"),
        display_body(F.col("text")).alias("body"),
    )


def hit_fields(docs: DataFrame) -> DataFrame:
    """Every key and value of a document, key columns included, one row each."""
    own = flat_names(F.col("fields"))
    keys = F.create_map(*(part for k in KEY_FIELDS for part in (F.lit(k), F.col(k))))
    return docs.select("id", F.explode(F.map_concat(keys, own)).alias("key", "value"))
