"""Documents as JSON lines, one flat object per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stage import compute_once

KEY_FIELDS = ("id", "title", "type")
# Put before the name of a field that is called like a key column.  The text grammar has no
# such name; one from elsewhere gets the sign once more, so every name comes back as it was.
SECOND = "="


def flat_names(fields: Column) -> Column:
    """``fields`` with names that can stand beside the key columns: ``title`` is ``=title``."""
    clash = lambda name: name.isin(*KEY_FIELDS) | name.startswith(SECOND)
    return F.transform_keys(
        fields, lambda name, _: F.when(clash(name), F.concat(F.lit(SECOND), name)).otherwise(name)
    )


def own_names(flat: Column) -> Column:
    """Fields of a flat document under their own names."""
    fields = F.map_filter(flat, lambda name, _: ~name.isin(*KEY_FIELDS))
    return F.transform_keys(
        fields,
        lambda name, _: F.when(name.startswith(SECOND), F.substring(name, 2, 1 << 30)).otherwise(name),
    )


def document_json(fields: Column = None) -> Column:
    """The document as one flat JSON object; fields named like a key column get ``=`` before it."""
    own = flat_names(F.col("fields") if fields is None else fields)
    keys = F.create_map(*(part for k in KEY_FIELDS for part in (F.lit(k), F.col(k))))
    return F.to_json(F.map_concat(keys, own))


def write_documents(docs: DataFrame, path: str, trailing_comma: bool = False) -> None:
    """One object per line; ``trailing_comma`` gives lines as they are inside an array."""
    line = document_json()
    if trailing_comma:
        line = F.concat(line, F.lit(","))
    docs.select(line.alias("value")).write.mode("errorifexists").text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(id, title, type, fields, reject) from JSON lines or from lines of one JSON array.

    All square brackets and a comma at the end of the line are removed before parsing.  A
    line that is no object is kept, whole, in ``reject``.
    """
    line = F.regexp_replace(F.translate("value", "[]", ""), r",\s*$", "")
    doc = F.from_json("line", "map<string,string>")
    return (
        # Computed once: the filter is not pushed below a generator.
        compute_once(spark.read.text(path), line=line)
        .where(F.trim("line") != "")
        .select("line", doc.alias("doc"))
        .select(
            *(F.try_element_at("doc", F.lit(k)).alias(k) for k in KEY_FIELDS),
            own_names(F.col("doc")).alias("fields"),
            F.when(F.coalesce(F.size("doc"), F.lit(0)) <= 0, F.col("line")).alias("reject"),
        )
    )


def with_sentinel(docs: DataFrame) -> DataFrame:
    """Add the closing test document."""
    sentinel = docs.sparkSession.range(1).select(
        F.lit("0").alias("id"),
        F.lit("test").alias("title"),
        F.lit("test").alias("type"),
        F.expr("cast(map() as map<string,string>)").alias("fields"),
    )
    return docs.select("id", "title", "type", "fields").unionByName(sentinel)
