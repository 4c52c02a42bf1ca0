"""Extracted pages as CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

# The columns of an extract and the page count of one appended chunk.
EXTRACT_SCHEMA = "id string, title string, text string"
CHUNK_ROWS = 15_000

# Cells are quoted by doubling and kept verbatim.
LAYOUT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_extract(pages: DataFrame, path: str, parts: int | None = None) -> None:
    """New CSV folder; fails if the target exists.

    The number of files follows the input unless ``parts`` asks for a number, which costs
    a shuffle.
    """
    out = pages.repartition(parts) if parts else pages
    out.write.options(**LAYOUT).mode("errorifexists").csv(path)


def append_extract(pages: DataFrame, path: str, chunk_rows: int = CHUNK_ROWS) -> None:
    """Add files of at most ``chunk_rows`` pages to a CSV folder."""
    (
        pages.write.options(**LAYOUT)
        .option("maxRecordsPerFile", chunk_rows)
        .mode("append")
        .csv(path)
    )


def read_extract(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Read CSV extracts; cells may be of any length, and an empty cell is empty text.

    Large files are split among tasks.  Without ``multi_line`` cells must not hold line breaks;
    with it they may, and files are split at true ends of rows.
    """
    if multi_line:
        return read_split_rows(spark, path, EXTRACT_SCHEMA).na.fill("")
    return (
        spark.read.options(**LAYOUT)
        .option("maxCharsPerColumn", "-1")
        .schema(EXTRACT_SCHEMA)
        .csv(path)
        .na.fill("")
    )


# --- rows over several lines -----------------------------------------------------------

_CHUNK = ["file", "chunk"]


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, chunk, at, line): the lines of each split of a file, in order of ``at``."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("chunk"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def read_split_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of CSV files with a header whose cells may hold line breaks.

    A line ends a row if the quotes of the file up to there are even in number.  Each split of a
    file counts its own; sums over the splits before it, one row each, tell how it begins.  Lines
    meet within their split, and only the rows that reach into the next split move beyond it.
    """
    lines = _numbered_lines(spark, path)
    chunks = materialize(lines.groupBy(*_CHUNK).agg(F.sum(_quotes(F.col("line"))).alias("quotes")), "chunks")
    # One row per split of a file.
    earlier = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    begun = chunks.select(
        *_CHUNK, (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).alias("open"))
    within = Window.partitionBy(*_CHUNK).orderBy("at")
    so_far = F.sum(_quotes(F.col("line"))).over(within.rowsBetween(Window.unboundedPreceding, -1))
    # Lines go to their split's group; the table of splits has a row for each of those.
    placed = lines.join(begun, _CHUNK).withColumn(
        "starts", ((F.coalesce(so_far, F.lit(0)) + F.col("open")) % 2 == 0).cast("int"))
    numbered = placed.withColumn("row", F.sum("starts").over(within))
    rows = materialize(
        numbered.groupBy(*_CHUNK, "row").agg(
            F.array_join(F.transform(
                F.sort_array(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n"
            ).alias("text")), "rows")
    # Row 0 of a split goes on with the last row of the split before that has one of its own.
    ends = rows.groupBy(*_CHUNK).agg(F.max("row").alias("last"))
    ends = ends.withColumn("own", F.when(F.col("last") > 0, F.struct("chunk", "last")))
    owner = ends.select(*_CHUNK, F.last("own", ignorenulls=True).over(earlier).alias("owner"))
    rest = rows.where("row = 0").join(owner, _CHUNK).groupBy(
        "file", F.col("owner.chunk").alias("chunk"), F.col("owner.last").alias("row")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("chunk").alias("at"), "text"))).alias("parts"))
    whole = rows.where("row > 0").join(rest, [*_CHUNK, "row"], "left").select(
        *_CHUNK, "row",
        F.concat_ws("\n", "text", F.transform("parts", lambda x: x["text"])).alias("text"))
    header = (F.col("chunk") == 0) & (F.col("row") == 1)
    options = {**LAYOUT, "multiLine": "true", "maxCharsPerColumn": "-1"}
    record = F.from_csv(F.regexp_replace("text", "\\r\\z", ""), schema, options).alias("record")
    return whole.where(~header & (F.trim("text") != "")).select(record).select("record.*")
