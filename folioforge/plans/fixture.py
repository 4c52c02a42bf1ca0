"""Wikitext pages rendered from the ``part`` and ``documents`` tables.

The given tables hold no wikitext, so each row becomes a page: the part gives the field
values, the document of the same key, if there is one, gives the prose.  All rows of both
tables are used.  The expressions are written in the common part of Spark SQL and ANSI
SQL, so both sides of a check render the same pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stage import compute_once
from ..sources.tables import read_table, spread

NL = "chr(10)"


def _lines(*parts: str) -> str:
    return f" || {NL} || ".join(parts)


BOOK = _lines(
    "CASE WHEN k % 12 = 0 THEN '{{Infobox book' ELSE '{{infobox  Short Story <!-- x -->' END",
    "'| name = ' || name || ' |'",
    "'| image_name = ' || name || '.jpg |'",
    "'| author = [[' || brand || ' Smith]] |'",
    "'| genre = [[' || kind || ' fiction]], [[drama]] |'",
    "'{{circa|1900}}'",
    "'| pages = ' || CAST(size AS VARCHAR(20)) || ' |'",
    "close_box",
    "chr(39) || chr(39) || name || chr(39) || chr(39) || ' is a book of {{nowrap|old times}}.'",
    "body",
)
FILM = _lines(
    "'{{Infobox film'",
    "'| name = ' || name || ' é |'",
    "'| director = [[' || brand || ' Directör]] |'",
    "'| based_on = {{based on|[[' || name || ']]|' || brand || '}} |'",
    "'| starring = {{plainlist|'",
    "'* [[Actor ' || CAST(size AS VARCHAR(20)) || ']]'",
    "'}}'",
    "'| runtime = ' || CAST(size AS VARCHAR(20)) || ' minutes |'",
    "close_box",
    "body",
)
NAVBOX = _lines(
    "'<noinclude>{{pp}}</noinclude>'",
    "body",
    "'{{Navbox<noinclude/>'",
    "'| name = ' || name || ' |'",
    "'| listclass = hlist'",
    "'| group1 = Novels {{noitalic|(3)}}'",
    "'| list1 = * [[' || name || ' (novel)]] * [[' || kind || ']]'",
    "'| title = Other ' || name || ' | = nameless | none = nothing'",
    "'| group2 = Films br'",
    "'| list2 = * ' || brand || ' * ' || kind",
    "close_box",
)
WRITER = _lines(
    "name || ' was a writer.'",
    "CASE WHEN k % 12 = 3 THEN body ELSE '' END",
    "CASE WHEN k % 9 = 0 THEN '===Works===' ELSE '== Bibliography ==' END",
    "'* [[' || name || '|' || brand || ']] (1901) <ref>first</ref> | year = 1901'",
    "'* {{ISBN|123}} ' || kind || ' <ref name=x>second</ref> | type = ' || kind",
    "CASE WHEN k % 12 = 3 THEN '' ELSE body END",
    "next_heading",
    "'{{reflist}}'",
)
OTHER = _lines(
    "CASE WHEN k % 12 = 4 THEN '{{Infobox writer | name = ' || name || ' | pseudonym = ' || "
    "brand || ' | pages = 3 |' ELSE name END",
    "body",
)
MIXED = _lines(
    "'{{Infobox film'",
    "'| name = ' || name || ' |'",
    "'| director = [[' || brand || ']] |'",
    "close_box",
    "body",
    "'{{Infobox book'",
    "'| name = ' || name || ' (book) |'",
    "'| author = [[' || kind || ']] |'",
    "'}}'",
    "'== Works =='",
    "'* name = ' || name || ' |'",
    "'== Notes =='",
)
ONE_LINE = _lines(
    "'{{Navbox|name = ' || name || '|group1 = ' || kind || '|last = x}}'", "body"
)

TITLE = "CASE WHEN k % 50 = 9 THEN 'The \"' || name || '\", a title' ELSE name || ' ' || id END"
TEXT = f"""CASE
 WHEN k % 50 = 7 THEN NULL
 WHEN k % 50 = 8 THEN ''
 WHEN k % 50 = 13 THEN {ONE_LINE}
 WHEN k % 6 = 0 THEN {BOOK}
 WHEN k % 6 = 1 THEN {FILM}
 WHEN k % 6 = 2 THEN {NAVBOX}
 WHEN k % 6 = 3 THEN {WRITER}
 WHEN k % 6 = 4 THEN {OTHER}
 ELSE {MIXED} END"""

PARTS_SQL = """
SELECT k, CAST(k AS VARCHAR(20)) AS id,
 coalesce(p_name, 'unknown') AS name, coalesce(p_brand, 'Brand') AS brand,
 coalesce(p_type, 'NONE') AS kind, coalesce(p_size, 0) AS size, coalesce(text, '') AS body,
 CASE WHEN k % 50 = 11 THEN '' ELSE '}}' END AS close_box,
 CASE WHEN k % 50 = 17 THEN 'no heading' ELSE '== References ==' END AS next_heading
FROM (SELECT coalesce(p_partkey, doc_id) AS k, p_name, p_brand, p_type, p_size, text
      FROM part FULL JOIN documents ON p_partkey = doc_id) joined"""

WIKI_SQL = f"SELECT id, {TITLE} AS title, {TEXT} AS text FROM ({PARTS_SQL}) parts"


def wiki_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages (id, title, text) rendered from all parts and documents."""
    part = spread(read_table(spark, folder, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    joined = part.join(documents, F.col("p_partkey") == F.col("doc_id"), "full")
    parts = joined.select(
        F.coalesce("p_partkey", "doc_id").alias("k"),
        F.coalesce("p_name", F.lit("unknown")).alias("name"),
        F.coalesce("p_brand", F.lit("Brand")).alias("brand"),
        F.coalesce("p_type", F.lit("NONE")).alias("kind"),
        F.coalesce("p_size", F.lit(0)).alias("size"),
        F.coalesce("text", F.lit("")).alias("body"),
    ).selectExpr(
        "*", "CAST(k AS STRING) AS id",
        "CASE WHEN k % 50 = 11 THEN '' ELSE '}}' END AS close_box",
        "CASE WHEN k % 50 = 17 THEN 'no heading' ELSE '== References ==' END AS next_heading",
    )
    title, text = (e.replace("VARCHAR(20)", "STRING") for e in (TITLE, TEXT))
    return compute_once(parts, "id", title=F.expr(title), text=F.expr(text))
