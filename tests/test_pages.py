from pyspark.sql import functions as F

from folioforge.operators import pages

SCHEMA = "id string, title string, text string"


def run(spark, rows, step=pages.extract_pages):
    return {r.id: r.text for r in step(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_classes_and_precedence(spark):
    rows = [
        ("1", "t", "{{Infobox short story}} {{Navbox}} == Works =="),
        ("2", "t", "{{navbox}} ==WORKS=="),
        ("3", "t", "===Bibliography==="),
        ("4", "t", "{{Infobox writer}}"),
        ("5", "t", None),
    ]
    got = pages.classify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.page_class for r in sorted(got)] == ["infobox", "navbox", "writer", None, None]


def test_extraction(spark):
    book = "{{Infobox book\n| name = A&B |\n| author = [[X]], [[Y]] |\n| genre = [[Z]]\n}}\nprose"
    film = "{{Infobox film\n|name=F|\n|director = [[D]]|\n|based_on={{b|c}} |\n}}"
    nav = "{{Navbox|name = N|group2 = {{noitalic|(3)}} g | rest }} tail\nmore"
    writer = "intro ==x==\n==Works==\n* {{a|b}} one <ref>r</ref> two\n==Other==\nend"
    open_end = "a\n== Works ==\n* one"
    rows = [
        ("book", "t", book), ("film", "t", film), ("nav", "t", nav), ("writer", "t", writer),
        ("open", "t", open_end), ("none", "t", "text"), ("null", "t", None),
        ("notitle", None, book),
    ]
    assert run(spark, rows) == {
        "book": "book | name = a b |author = x y |",
        "film": "film | name=f|director = d |based on= b|c |",
        "nav": "navbox | name = n|group2 = g | rest tail more",
        "writer": "writer | ==works== * one two",
        "open": "writer | ",
    }


def test_navbox_unclosed_keeps_the_rest(spark):
    got = run(spark, [("1", "t", "{{Navbox\n|group1 = a\n|list1 = b\nrest\nof page")])
    assert got == {"1": "navbox | group1 = a |list1 = b rest of page"}


def test_fallback_keeps_unmatched_text(spark):
    df = spark.createDataFrame(
        [("1", "t", "Plain Text"), ("2", "t", "===Works=== a ==b=="), ("3", "t", "==Works== a ==b=="),
         ("4", "t", "{{Infobox film}} {{Infobox writer|name = W|pseudonym = P|"),
         ("5", "t", "{{infobox book|noinclude name = a|")],
        "id string, title string, body string",
    )
    got = {r.id: r.text for r in pages.extract_or_keep(df).collect()}
    assert got == {
        "1": "plain text", "2": "", "3": "writer | ==works== a",
        "4": "writer | |name = w|pseudonym = p|", "5": "book | name = a|",
    }


def test_null_rows_are_dropped_and_empty_text_stays(spark):
    df = spark.createDataFrame([("1", "a", ""), ("2", None, "x"), ("3", "b", None)], SCHEMA)
    assert [r.id for r in pages.drop_null_pages(df).collect()] == ["1"]


def test_ids_that_are_no_numbers_come_last(spark):
    df = spark.createDataFrame([("b", "t"), ("10", "t"), ("9", "t"), ("a", "t"), (None, "t")],
                               "id string, title string")
    got = {r.id: r.page_no for r in pages.number_pages(df).collect()}
    assert got == {"9": 0, "10": 1, "a": 2, "b": 3, None: 4}


def test_numbers_are_dense_and_ordered(spark):
    df = spark.range(0, 5000, 7).select(
        F.col("id").cast("string").alias("id"), F.lit("t").alias("title")
    )
    got = pages.number_pages(df.repartition(13)).collect()
    ordered = sorted(got, key=lambda r: int(r.id))
    assert [r.page_no for r in ordered] == list(range(len(ordered)))
