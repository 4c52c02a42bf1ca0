import os
import random
from collections import Counter

from folioforge.operators import counters, pages
from folioforge.plans import etl
from folioforge.sources import csv, documents_json, xml
from folioforge.streaming import append, batch_counts, numbered_pages, stream_extracts, stream_numbered

DUMP = """<mediawiki><siteinfo><sitename>x</sitename></siteinfo>
<page><title>One &amp; only</title><ns>0</ns><id>10</id>
 <revision><id>5</id><contributor><id>7</id></contributor>
  <text bytes="9" xml:space="preserve"> {{Navbox|name = a &lt;b&gt;|group1 = c
}} </text></revision></page>
<page><title>Two</title><id>11</id></page>
<page><title>Three</title><id>12</id><revision><text></text></revision></page>
<page><title>Four</title><id>13</id><revision><text>plain</text></revision></page>
</mediawiki>
"""


def write_dump(folder, name="dump.xml", text=DUMP):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as file:
        file.write(text)


def test_page_dump(spark, fresh):
    write_dump(fresh)
    dump = xml.read_page_dump(spark, fresh)
    got = {r.id: (r.title, r.text) for r in xml.page_text(dump).collect()}
    assert got["10"] == ("One & only", " {{Navbox|name = a <b>|group1 = c\n}} ")
    assert got["11"] == ("Two", None)
    assert got["12"][1] in ("", None)
    assert got["13"] == ("Four", "plain")
    wrapped = {r.id: r.text for r in xml.page_text(dump, wrapped=True).collect()}
    assert wrapped["13"] == "{plain}" and wrapped["11"] is None
    assert xml.title_and_text(dump).columns == ["title", "text"]


def test_pages_with_attributes_and_malformed_pages(spark, fresh):
    write_dump(fresh, text="""<mediawiki><pages>no page</pages>
        <page xml:lang="en" note='a > b'><id>1</id><title>A</title></page>
        <page
          x="1"><id>2</id><title>B</title><revision><text>t</text></revision></page>
        <page><id>3</id><title>broken</page><page><id>4</id><title>D</title></page></mediawiki>""")
    assert {r.id: r.title for r in xml.read_page_dump(spark, fresh).collect()} == {
        "1": "A", "2": "B", "4": "D"}
    (bad,) = xml.page_rejects(spark, fresh).collect()
    assert bad.reject == "<page><id>3</id><title>broken"


def test_one_dump_file_is_read_by_many_tasks(spark, fresh):
    body = "".join(
        f"<page><title>t{i}</title><id>{i}</id><revision><text>{'x ' * 500}{i}</text></revision></page>\n"
        for i in range(2000)
    )
    write_dump(fresh, text=f"<mediawiki>\n{body}</mediawiki>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        pages_read = xml.page_text(xml.read_page_dump(spark, fresh))
        assert pages_read.rdd.getNumPartitions() > 5
        got = {r.id: r.text for r in pages_read.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {str(i): "x " * 500 + str(i) for i in range(2000)}


def test_dump_to_documents(spark, fresh):
    write_dump(fresh + "/in")
    etl.dump_to_extract(spark, fresh + "/in", fresh + "/out", parts=2)
    (row,) = csv.read_extract(spark, fresh + "/out").collect()
    assert tuple(row) == ("10", "One & only", "navbox | name = a b |group1 = c ")
    (doc,) = etl.extract_to_documents(spark, fresh + "/out").collect()
    assert (doc.type, doc.fields) == ("navbox", {"name": "a b"})


def test_csv_keeps_cells_verbatim(spark, fresh):
    rows = [("1", 'say "hi", you', " a | b "), ("2", "\\", ""), ("3", "x" * 2_000_000, "y")]
    df = spark.createDataFrame(rows, csv.EXTRACT_SCHEMA)
    csv.write_extract(df, fresh, parts=2)
    assert sorted(map(tuple, csv.read_extract(spark, fresh).collect())) == rows
    text = "".join(spark.read.text(fresh).where("value like '1,%'").first())
    assert text == '1,"say ""hi"", you", a | b '


def test_csv_with_line_breaks_and_existing_target(spark, fresh):
    rows = [("1", "a\nb", "c\n\nd"), ("2", "t", "e")]
    df = spark.createDataFrame(rows, csv.EXTRACT_SCHEMA)
    csv.write_extract(df, fresh)
    assert sorted(map(tuple, csv.read_extract(spark, fresh, multi_line=True).collect())) == rows
    try:
        csv.write_extract(df, fresh)
    except Exception as error:
        assert "already exists" in str(error)
    else:
        raise AssertionError("an existing target must not be replaced")


def test_csv_rows_over_several_lines_are_read_by_several_tasks(spark, fresh):
    rng = random.Random(3)
    cell = lambda: "".join(rng.choice(['"', "\n", ",", "a", "b c", '""', "\r\n", "|", "\n\n"])
                           for _ in range(rng.randint(0, 60)))
    rows = [(str(i), cell(), cell()) for i in range(3000)]
    rows[1500] = ("1500", "long\n" * 20_000, '"\n"' * 3000)
    df = spark.createDataFrame(rows, csv.EXTRACT_SCHEMA)
    csv.write_extract(df.coalesce(1), fresh)
    csv.append_extract(df.limit(10), fresh)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = csv.read_extract(spark, fresh, multi_line=True)
        assert csv._numbered_lines(spark, fresh).rdd.getNumPartitions() > 8
        found = Counter(map(tuple, read.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == Counter(rows) + Counter(rows[:10])


def test_appended_chunks(spark, fresh):
    df = spark.range(10).selectExpr("cast(id as string) id", "'t' title", "'x' text").coalesce(1)
    csv.append_extract(df, fresh, chunk_rows=4)
    csv.append_extract(df, fresh, chunk_rows=4)
    files = [f for f in os.listdir(fresh) if f.endswith(".csv")]
    assert len(files) == 6
    assert csv.read_extract(spark, fresh).count() == 20


def test_json_round_trip_and_sentinel(spark, fresh):
    docs = spark.createDataFrame(
        [("1", "a", "book", {"x": 'q"\\u', "title": "second", "=id": "y"}), ("2", "b", "film", {})],
        "id string, title string, type string, fields map<string,string>",
    )
    documents_json.write_documents(documents_json.with_sentinel(docs), fresh, trailing_comma=True)
    got = {r.id: (r.title, r.type, r.fields) for r in documents_json.read_documents(spark, fresh).collect()}
    assert got == {
        "1": ("a", "book", {"x": 'q"\\u', "title": "second", "=id": "y"}), "2": ("b", "film", {}), "0": ("test", "test", {}),
    }


def test_stream_appends_new_dumps_only(spark, fresh):
    write_dump(fresh + "/in", "a.xml")

    def run():
        stream_extracts(spark, fresh + "/in", fresh + "/out", fresh + "/progress").awaitTermination()
        return sorted(r.id for r in csv.read_extract(spark, fresh + "/out").collect())

    assert run() == ["10"]
    assert run() == ["10"]
    write_dump(fresh + "/in", "b.xml", DUMP.replace("<id>10</id>", "<id>20</id>"))
    assert run() == ["10", "20"]


def test_stream_numbers_pages_through_batches_and_once(spark, fresh, monkeypatch):
    def dump(ids):
        return "<mediawiki>" + "".join(
            DUMP.split("</siteinfo>")[1].split("<page><title>Two")[0].replace("<id>10</id>", f"<id>{i}</id>")
            for i in ids) + "<page><id>7</id><title>x</page></mediawiki>"

    def run():
        stream_numbered(spark, fresh + "/in", fresh + "/out", fresh + "/progress").awaitTermination()
        return [(r.page_no, r.id, r.batch) for r in numbered_pages(spark, fresh + "/out").orderBy("page_no").collect()]

    write_dump(fresh + "/in", "a.xml", dump([30, 4, 20]))
    first = [(0, "4", 0), (1, "20", 0), (2, "30", 0)]
    assert run() == first
    write_dump(fresh + "/in", "b.xml", dump([9, 8]))
    replace, calls = append._replace_batch, []

    def fail_at_the_counts(rows, path, batch):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("lost")
        replace(rows, path, batch)

    monkeypatch.setattr(append, "_replace_batch", fail_at_the_counts)
    try:
        run()
    except Exception as error:
        assert "lost" in str(error)
    monkeypatch.undo()
    assert [(r.page_no, r.id) for r in numbered_pages(spark, fresh + "/out").orderBy("page_no").collect()] == [
        r[:2] for r in first]
    # The batch is tried again, from the same number on.
    assert run() == [*first, (3, "8", 1), (4, "9", 1)]
    assert run() == [*first, (3, "8", 1), (4, "9", 1)]
    counts = {r.batch: (r.pages_read, r.pages_kept, r.pages_rejected) for r in batch_counts(spark, fresh + "/out").collect()}
    assert counts == {0: (4, 3, 1), 1: (3, 2, 1)}


def test_counters(spark, fresh):
    write_dump(fresh)
    write_dump(fresh, "bad.xml", "<mediawiki><page><id>7</id><title>x</page></mediawiki>")
    raw = xml.page_text(xml.read_pages_and_rejects(spark, fresh), "reject")
    seen, observation = counters.observe_rows(pages.extract_pages(raw), "extracted")
    seen.write.format("noop").mode("overwrite").save()
    assert observation.get == {"rows": 1}
    row = counters.count_run(raw).first()
    assert (row.pages_read, row.pages_kept, row.pages_rejected) == (5, 1, 1)
    assert (row.docs_indexed, row.docs_failed) == (1, 0)


def test_rows_over_several_lines_are_written_by_as_many_tasks_as_the_input_asks_for(spark, monkeypatch):
    from conftest import SMALL

    from folioforge.plans import queries

    files = []
    write = queries.csv.write_extract
    monkeypatch.setattr(queries, "CSV_FILE_BYTES", 100_000, raising=False)
    monkeypatch.setattr(queries.csv, "write_extract", lambda rows, path, parts=None: (
        write(rows, path, parts), files.append(spark.read.text(path).inputFiles())))
    rows = queries.REGISTRY["csv_line_breaks"](spark, SMALL).count()
    assert rows == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert len(files[0]) > 2


def test_a_large_input_is_spread_over_more_tasks_than_cores(spark, monkeypatch):
    from conftest import SMALL

    from folioforge.sources import tables

    docs = tables.read_table(spark, SMALL, "documents")
    size = tables.input_bytes(docs)
    monkeypatch.setattr(tables, "TASK_BYTES", size // 40, raising=False)
    assert tables.spread(docs).rdd.getNumPartitions() >= 40
