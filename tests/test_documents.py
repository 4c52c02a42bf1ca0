import os
import random
import re
import threading

import pytest

from folioforge.operators import display, documents
from folioforge.sources import documents_json, store

SCHEMA = "id string, title string, text string"


def pairs_of(spark, texts):
    df = spark.createDataFrame([(str(i), "t", t) for i, t in enumerate(texts)], SCHEMA)
    out = {str(i): [] for i in range(len(texts))}
    for r in documents.document_fields(df).collect():
        out[r.id].append((r.pos, r.name, r.value))
    return [[(n, v) for _, n, v in sorted(out[str(i)])] for i in range(len(texts))]


def expected_pairs(text):
    """Segments grouped by their nearest '=' segment to the left."""
    segments = text.split("|")
    owner, groups = None, {}
    for i, segment in enumerate(segments):
        if i and "=" in segment:
            owner = i
        if owner is not None:
            groups.setdefault(owner, []).append(segment)
    groups.pop(len(segments) - 1, None)
    result = []
    for _, group in sorted(groups.items()):
        parts = [" ".join(p.split(" ")) for s in group for p in s.split("=")]
        parts = [" ".join(p.split()) for p in parts]
        result.append((parts[0], ", ".join(p for p in parts[1:] if p)))
    return result


def test_field_grouping(spark):
    assert pairs_of(spark, [
        "book | name = a b |author = c |",
        "writer | == works == * a",
        "writer | == works == * a | b",
        "book | a = 1 | b | c = 2",
        "a = 1 | x",
        "",
    ]) == [
        [("name", "a b"), ("author", "c")],
        [],
        [("", "works, * a, b")],
        [("a", "1, b")],
        [],
        [],
    ]


def test_field_grouping_of_random_text(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab |==|") for _ in range(rng.randint(0, 25))) for _ in range(500)]
    assert pairs_of(spark, texts) == [expected_pairs(t) for t in texts]


def test_types(spark):
    cases = {"book | x": "book", "  film|": "film", "|a": "|", "=b": "=", "": None, " \n": None}
    df = spark.createDataFrame([(str(i), "t", t) for i, t in enumerate(cases)], SCHEMA)
    got = documents.with_pairs(df).select("id", "type").collect()
    assert [r.type for r in sorted(got)] == list(cases.values())
    assert sorted(r.id for r in documents.rejected_documents(df).collect()) == ["4", "5"]


def test_last_field_wins_and_unnamed_beats_none(spark):
    df = spark.createDataFrame([
        ("1", "T", "book | a = 1 | a = 2 | = u | none = n | title = new | end"),
    ], SCHEMA)
    docs = documents.build_documents(df)
    (doc,) = docs.collect()
    assert doc.fields == {"a": "2", "none": "u", "title": "new, end"}
    assert (doc.id, doc.title, doc.type) == ("1", "T", "book")
    (override,) = documents.document_overrides(docs).collect()
    assert tuple(override) == ("1", "title", "T", "new, end")
    shown = {r.key: r.value for r in display.hit_fields(docs).collect()}
    assert shown == {
        "id": "1", "title": "T", "type": "book", "a": "2", "none": "u", "=title": "new, end"}


def test_display(spark):
    df = spark.createDataFrame([
        ("1", "T", "book | name = a br b |x| author = c "),
        ("2", "U", "no segments"),
        ("3", "V", "| a = 1"),
    ], SCHEMA)
    got = {r.id: (r.type, r.body) for r in display.hit_display(df).collect()}
    assert got == {
        "1": ("book ", " name : a b  x\n  author : c "),
        "2": ("", " no segments"),
        "3": ("", "  " + "  a : 1"[1:]),
    }


def test_json_lines_in_both_layouts_and_rejects(spark, fresh):
    lines = ["[", '{"id": "1", "title": "a[b]", "type": "book", "x": "[y], z"},', "broken {,",
             '{"id": 0, "title": "test", "type": "test"}]', "", "]"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(fresh)
    rows = documents_json.read_documents(spark, fresh).collect()
    docs = {r.id: r for r in rows if r.reject is None}
    assert docs["1"].title == "ab" and docs["1"].fields == {"x": "y, z"}
    assert docs["0"].type == "test" and docs["0"].fields == {}
    assert [r.reject for r in rows if r.reject is not None] == ["broken {"]


def files_of(path):
    return {os.path.join(at, n) for at, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_upserts_rewrite_only_the_buckets_they_touch(spark, fresh):
    rows = [(str(i), f"v{i}") for i in range(200)]
    store.upsert(spark.createDataFrame(rows, "id string, value string"), fresh, buckets=8)
    before = files_of(fresh)
    new = [("5", "first"), ("5", "last"), ("x", "added"), (None, "no id")]
    store.upsert(spark.createDataFrame(new, "id string, value string").coalesce(1), fresh)
    after = files_of(fresh)
    assert store.stored_buckets(spark, fresh) == 8
    assert len({os.path.dirname(f) for f in before ^ after}) <= 3 and len(before & after) >= 5
    got = dict(map(tuple, store.read_store(spark, fresh).collect()))
    assert got == {**dict(rows), "5": "last", "x": "added", None: "no id"}
    more = spark.createDataFrame([("7", "v7", 1)], "id string, value string, more int")
    store.upsert(more, fresh)
    assert {r.more for r in store.read_store(spark, fresh).collect()} == {None, 1}
    store.upsert(spark.createDataFrame([], "id string, value string"), fresh)
    assert store.read_store(spark, fresh).count() == 202


def test_lookups_push_ids_and_buckets_to_the_files(spark, fresh, monkeypatch):
    rows = [(i, f"v{i}") for i in range(3000)]
    store.upsert(spark.createDataFrame(rows, "doc_id long, value string"), fresh, "doc_id", buckets=8)
    ids = [(5,), (17,), (17,), (99_999,), (None,)]
    found = store.lookup(spark, fresh, spark.createDataFrame(ids, "d long"), "doc_id")
    assert sorted(map(tuple, found.collect())) == [(5, "v5"), (17, "v17")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*store_bucket", plan)
    assert re.search(r"PushedFilters: \[[^]]*In\(doc_id, \[[0-9,]+\]\)", plan)
    assert "Join" not in plan
    many = spark.range(0, 4000, 2).withColumnRenamed("id", "d")
    for limit in (store.BROADCAST_IDS, 10):
        monkeypatch.setattr(store, "BROADCAST_IDS", limit)
        assert store.lookup(spark, fresh, many, "doc_id").count() == 1500
    assert store.lookup(spark, fresh, many.limit(0), "doc_id").count() == 0


def test_bloom_filters_are_written(spark, fresh):
    import pyarrow.parquet as pq

    store.upsert(spark.range(20_000).withColumnRenamed("id", "doc_id"), fresh, "doc_id", buckets=2)
    (file, *_) = files_of(fresh)
    group = pq.ParquetFile(file).metadata.row_group(0).column(0)
    assert group.statistics.has_min_max
    with open(file, "rb") as raw:
        content = raw.read()
    # The footer points to a filter in front of it: the file is longer than its columns.
    end = max(pq.ParquetFile(file).metadata.row_group(0).column(c).total_compressed_size for c in range(1))
    assert len(content) > end + 1024


def test_latest_write_wins(spark):
    rows = [("a", i, f"v{i}") for i in range(50)] + [("b", 1, "w")]
    df = spark.createDataFrame(rows, "id string, seq int, value string").repartition(5)
    assert sorted(map(tuple, store.latest_by_id(df).collect())) == [("a", "v49"), ("b", "w")]


def test_table_is_built_once(spark, fresh):
    built = []

    def build(n):
        built.append(n)
        return spark.range(n)

    first, new = store.build_if_absent(spark, fresh, lambda: build(3))
    assert (first.count(), new) == (3, True)
    second, new = store.build_if_absent(spark, fresh, lambda: build(9))
    assert (second.count(), new, built) == (3, False, [3])


def test_two_builders_leave_one_whole_table(spark, fresh):
    path = fresh + "/table"
    together = threading.Barrier(2)
    results = []

    def build(n):
        together.wait()
        return spark.range(n).repartition(3)

    def run(n):
        results.append((n, store.build_if_absent(spark, path, lambda: build(n))[1]))

    builders = [threading.Thread(target=run, args=(n,)) for n in (1000, 2000)]
    for b in builders:
        b.start()
    for b in builders:
        b.join()
    (winner,) = [n for n, new in results if new]
    assert len(results) == 2 and spark.read.parquet(path).count() == winner
    assert sorted(os.listdir(fresh)) == ["table"]


def test_a_failed_build_leaves_no_table(spark, fresh):
    def build():
        raise ValueError("no input")

    with pytest.raises(ValueError):
        store.build_if_absent(spark, fresh, build)
    assert store.build_if_absent(spark, fresh, lambda: spark.range(2))[1]
