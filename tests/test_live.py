"""The live index against an index built anew from the documents as they are."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from folioforge.operators import index, live, search
from folioforge.plans import etl

SCHEMA = "id string, title string, type string, fields map<string,string>"
WORDS = "a b c d e".split()


def some_docs(rng, ids):
    return [
        (i, rng.choice(["A c", "The b", "z"]), "book",
         {f: " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 4)))
          for f in rng.sample(["name", "author", "genre"], rng.randint(0, 3))})
        for i in ids
    ]


def tables_of(built):
    rows = lambda df, cols: sorted(map(tuple, df.select(cols).collect()))
    return (
        rows(built.postings, ["doc_id", "field", "term", "tf", "field_len", "leads"]),
        rows(built.dictionary, ["field", "term", "df"]),
        rows(built.stats, ["field", "n_docs", "total_len"]),
    )


def files_of(path):
    return {os.path.join(at, n) for at, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def hits_of(spark, built):
    raws = ["a b", "'name': 'a c' -OR", "'title': 'the' 'all': 'd'", "b -OR"]
    queries = spark.createDataFrame(list(enumerate(raws)), "query_id bigint, raw string")
    found = search.search_fields(search.query_clauses(queries), built).collect()
    return {(r.query_id, r.doc_id): round(r.score, 9) for r in found}


def test_updates_and_compactions_leave_the_index_of_the_documents_as_they_are(spark, fresh):
    rng = random.Random(5)
    state = {}
    live_path = fresh + "/live"
    for step in range(4):
        ids = [str(i) for i in range(60)] if not step else rng.sample([str(i) for i in range(80)], 25)
        docs = some_docs(rng, ids)
        before = files_of(live_path + "/postings")
        live.upsert(spark.createDataFrame(docs, SCHEMA), live_path)
        state.update({d[0]: d for d in docs})
        # An update adds files and leaves those that are there.
        assert before < files_of(live_path + "/postings")
        if step == 2:
            live.compact(spark, live_path)
            assert spark.read.parquet(live_path + "/gone").count() == 0
        frame = spark.createDataFrame(list(state.values()), SCHEMA)
        fresh_index = etl.field_index(spark, f"{fresh}/built{step}", lambda: frame, buckets=4)
        now = live.open_live(spark, live_path)
        assert tables_of(now) == tables_of(fresh_index)
        assert hits_of(spark, now) == hits_of(spark, fresh_index)
    kept = {r.id: tuple(r) for r in live.current_documents(spark, live_path).collect()}
    assert kept == state


def test_repeated_ids_empty_updates_and_documents_without_an_id(spark, fresh):
    docs = [("1", "first", "x", {}), ("1", "last", "x", {}), (None, "none", "x", {"name": "a"})]
    live.upsert(spark.createDataFrame(docs, SCHEMA).coalesce(1), fresh)
    live.upsert(spark.createDataFrame([], SCHEMA), fresh)
    built = live.open_live(spark, fresh)
    assert {r.term for r in built.postings.collect()} == {"1", "last", "x"}
    with pytest.raises(ValueError):
        live.open_live(spark, fresh + "/nothing")


def test_an_interrupted_update_is_never_seen(spark, fresh, monkeypatch):
    rng = random.Random(6)
    live.upsert(spark.createDataFrame(some_docs(rng, "123"), SCHEMA), fresh)
    wanted = tables_of(live.open_live(spark, fresh))
    write = live.store.write_buckets

    def fail(*args, **more):
        write(*args, **more)
        raise OSError("lost")

    monkeypatch.setattr(live.store, "write_buckets", fail)
    with pytest.raises(OSError):
        live.upsert(spark.createDataFrame(some_docs(rng, "234"), SCHEMA), fresh)
    monkeypatch.undo()
    assert tables_of(live.open_live(spark, fresh)) == wanted
    later = some_docs(rng, "35")
    live.upsert(spark.createDataFrame(later, SCHEMA), fresh)
    live.compact(spark, fresh)
    found = {r.id: tuple(r) for r in live.current_documents(spark, fresh).collect()}
    assert set(found) == set("1235") and found["5"] == later[1]
    frame = spark.createDataFrame(list(found.values()), SCHEMA)
    again = etl.field_index(spark, fresh + "-again", lambda: frame, buckets=4)
    assert tables_of(live.open_live(spark, fresh)) == tables_of(again)


def test_searches_prune_live_postings_where_they_are_stored(spark, fresh):
    live.upsert(spark.createDataFrame(some_docs(random.Random(7), map(str, range(30))), SCHEMA), fresh)
    live.upsert(spark.createDataFrame(some_docs(random.Random(8), map(str, range(9))), SCHEMA), fresh)
    built = live.open_live(spark, fresh)
    wanted = spark.createDataFrame([("a",)], "term string").withColumn(
        "bucket", index.term_bucket(built.buckets))
    for name, lists in (("postings", built.postings), ("dictionary", built.dictionary)):
        plan = search.asked_lists(lists, wanted, ["bucket", "term"])
        text = plan._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in text.splitlines() if "FileScan" in line and f"/{name}]" in line)
        assert re.search(r"PartitionFilters: \[[^]]*bucket", scan)
        assert re.search(r"PushedFilters: \[[^]]*term", scan)
    assert built.dictionary.where(F.col("df") < 1).isEmpty()
