"""Properties of the physical plans that matter at scale."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from folioforge.operators import index, pages, search
from folioforge.plans import queries
from folioforge.plans.fixture import wiki_pages
from folioforge.sources.tables import read_table

# A range of partitions is at most as long as the number of tasks, so the shifts of
# `number_rows` may be summed up in one task.
SHIFTS = {"dense_page_id"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries.REGISTRY))
def test_no_python_no_cross_join_no_single_task(spark, name):
    plan = plan_of(queries.REGISTRY[name](spark, SMALL))
    for bad in ("PythonUDF", "ArrowEval", "BatchEval", "CartesianProduct", "NestedLoop"):
        assert bad not in plan
    single = re.findall(r"Exchange SinglePartition", plan)
    aggregates_only = "Window" not in plan
    assert not single or aggregates_only or name in SHIFTS


def test_irrelevant_pages_leave_before_the_costly_steps(spark):
    wiki = spark.createDataFrame([("1", "t", "x")], "id string, title string, text string")
    plan = plan_of(pages.extract_pages(wiki))
    lines = plan.splitlines()
    test = next(i for i, l in enumerate(lines) if "Filter" in l and "RLIKE" in l)
    assert all("aggregate(" not in l and "regexp_extract_all" not in l for l in lines[test:])
    # Box selection occurs once, however often its result is used.
    assert plan.count("slice(") <= 3


def test_postings_need_no_shuffle(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert "Exchange" not in plan_of(index.index_postings(docs))


def test_only_needed_columns_are_read(spark):
    docs = read_table(spark, SMALL, "documents").select("doc_id", "text")
    plan = plan_of(index.document_frequencies(index.index_postings(docs)))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan or "struct<text:string>" in plan


def test_search_prunes_the_buckets_of_the_index(spark):
    built = queries.text_index(spark, SMALL)
    wanted = spark.createDataFrame([("the",)], "term string")
    bucket = wanted.select(index.term_bucket(built.buckets)).first()[0]
    plan = plan_of(built.postings.where((F.col("bucket") == bucket) & (F.col("term") == "the")))
    assert re.search(r"PartitionFilters: \[[^]]*bucket", plan)
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(term,the\)", plan)


def test_fetching_moves_hits_and_never_the_texts(spark):
    """No exchange stands above the scan of all texts: ids go to the texts, not texts to ids."""
    docs = read_table(spark, SMALL, "documents").select("doc_id", "text")
    hits = docs.select(F.lit(1).alias("query_id"), "doc_id").where("doc_id % 7 = 0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(search.matching_documents(hits, docs))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and not re.search(r"(?<!Broadcast)Exchange (hash|Round|range)", plan)


def test_plan_stays_small_along_the_whole_chain(spark):
    docs = queries.documents.build_documents(pages.extract_pages(wiki_pages(spark, SMALL)))
    assert len(plan_of(docs)) < 120_000
