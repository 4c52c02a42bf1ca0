"""Registered queries: every operator over the given tables, whole.

Columns are flattened to plain types, maps and arrays to strings, doubles to six digits,
so that another engine can produce the same rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boxes, fold, markup, text
from ..operators.stage import compute_once
from ..operators import counters, display, documents, index, live, pages, search
from ..session import materialize, scratch_path, scratch_root
from ..sources import csv, documents_json, store, xml
from ..sources.tables import input_bytes, read_table, spread
from .. import streaming
from . import etl
from .fixture import wiki_pages

TOP_K = search.MAX_HITS
# Input of one file of CSV rows over several lines, about twice a split of it.
CSV_FILE_BYTES = 128 << 20

# Search strings tried besides those taken from the tables.
FIXED_QUERIES = [
    (1_000_000, "the"),
    (1_000_001, "of the"),
    (1_000_002, "The and THE"),
    (1_000_003, "und der unknownword"),
    (1_000_004, "nothingmatchesthis"),
    (1_000_005, "is en"),
]

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


# --- inputs ----------------------------------------------------------------------------


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, title, text) of the documents table; the source serves as the title."""
    docs = read_table(spark, folder, "documents")
    return spread(docs.select("doc_id", F.col("source").alias("title"), "text"))


def extracts(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_pages(wiki_pages(spark, folder))


def wiki_documents(spark: SparkSession, folder: str) -> DataFrame:
    return documents.build_documents(extracts(spark, folder))


def _index_path(spark: SparkSession, folder: str, kind: str) -> str:
    """One index per session and folder."""
    name = hashlib.md5(folder.encode()).hexdigest()
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark).rstrip('/')}/{app}/{kind}-{name}"


def text_index(spark: SparkSession, folder: str) -> index.Index:
    path = _index_path(spark, folder, "texts")
    return etl.positional_index(spark, path, lambda: index.with_index_text(texts(spark, folder)))


def text_store(spark: SparkSession, folder: str) -> str:
    """The path of a keyed store of (doc_id, title, text)."""
    path = _index_path(spark, folder, "text-store")
    docs = read_table(spark, folder, "documents").select(
        "doc_id", F.col("source").alias("title"), "text")
    store.publish_once(spark, path, lambda aside: store.upsert(docs, aside, "doc_id"))
    return path


def wiki_index(spark: SparkSession, folder: str) -> index.Index:
    path = _index_path(spark, folder, "wiki")
    return etl.field_index(spark, path, lambda: wiki_documents(spark, folder))


def text_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark text as a query, and the fixed ones."""
    fixed = spark.createDataFrame(FIXED_QUERIES, "query_id long, raw string")
    items = read_table(spark, folder, "benchmark")
    return items.select(F.col("item_id").alias("query_id"), F.col("text").alias("raw")).unionByName(
        fixed
    )


def part_queries(spark: SparkSession, folder: str, raw: Column) -> DataFrame:
    """One query per different search string made from the parts."""
    part = read_table(spark, folder, "part")
    return part.select(raw.alias("raw")).distinct().select(F.col("raw").alias("query_id"), "raw")


# --- flattening for comparison ---------------------------------------------------------


def flat_map(col: str) -> Column:
    pairs = F.transform(
        F.sort_array(F.map_entries(col)), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return F.array_join(pairs, ";")


def flat_docs(docs: DataFrame) -> DataFrame:
    return docs.select("id", "title", "type", flat_map("fields").alias("fields"))


def flat_hits(hits: DataFrame, *more: str) -> DataFrame:
    return hits.select("query_id", "doc_id", F.round("score", 6).alias("score"), *more)


# --- sources and sinks -----------------------------------------------------------------


def _dump(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "dump")
    xml.write_page_dump(wiki_pages(spark, folder), path)
    return xml.read_page_dump(spark, path)


@register
def xml_pages(spark: SparkSession, folder: str) -> DataFrame:
    return xml.page_text(_dump(spark, folder))


def _odd_dump(spark: SparkSession, folder: str) -> str:
    """The wiki pages, and a page of every part, in three spellings of which one is broken."""
    path = scratch_path(spark, "dump")
    xml.write_page_dump(wiki_pages(spark, folder), path)
    part = read_table(spark, folder, "part")
    kind = F.col("p_partkey") % 3
    head = F.when(kind == 0, '<page xml:lang="en" note=\'a > b\'>').otherwise("<page>")
    close = F.when(kind == 1, "</title").otherwise("</title>")
    page = F.concat(
        head, F.lit("<id>p"), F.col("p_partkey").cast("string"), F.lit("</id><title>"), "p_name",
        close, F.lit("<revision><text>"), "p_type", F.lit("</text></revision></page>"))
    part.select(page.alias("value")).write.mode("append").text(path)
    return path


@register
def xml_rejects(spark: SparkSession, folder: str) -> DataFrame:
    dump = xml.read_pages_and_rejects(spark, _odd_dump(spark, folder))
    return xml.page_text(dump, "reject")


@register
def xml_title_text(spark: SparkSession, folder: str) -> DataFrame:
    return xml.title_and_text(_dump(spark, folder))


@register
def page_text_project(spark: SparkSession, folder: str) -> DataFrame:
    revision = F.when(F.col("text").isNotNull(), F.struct("text")).alias("revision")
    dump = wiki_pages(spark, folder).select("id", "title", revision)
    return dump.select(
        "id", "title", F.col("revision.text").alias("text"),
        F.col("revision").cast("string").alias("wrapped"),
    )


@register
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "extract")
    csv.write_extract(extracts(spark, folder), path, parts=10)
    return csv.read_extract(spark, path)


@register
def csv_append_chunks(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "chunks")
    wiki = wiki_pages(spark, folder)
    csv.append_extract(pages.extract_pages(wiki), path, chunk_rows=500)
    csv.append_extract(pages.extract_or_keep(pages.selected_text(wiki)), path, chunk_rows=500)
    return csv.read_extract(spark, path)


@register
def csv_line_breaks(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    rows = texts(spark, folder).select(F.col("doc_id").cast("string").alias("id"), "title", "text")
    # Whole files of several splits each, so that rows reach from one split into the next.
    parts = max(1, -(-input_bytes(rows) // CSV_FILE_BYTES))
    csv.write_extract(rows, path, parts)
    return csv.read_extract(spark, path, multi_line=True)


def _stream(spark: SparkSession, folder: str) -> str:
    """Two dumps of the wiki pages, by the last bit of their ids, streamed one after the other."""
    path = scratch_path(spark, "stream")
    wiki = wiki_pages(spark, folder)
    for bit in (1, 0):
        part = wiki.where(F.col("id").cast("bigint") % 2 == bit)
        xml.write_page_dump(part, f"{path}/dumps/part-{1 - bit}")
        streaming.stream_numbered(
            spark, f"{path}/dumps/*", f"{path}/out", f"{path}/progress").awaitTermination()
    return f"{path}/out"


@register
def stream_numbered_pages(spark: SparkSession, folder: str) -> DataFrame:
    return streaming.numbered_pages(spark, _stream(spark, folder)).select("page_no", "id", "title", "text")


@register
def stream_batch_counts(spark: SparkSession, folder: str) -> DataFrame:
    return streaming.batch_counts(spark, _stream(spark, folder))


@register
def json_docs_write(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "documents")
    documents_json.write_documents(wiki_documents(spark, folder), path)
    line = F.from_json("value", "map<string,string>")
    return spark.read.text(path).select(line.alias("doc")).select(
        F.col("doc")["id"].alias("id"), flat_map("doc").alias("doc")
    )


@register
def json_docs_read(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "documents")
    docs = wiki_documents(spark, folder)
    documents_json.write_documents(docs, path, trailing_comma=True)
    # Raw texts are no objects: they come back as rejects, one per line.
    texts(spark, folder).select("text").write.mode("append").text(path)
    return documents_json.read_documents(spark, path).select(
        "id", "title", "type", flat_map("fields").alias("fields"), "reject"
    )


@register
def docs_with_sentinel(spark: SparkSession, folder: str) -> DataFrame:
    return flat_docs(documents_json.with_sentinel(wiki_documents(spark, folder)))


@register
def docs_upsert_by_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = materialize(wiki_documents(spark, folder), "documents")
    first = flat_docs(docs)
    revised = first.where(F.col("type") != "book").withColumn("title", F.upper("title"))
    path = scratch_path(spark, "store")
    store.upsert(first, path)
    store.upsert(revised, path)
    return store.read_store(spark, path).select(first.columns)


@register
def index_build_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "dictionary")
    docs = index.with_index_text(texts(spark, folder))
    build = lambda d: index.document_frequencies(index.index_postings(d))
    store.build_if_absent(spark, path, lambda: build(docs))
    again, _ = store.build_if_absent(spark, path, lambda: build(docs.limit(0)))
    return again


# --- pages -----------------------------------------------------------------------------


@register
def drop_null_pages(spark: SparkSession, folder: str) -> DataFrame:
    return pages.drop_null_pages(wiki_pages(spark, folder))


@register
def page_classify(spark: SparkSession, folder: str) -> DataFrame:
    return pages.classify(wiki_pages(spark, folder)).select("id", "page_class")


@register
def page_class_counts(spark: SparkSession, folder: str) -> DataFrame:
    return pages.page_class_counts(wiki_pages(spark, folder))


@register
def pages_kept(spark: SparkSession, folder: str) -> DataFrame:
    return pages.keep_relevant(wiki_pages(spark, folder))


@register
def box_lines(spark: SparkSession, folder: str) -> DataFrame:
    wiki = wiki_pages(spark, folder).where("text is not null")
    return wiki.select("id", boxes.box_text(F.col("text")).alias("box"))


@register
def writer_tail(spark: SparkSession, folder: str) -> DataFrame:
    wiki = wiki_pages(spark, folder).where("text is not null")
    return wiki.select("id", boxes.writer_tail(F.col("text")).alias("tail"))


@register
def infobox_subtype(spark: SparkSession, folder: str) -> DataFrame:
    wiki = wiki_pages(spark, folder)
    return wiki.select("id", markup.infobox_subtype(F.col("text")).alias("subtype"))


@register
def dense_page_id(spark: SparkSession, folder: str) -> DataFrame:
    kept = pages.keep_relevant(wiki_pages(spark, folder)).select("id", "title")
    return pages.number_pages(kept)


@register
def run_counters(spark: SparkSession, folder: str) -> DataFrame:
    dump = xml.read_pages_and_rejects(spark, _odd_dump(spark, folder))
    return counters.count_run(xml.page_text(dump, "reject"))


# --- strings ---------------------------------------------------------------------------


def _markup_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(kind, id, text) of documents, web pages and wiki pages."""
    docs = texts(spark, folder).select(
        F.lit("document").alias("kind"), F.col("doc_id").cast("string").alias("id"), "text")
    web = spread(read_table(spark, folder, "pages")).select(
        F.lit("page").alias("kind"), F.col("page_id").cast("string").alias("id"),
        F.col("html").alias("text"))
    wiki = wiki_pages(spark, folder).select(F.lit("wiki").alias("kind"), "id", "text")
    return docs.unionByName(web).unionByName(wiki)


@register
def ascii_fold(spark: SparkSession, folder: str) -> DataFrame:
    return texts(spark, folder).select("doc_id", fold.ascii_fold(F.col("text")).alias("folded"))


@register
def text_normalize(spark: SparkSession, folder: str) -> DataFrame:
    folded = compute_once(
        _markup_texts(spark, folder), "kind", "id", folded=text.folded(F.col("text")))
    return folded.select(
        "kind", "id", text.squeezed(F.col("folded")).alias("dropped"),
        text.squeezed(F.col("folded"), drop_noinclude=False).alias("kept"),
    )


@register
def strip_templates(spark: SparkSession, folder: str) -> DataFrame:
    flat = _markup_texts(spark, folder).withColumn("text", text.flatten_newlines(F.col("text")))
    return flat.select("kind", "id", text.strip_templates(F.col("text")).alias("stripped"))


@register
def strip_refs(spark: SparkSession, folder: str) -> DataFrame:
    flat = _markup_texts(spark, folder).withColumn("text", text.flatten_newlines(F.col("text")))
    return flat.select("kind", "id", text.strip_refs(F.col("text")).alias("stripped"))


@register
def format_elapsed(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    return events.select("event_id", text.format_elapsed(F.col("value") * 97).alias("elapsed"))


# --- extraction ------------------------------------------------------------------------


def _boxed(spark: SparkSession, folder: str) -> DataFrame:
    wiki = wiki_pages(spark, folder).where("text is not null")
    return wiki.select("id", boxes.box_text(F.col("text")).alias("box"))


def _extract(spark: SparkSession, folder: str, test: str, fields: Callable) -> DataFrame:
    box = F.col("box")
    return _boxed(spark, folder).where(box.rlike(test)).select("id", fields(box).alias("extract"))


@register
def extract_book(spark: SparkSession, folder: str) -> DataFrame:
    return _extract(spark, folder, markup.INFOBOX_BOOK, markup.book_fields)


@register
def extract_film(spark: SparkSession, folder: str) -> DataFrame:
    return _extract(spark, folder, markup.INFOBOX_FILM, markup.film_fields)


@register
def extract_navbox(spark: SparkSession, folder: str) -> DataFrame:
    return _extract(spark, folder, markup.NAVBOX, markup.navbox_fields)


@register
def extract_writer_infobox(spark: SparkSession, folder: str) -> DataFrame:
    flat = text.flatten_newlines(F.col("text")).alias("text")
    wiki = wiki_pages(spark, folder).select("id", flat)
    writers = wiki.where(F.col("text").rlike(markup.INFOBOX_WRITER))
    return writers.select("id", markup.writer_box_fields(F.col("text")).alias("extract"))


@register
def extract_works(spark: SparkSession, folder: str) -> DataFrame:
    wiki = wiki_pages(spark, folder).where("text is not null")
    return wiki.select("id", markup.works_section(F.col("text")).alias("extract"))


@register
def extract_works_anchored(spark: SparkSession, folder: str) -> DataFrame:
    wiki = wiki_pages(spark, folder).where("text is not null")
    tail = wiki.select("id", boxes.writer_tail(F.col("text")).alias("tail"))
    return tail.select("id", markup.works_section_at_start(F.col("tail")).alias("extract"))


@register
def wiki_extract_all(spark: SparkSession, folder: str) -> DataFrame:
    return extracts(spark, folder)


@register
def wiki_extract_selected(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_or_keep(pages.selected_text(wiki_pages(spark, folder)))


@register
def wiki_extract_fallback(spark: SparkSession, folder: str) -> DataFrame:
    wiki = wiki_pages(spark, folder).where("text is not null")
    return pages.extract_or_keep(wiki.withColumnRenamed("text", "body"))


# --- documents -------------------------------------------------------------------------


@register
def doc_type(spark: SparkSession, folder: str) -> DataFrame:
    wiki = extracts(spark, folder).select("id", "text")
    plain = texts(spark, folder).select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text")
    return wiki.unionByName(plain).select("id", documents.document_type(F.col("text")).alias("type"))


@register
def doc_fields(spark: SparkSession, folder: str) -> DataFrame:
    return documents.document_fields(extracts(spark, folder)).select(
        "id", F.col("pos").cast("bigint").alias("pos"), "name", "value")


@register
def doc_map(spark: SparkSession, folder: str) -> DataFrame:
    return flat_docs(wiki_documents(spark, folder))


@register
def doc_overrides(spark: SparkSession, folder: str) -> DataFrame:
    return documents.document_overrides(wiki_documents(spark, folder))


@register
def doc_fields_long(spark: SparkSession, folder: str) -> DataFrame:
    return documents.documents_long(wiki_documents(spark, folder))


@register
def hit_display(spark: SparkSession, folder: str) -> DataFrame:
    return display.hit_display(extracts(spark, folder))


@register
def hit_fields_long(spark: SparkSession, folder: str) -> DataFrame:
    return display.hit_fields(wiki_documents(spark, folder))


# --- index -----------------------------------------------------------------------------


@register
def index_tokens(spark: SparkSession, folder: str) -> DataFrame:
    tokens = index.index_tokens(index.with_index_text(texts(spark, folder)))
    return tokens.select("doc_id", "term", F.col("pos").cast("bigint").alias("pos"))


@register
def index_postings(spark: SparkSession, folder: str) -> DataFrame:
    postings = index.index_postings(index.with_index_text(texts(spark, folder)))
    return postings.select("doc_id", "term", "tf", F.array_join("pos_list", ",").alias("positions"))


@register
def index_doc_freq(spark: SparkSession, folder: str) -> DataFrame:
    docs = index.with_index_text(texts(spark, folder))
    return index.document_frequencies(index.index_postings(docs))


@register
def index_build(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "index")
    docs = index.with_index_text(texts(spark, folder))
    built = etl.positional_index(spark, path, lambda: docs)
    return built.postings.select(
        "doc_id", "term", "tf", F.array_join("pos_list", ",").alias("positions"))


@register
def index_tfidf(spark: SparkSession, folder: str) -> DataFrame:
    built = text_index(spark, folder)
    n_docs = built.stats.select("n_docs").scalar()
    weights = index.tfidf_weights(built.postings, built.dictionary, n_docs)
    return weights.select("doc_id", "term", F.round("tf_idf", 6).alias("tf_idf"))


@register
def index_fields(spark: SparkSession, folder: str) -> DataFrame:
    return index.field_postings(wiki_documents(spark, folder)).select(
        "doc_id", "field", "term", "tf", "field_len")


# --- search ----------------------------------------------------------------------------


def _name_query() -> Column:
    return F.concat(F.lit("'name': '"), F.col("p_name"), F.lit("'"))


def _must_query() -> Column:
    return F.concat(
        F.lit("'name': '"), F.col("p_name"), F.lit("' 'all': '"), F.col("p_brand"), F.lit("'")
    )


def _clauses(spark: SparkSession, folder: str, raw: Column) -> DataFrame:
    return search.query_clauses(part_queries(spark, folder, raw))


def _field_hits(spark: SparkSession, folder: str, raw: Column) -> DataFrame:
    return search.search_fields(_clauses(spark, folder, raw), wiki_index(spark, folder))


@register
def query_clauses(spark: SparkSession, folder: str) -> DataFrame:
    free = part_queries(spark, folder, F.concat("p_type", F.lit(" -OR")))
    fielded = part_queries(spark, folder, _must_query())
    broken = part_queries(spark, folder, F.concat(F.lit(":'"), F.col("p_type"), F.lit("' :")))
    benchmark = text_queries(spark, folder).select(
        F.col("query_id").cast("string").alias("query_id"), "raw")
    asked = free.unionByName(fielded).unionByName(broken).unionByName(benchmark)
    return search.query_clauses(asked).withColumn("clause_id", F.col("clause_id").cast("bigint"))


@register
def search_match_and(spark: SparkSession, folder: str) -> DataFrame:
    return flat_hits(_field_hits(spark, folder, _name_query()))


@register
def search_match_or(spark: SparkSession, folder: str) -> DataFrame:
    return flat_hits(_field_hits(spark, folder, F.concat(_name_query(), F.lit(" -OR"))))


@register
def search_all_fields_and(spark: SparkSession, folder: str) -> DataFrame:
    return flat_hits(_field_hits(spark, folder, F.concat_ws(" ", "p_name", "p_type")))


@register
def search_all_fields_or(spark: SparkSession, folder: str) -> DataFrame:
    return flat_hits(_field_hits(spark, folder, F.concat("p_name", F.lit(" -OR"))))


@register
def search_bool_must(spark: SparkSession, folder: str) -> DataFrame:
    return flat_hits(_field_hits(spark, folder, _must_query()))


@register
def search_topk(spark: SparkSession, folder: str) -> DataFrame:
    clauses = _clauses(spark, folder, F.concat(_name_query(), F.lit(" -OR")))
    top = search.search_top(clauses, wiki_index(spark, folder), TOP_K)
    return flat_hits(top.withColumn("rank", F.col("rank").cast("bigint")), "rank")


def _revised(docs: DataFrame) -> DataFrame:
    """An update: every third document gets another title and name, every sixth a copy."""
    number = F.col("id").cast("bigint")
    marked = lambda c: F.concat(F.lit("revised "), c)
    fields = F.transform_values("fields", lambda k, v: F.when(k == "name", marked(v)).otherwise(v))
    third = docs.where(number % 3 == 0).select("id", marked(F.col("title")).alias("title"), "type",
                                               fields.alias("fields"))
    copies = docs.where(number % 6 == 1).select(
        F.concat(F.lit("n"), "id").alias("id"), "title", "type", "fields")
    return third.unionByName(copies)


def _live_query() -> Column:
    revised = F.concat(F.lit("'name': 'revised "), F.col("p_name"), F.lit("'"))
    return F.when(F.col("p_partkey") % 2 == 0, revised).otherwise(_name_query())


@register
def search_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return search.search_phrases(text_queries(spark, folder), text_index(spark, folder))


@register
def search_after_upsert(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "live")
    docs = materialize(wiki_documents(spark, folder), "documents")
    live.upsert(docs, path)
    live.upsert(_revised(docs), path)
    clauses = _clauses(spark, folder, _live_query())
    return flat_hits(search.search_fields(clauses, live.open_live(spark, path)))


@register
def search_after_compaction(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "live")
    docs = materialize(wiki_documents(spark, folder), "documents")
    live.upsert(docs, path)
    live.upsert(docs.withColumn("title", F.lit("passing")).where("type != 'film'"), path)
    live.upsert(docs, path)
    live.compact(spark, path)
    live.upsert(_revised(docs), path)
    live.compact(spark, path)
    clauses = _clauses(spark, folder, _live_query())
    return flat_hits(search.search_fields(clauses, live.open_live(spark, path)))


def _text_hits(spark: SparkSession, folder: str) -> DataFrame:
    return search.search_tfidf(text_queries(spark, folder), text_index(spark, folder))


@register
def search_tfidf(spark: SparkSession, folder: str) -> DataFrame:
    return flat_hits(_text_hits(spark, folder))


@register
def search_tfidf_ranked(spark: SparkSession, folder: str) -> DataFrame:
    return flat_hits(search.rank_ascending(_text_hits(spark, folder)), "rank")


@register
def search_tfidf_docs(spark: SparkSession, folder: str) -> DataFrame:
    path = text_store(spark, folder)
    return flat_hits(search.fetch_stored(_text_hits(spark, folder), path), "title", "text")


@register
def search_hit_counts(spark: SparkSession, folder: str) -> DataFrame:
    return search.hit_counts(text_queries(spark, folder), _text_hits(spark, folder))
