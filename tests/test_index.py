import math
import random

import pytest
from pyspark.sql import functions as F

from folioforge.operators import index, skew
from folioforge.plans import etl


@pytest.fixture(scope="module")
def corpus():
    """200 texts; the word 'the' owns a third of all words."""
    rng = random.Random(2)
    texts = []
    for i in range(200):
        words = [rng.choice(["the", f"w{rng.randint(0, 40)}", f"x{i}.", "br"]) for _ in range(30)]
        texts.append((i, " ".join(words)))
    return texts + [(200, ""), (201, "...")]


def brute_postings(corpus):
    postings = {}
    for doc, text in corpus:
        kept = [w for w in text.split() if w != "br"]
        for pos, word in enumerate(kept):
            if word.isalnum():
                postings.setdefault((doc, word), []).append(pos)
    return postings


def test_postings_and_frequencies(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id bigint, text string").repartition(7)
    expected = brute_postings(corpus)
    postings = index.index_postings(docs)
    assert {(r.doc_id, r.term): r.pos_list for r in postings.collect()} == expected
    df = {}
    for _, term in expected:
        df[term] = df.get(term, 0) + 1
    assert {r.term: r.df for r in index.document_frequencies(postings).collect()} == df
    assert postings.agg(F.sum("tf")).first()[0] == index.index_tokens(docs).count()


@pytest.mark.parametrize("hot_terms", [1, 10, 1000])
def test_weights_with_few_many_and_no_hot_terms(spark, corpus, monkeypatch, hot_terms):
    monkeypatch.setattr(skew, "HOT_KEYS", hot_terms)
    docs = spark.createDataFrame(corpus, "doc_id bigint, text string")
    postings = index.index_postings(docs)
    weights = index.tfidf_weights(
        postings, index.document_frequencies(postings), F.lit(len(corpus))
    ).collect()
    expected = brute_postings(corpus)
    df = {}
    for _, term in expected:
        df[term] = df.get(term, 0) + 1
    assert len(weights) == len(expected)
    for r in weights:
        want = len(expected[r.doc_id, r.term]) * math.log(len(corpus) / df[r.term], 10)
        assert r.tf_idf == pytest.approx(max(want, 0))


def test_a_term_in_every_document_weighs_nothing(spark):
    docs = spark.createDataFrame([(i, "same") for i in range(9)], "doc_id bigint, text string")
    postings = index.index_postings(docs)
    weights = index.tfidf_weights(postings, index.document_frequencies(postings), F.lit(9))
    assert {r.tf_idf for r in weights.collect()} == {0.0}


def test_title_is_glued_unless_separated(spark):
    docs = spark.createDataFrame([(1, "A", "b c")], "doc_id bigint, title string, text string")
    for separator, words in [("", {"ab", "c"}), (" ", {"a", "b", "c"})]:
        tokens = index.index_tokens(index.with_index_text(docs, separator))
        assert {r.term for r in tokens.collect()} == words


def test_index_is_built_once_and_read_back(spark, corpus, fresh):
    docs = spark.createDataFrame(corpus, "doc_id bigint, text string")
    built = etl.positional_index(spark, fresh, lambda: docs, buckets=4)
    again = etl.positional_index(spark, fresh, lambda: 1 / 0, buckets=4)
    expected = brute_postings(corpus)
    for ix in (built, again):
        assert {(r.doc_id, r.term): r.pos_list for r in ix.postings.collect()} == expected
        assert ix.stats.first().n_docs == len(corpus)
    wrong = built.postings.where(F.col("bucket") != index.term_bucket(4))
    assert wrong.count() == 0


def test_an_index_knows_its_bucket_count(spark, corpus, fresh):
    docs = spark.createDataFrame(corpus, "doc_id bigint, text string")
    index.build_index(docs, fresh, buckets=64)
    built = index.open_index(spark, fresh, index.POSITIONAL)
    assert built.buckets == 64
    assert built.postings.where(F.col("bucket") != index.term_bucket(built.buckets)).count() == 0
    with pytest.raises(ValueError):
        index.open_index(spark, fresh, index.POSITIONAL, 16)


def test_field_postings_and_statistics(spark):
    docs = spark.createDataFrame(
        [("1", "The A", "book", {"x": "a b a", "y": "", "id": "no"}), ("2", "B", "book", {"x": "c"})],
        "id string, title string, type string, fields map<string,string>",
    )
    postings = index.field_postings(docs)
    got = {(r.doc_id, r.field, r.term): (r.tf, r.field_len) for r in postings.collect()}
    assert got[("1", "x", "a")] == (2, 3) and got[("1", "x", "b")] == (1, 3)
    assert got[("1", "id", "1")] == (1, 1) and ("1", "id", "no") not in got
    stats = {r.field: (r.n_docs, r.total_len) for r in index.field_statistics(postings).collect()}
    assert got[("1", "=id", "no")] == (1, 1)
    assert stats == {"id": (2, 2), "title": (2, 3), "type": (2, 2), "x": (2, 4), "=id": (1, 1)}


def test_writing_tasks_do_not_grow_with_the_input():
    for size in (1 << 30, 6 << 30, 60 << 30):
        buckets = max(index.BUCKETS, size // index.BUCKET_BYTES)
        assert size / (buckets * index.slice_count(size, buckets)) <= 16 << 20
