"""Benchmark decontamination by spaced seeds, in DataFrame functions alone.

A seed looks at a short run of words through a fixed mask and hashes some of them, so it still
hits where the words it ignores differ.  Seeds of all documents are joined with those of the
benchmark items; an alignment (document, item, shift) with enough hits is then verified word by
word.  It counts as an overlap if some stretch of it has at least ``MIN_WORDS`` words and four
of five words agree, or if four of five of the item's words are found.

A word that differs spoils as many seeds as the mask has words, so both kinds of overlap leave
a number of hits that follows from the item's length; masks are chosen by that length such
that it is never below one, and no overlap is lost.

Words are runs of letters and digits, in lower case.  A null text is an empty one and overlaps
nothing; an item without words is never reported, one of up to four only if found whole.  Equal
texts and equal items are compared once and reported for each of their ids.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: The least number of an item's words and the mask of its seeds: x counts, - is ignored.
MASKS = ((24, "xx-xx"), (7, "x-xx"), (5, "xx"), (4, "xxxx"), (3, "xxx"), (2, "xx"), (1, "x"))
MIN_WORDS = 13
#: Words that differ weigh four against one, so a stretch above zero has four of five alike.
MISS = 4
SHARE = 0.8
#: Seeds of the benchmark, and texts with hits, that may be broadcast (about 40 bytes each);
#: beyond that both sides of a join are shuffled.
BROADCAST_SEEDS = 1_000_000
BROADCAST_TEXTS = 1_000_000


def words(text: Column) -> Column:
    """The words' hashes, in order."""
    split = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(split, lambda w: w != ""), lambda w: F.xxhash64(w))


def seeds(hashes: Column, mask: str) -> Column:
    """The seeds of a mask at every place: array of (place, seed)."""
    offsets = [i for i, c in enumerate(mask) if c == "x"]
    places = F.when(
        F.size(hashes) >= len(mask), F.sequence(F.lit(0), F.size(hashes) - len(mask)))
    return F.transform(places, lambda p: F.struct(
        p.alias("place"),
        F.xxhash64(F.lit(mask), *(F.get(hashes, p + i) for i in offsets)).alias("seed")))


def fewest_hits(n_words: Column, mask: str) -> Column:
    """Hits that every overlap of an item of ``n_words`` has: k of five words more may differ in
    a stretch of 13 + 5 k, a fifth of them in a whole item."""
    whole = n_words - (len(mask) - 1) - mask.count("x") * F.floor(n_words / (MISS + 1))
    return F.least(F.lit(MIN_WORDS - (len(mask) - 1)), whole).cast("int")


def _hashed(df: DataFrame, name: str) -> DataFrame:
    """(key, words): ``key`` is the text's digest, ``words`` computed once per row."""
    return df.select("key", F.inline(F.array(F.struct(words(F.col("text")).alias(name)))))


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _verified(texts: DataFrame, tests: DataFrame) -> DataFrame:
    """The best verified alignment of every pair of different texts (key) and items (item_key)."""
    test_words = common.materialize(
        _hashed(tests.groupBy("key").agg(F.first("text").alias("text")), "item_words")
        .withColumnRenamed("key", "item_key"), "item-words")
    size = F.size("item_words")
    lengths = [r.n for r in test_words.select(size.alias("n")).where("n > 0").distinct().collect()]
    # One mask per range of lengths; documents get seeds of the masks that items have.
    used = [(low, next((x for x, _ in reversed(MASKS) if x > low), None), mask)
            for low, mask in MASKS]
    used = [(low, high, mask) for low, high, mask in used
            if any(low <= n and (high is None or n < high) for n in lengths)]
    parts = [
        test_words.where((size >= low) & (size < high if high else F.lit(True))).select(
            "item_key", fewest_hits(size, mask).alias("fewest"),
            F.inline(seeds(F.col("item_words"), mask)))
        for low, high, mask in used]
    none = test_words.where("false").select(
        "item_key", F.lit(1).alias("fewest"), F.lit(0).alias("place"), F.lit(0).cast("long").alias("seed"))
    test_seeds = common.materialize(
        reduce(DataFrame.union, parts, none).withColumnRenamed("place", "item_place"), "item-seeds")
    small = test_seeds.count() <= BROADCAST_SEEDS
    bounded = F.broadcast if small else (lambda df: df)
    masks = sorted({mask for _, _, mask in used}) or [MASKS[0][1]]
    doc_seeds = _hashed(texts, "doc_words").select("key", F.inline(F.concat(*(
        F.coalesce(seeds(F.col("doc_words"), mask), F.array().cast("array<struct<place:int,seed:bigint>>"))
        for mask in masks))))
    # Copies of a text count again, which only lets more be verified.
    hits = common.materialize(
        doc_seeds.join(bounded(test_seeds), "seed")
        .groupBy("key", "item_key", (F.col("place") - F.col("item_place")).alias("shift"))
        .agg(F.count("*").alias("hits"), F.first("fewest").alias("fewest"))
        .where("hits >= fewest").select("key", "item_key", "shift"), "hits")
    # Texts are not moved to find the few that are hit.
    hit_keys = common.materialize(hits.select("key").distinct(), "hit-keys")
    hit_texts = _hashed(
        texts.join(common.bounded(hit_keys, BROADCAST_TEXTS), "key", "left_semi"), "doc_words")
    hit_texts = hit_texts.groupBy("key").agg(F.first("doc_words").alias("doc_words"))
    aligned = hits.join(hit_texts, "key").join(
        F.broadcast(test_words) if small else test_words, "item_key")
    n_item, n_doc = F.size("item_words"), F.size("doc_words")
    low = F.greatest(F.lit(0), -F.col("shift"))
    high = F.least(n_item, n_doc - F.col("shift")) - 1
    same = F.transform(
        F.sequence(low, high),
        lambda i: F.get("item_words", i) == F.get("doc_words", i + F.col("shift")))
    stretch = F.aggregate(
        "same",
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("best")),
        lambda acc, hit: F.struct(
            F.greatest(F.lit(0), acc["now"] + F.when(hit, 1).otherwise(-MISS)).alias("now"),
            F.greatest(acc["best"], acc["now"] + F.when(hit, 1).otherwise(-MISS)).alias("best")),
        lambda acc: acc["best"],
    )
    judged = aligned.select(
        "key", "item_key", "shift", n_item.alias("n_words"), F.inline(F.array(F.struct(same.alias("same"))))
    ).select(
        "key", "item_key", "shift", "n_words",
        F.size(F.filter("same", lambda x: x)).alias("agreeing"), stretch.alias("best"))
    verified = judged.where(
        (F.col("best") >= MIN_WORDS) | (F.col("agreeing") >= SHARE * F.col("n_words")))
    return common.materialize(
        verified.groupBy("key", "item_key").agg(
            F.max(F.struct("best", "agreeing", (-F.col("shift")).alias("back"), "n_words")).alias("m")
        ).select("key", "item_key", (-F.col("m.back")).alias("shift"), "m.n_words", "m.agreeing",
                 "m.best"), "overlaps")


def overlaps(
    docs: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(doc_id, item_id, shift, n_words, agreeing, best) of every verified overlap.

    ``shift`` is the place of the item's first word among the document's (negative if the item
    starts before it), ``agreeing`` the item's words found there, ``best`` the weight of the
    best stretch.  Per document and item the best alignment is given.
    """
    texts = common.documents(docs).withColumn("key", _digest(F.col("text")))
    tests = common.documents(items, item_id, item_text).withColumn("key", _digest(F.col("text")))
    # A text or item with very many copies is split by adaptive execution.
    return (
        common.bounded(_verified(texts, tests), BROADCAST_TEXTS)
        .join(texts.select("doc_id", "key"), "key")
        .join(tests.select(F.col("doc_id").alias("item_id"), F.col("key").alias("item_key")),
              "item_key")
        .select("doc_id", "item_id", "shift", "n_words", "agreeing", "best")
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, all their columns of whatever name, that overlap no item."""
    texts = common.documents(docs).withColumn("key", _digest(F.col("text")))
    tests = common.documents(items, "item_id").withColumn("key", _digest(F.col("text")))
    (name,) = common.unused(docs, "dirty_key")
    dirty = _verified(texts, tests).select(F.col("key").alias(name)).distinct()
    dirty = common.bounded(common.materialize(dirty, "dirty"), BROADCAST_TEXTS)
    return docs.join(dirty, _digest(docs["text"]) == F.col(name), "left_anti")
