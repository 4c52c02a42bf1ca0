"""Sharding, quality, urls, licenses, neighbours, and the pipeline."""

from __future__ import annotations

import math
import random
import re
import textwrap
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from folioforge.llm import ann, common, decontaminate, licenses, quality, queries, sharding, suffix, urlfilter
from odd import SMALL, no_documents, odd_documents, odd_rows, sql_table
from pyspark.sql import functions as F
from test_similarity import covered, first_of_groups

# --- sharding ------------------------------------------------------------------------------


def filled_by_turns(shards, slots):
    """The table by following each shard's whole list of preferences."""
    lists = [[(o + k * s) % slots for k in range(slots)]
             for o, s in (sharding.permutation(name, slots) for name in shards)]
    owner = {}
    while len(owner) < slots:
        for i, wishes in enumerate(lists):
            if len(owner) < slots:
                owner[next(w for w in wishes if w not in owner)] = i
    return [owner[s] for s in range(slots)]


def test_lookup_table():
    shards = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(shards, 101)
    assert table == filled_by_turns(shards, 101)
    counts = Counter(table).values()
    assert max(counts) - min(counts) <= 1
    big = sharding.lookup_table(shards)
    fewer = sharding.lookup_table(shards[:-1])
    moved = sum(a != b for a, b in zip(big, fewer) if a != 6)
    assert moved < 0.1 * len(big)


def slot_of(key, piece, slots):
    """Spark's hash of the key column, then of the piece, chained by its seed."""
    h = 42 if key is None else xxhash.xxh64_intdigest(key.encode(), 42)
    if piece:
        h = xxhash.xxh64_intdigest(piece.to_bytes(4, "little"), h)
    h -= (1 << 64) if h >> 63 else 0
    return h % slots


def check_placement(rows, table, slots, key):
    for r in rows:
        assert r.slot == slot_of(r[key], r.piece, slots) and r.shard == table[r.slot]


def test_sharding_of_odd_rows(spark):
    docs = odd_documents(spark)
    table = sharding.lookup_table([f"shard-{i:04d}" for i in range(64)], 257)
    for key in ("text", "lang"):
        found = sharding.assign(docs, [key], slots=257)
        assert found.columns == [c for c in docs.columns if c != "slot"] + ["slot", "shard", "piece"]
        rows = found.collect()
        keep = [i for i, c in enumerate(docs.columns) if c != "slot"]
        assert Counter(tuple(r)[:-3] for r in rows) == Counter(
            tuple(r[i] for i in keep) for r in odd_rows())
        check_placement(rows, table, 257, key)
    assert sharding.assign(no_documents(spark), ["doc_id"], slots=257).count() == 0


def test_whole_documents_are_placed_by_their_source(spark):
    docs = common.table(spark, SMALL, "documents")
    found = queries.op1_shard_documents(spark, SMALL)
    assert found.columns == [*docs.columns, "slot", "shard", "piece"]
    rows = found.collect()
    assert Counter(tuple(r)[:-3] for r in rows) == Counter(map(tuple, docs.collect()))
    table = sharding.lookup_table([f"shard-{i:04d}" for i in range(sharding.SHARDS)])
    check_placement(rows, table, sharding.SLOTS, "source")
    # Sources with more than half a shard's share are in pieces, those with less are whole.
    sizes = Counter(r.source for r in rows)
    pieces = {name: {r.piece for r in rows if r.source == name} for name in sizes}
    limit = len(rows) // (2 * sharding.SHARDS)
    assert all((len(pieces[name]) > 1) == (n > limit) for name, n in sizes.items() if n != limit + 1)
    assert max(Counter(r.shard for r in rows).values()) <= 0.1 * len(rows)


def test_a_hot_key_is_split_and_the_shards_stay_even(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    found = sharding.assign(rows, ["k"], [f"n{i}" for i in range(8)], 4099)
    assert found.where("k = -1").select("shard").distinct().count() > 4
    sizes = [r["count"] for r in found.groupBy("shard").count().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 2 * 6000 / 8
    assert found.where("k != -1 and piece != 0").count() == 0


# --- quality -------------------------------------------------------------------------------


def test_margin_is_the_sum_over_all_pairs():
    draw = np.random.default_rng(3)
    model = quality.Model(0.3, draw.normal(size=50), draw.normal(size=(50, 4)))
    index, value = draw.choice(50, 9, replace=False), draw.normal(size=9)
    wanted = 0.3 + model.weights[index] @ value + sum(
        model.factors[index[i]] @ model.factors[index[j]] * value[i] * value[j]
        for i in range(9) for j in range(i))
    assert np.isclose(quality.margins(model, index, value, np.array([0]))[0], wanted)


def slow_margin(model, text):
    """All pairs of features one by one, features counted letter by letter."""
    words = Counter(text.split())
    weight = {w: math.log1p(n) for w, n in words.items()}
    norm = math.sqrt(sum(x * x for x in weight.values())) or 1.0
    pairs = [(zlib.crc32(w.encode()) % (1 << quality.WORD_BITS), x / norm) for w, x in weight.items()]
    raw = text.encode()
    kinds = [
        lambda b: 97 <= b <= 122, lambda b: 65 <= b <= 90, lambda b: 48 <= b <= 57,
        lambda b: b in b" \t", lambda b: b in b"\n\r", lambda b: b in b".,;:'\"-",
        None, lambda b: b >= 128]
    shares = [sum(map(k, raw)) if k else 0 for k in kinds]
    shares[6] = len(raw) - sum(shares)
    lines = text.split("\n")
    n, size = max(1, sum(words.values())), len(raw)
    values = [math.sqrt(x / max(1, size)) for x in shares] + [
        len(words) / n, max(words.values(), default=0) / n,
        sum(k for w, k in words.items() if not any(c.isalnum() for c in w)) / n,
        len(set(lines)) / len(lines), min(1, size / n / 16),
        min(1, math.log1p(size / len(lines)) / 10), min(1, math.log1p(size) / 14)]
    assert len(values) == quality.STATISTICS
    pairs += [((1 << quality.WORD_BITS) + i * quality.BINS + min(quality.BINS - 1, int(v * quality.BINS)),
               quality.STATISTICS**-0.5) for i, v in enumerate(values)]
    index, value = np.array([i for i, _ in pairs]), np.array([x for _, x in pairs])
    vectors = model.factors[index] * value[:, None]
    products = vectors @ vectors.T
    return model.bias + (model.weights[index] * value).sum() + (products.sum() - np.trace(products)) / 2


def test_scores_of_whole_documents_by_all_pairs(spark):
    docs, labels = (common.table(spark, SMALL, n) for n in ("documents", "labels"))
    model = quality.train(docs, labels)
    found = {r.doc_id: r for r in quality.score(docs, model).collect()}
    for row in docs.collect():
        wanted = 1 / (1 + math.exp(-max(-35, min(35, slow_margin(model, row.text or "")))))
        assert abs(found[row.doc_id].score - wanted) < 1e-6
        assert found[row.doc_id].held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (common.table(spark, folder, n) for n in ("documents", "labels"))
    scored = queries.op3_quality(spark, folder)
    assert scored.count() == docs.count()
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) > 0.93 * len(rows)


def test_quality_of_odd_rows_and_odd_labels(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (3, 0, 0), (3, 1, 0), (7, 1, None), (99, 0, 0), (None, 1, 1), (4, None, 1)],
        "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == len(odd_rows())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in rows if r.predicted)
    nothing = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, nothing).collect()} == {0.5}
    assert quality.score(no_documents(spark), nothing).count() == 0


# --- urls ----------------------------------------------------------------------------------


def by_regex(rules, url):
    best = None
    for rule in sorted(rules, key=lambda r: (len(r.name.encode()), r.verdict == "block", r.name)):
        head, slash, tail = rule.pattern.partition("/")
        part = lambda text, any_: "".join(
            {"*": any_ + "*", "?": any_}.get(c, re.escape(c)) for c in text)
        if re.fullmatch(part(head, "[^/]") + slash + part(tail, "."), url, re.S):
            best = rule
    return best


def test_all_rules_at_once_match_as_one_by_one():
    draw = random.Random(1)
    text = lambda n: "".join(draw.choice("ab./") for _ in range(n))
    rules = [urlfilter.Rule(draw.choice(["allow", "block"]), f"r{i}",
                            "".join(draw.choice("ab./*?") for _ in range(draw.randint(1, 7))).replace("**", "*"))
             for i in range(60)]
    urls = [text(draw.randint(0, 14)) for _ in range(500)]
    automaton = urlfilter.Automaton(rules)
    assert automaton.words > 2
    found = automaton.judge([u.encode() for u in urls])
    for url, i in zip(urls, found):
        wanted = by_regex(rules, url)
        assert (automaton.rules[i] if i >= 0 else None) == wanted, url


def test_urls_of_odd_rows(spark):
    urls = [None, "", "no scheme", "HTTP://Sub.Example.ORG/es/x?y#z", "https://example.org/en/12",
            "http://example.org", "http://notorg/x", "x://a.com/de/://b.org/", "http://h.org:80/fr/",
            "http://ö.example.org/es/ä", "http://org/", "http://" + "a." * 5000 + "org/es/"]
    rows = [(i, u, "x", "x") for i, u in enumerate(urls)] + [(None, urls[3], None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    found = urlfilter.judge_urls(pages, queries.URL_RULES).collect()
    got = {r.page_id: (r.host[:20], r.path, r.rule, r.verdict) for r in found}
    assert len(found) == len(rows)
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == got[None] == ("sub.example.org", "/es/x", "example.org/es/", "block")
    assert got[4][2:] == ("example.org/en/1", "block") and got[5] == ("example.org", "", None, "allow")
    assert got[6][2] is None and got[7] == ("a.com", "/de/://b.org/", "com/de/", "block")
    assert got[8][2] is None and got[9][3] == "block" and got[10][2:] == ("org/", "allow")
    assert got[11][2] == "org/"
    assert urlfilter.judge_urls(pages.limit(0), queries.URL_RULES).count() == 0


# --- licenses ------------------------------------------------------------------------------


def test_license_scan_of_odd_rows(spark):
    mit, gpl = "Released under the MIT License.", licenses.TEMPLATES[9][1]
    rows = [
        ("a/LICENSE", mit), ("a/b/x", "plain words"), ("a/b/c/LICENSE", gpl.upper()), ("a/b/c/y", None),
        ("a/b/c/d/e/z", "more words"), ("q/x", "nothing\n" + mit + "\n" + "word " * 50), ("q/y", ""),
        (None, mit), ("top", gpl), ("a/b/x", "plain words"), ("r/s", "a licence of another kind"),
    ]
    files = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)],
                                  "path string, text string, n int, line string")
    found = {r.n: (r.license, r.basis) for r in licenses.scan(files).collect()}
    assert len(found) == len(rows)
    assert found[0] == ("MIT", "header") and found[1] == found[9] == ("MIT", "directory")
    assert found[2] == ("GPL-3.0", "header") and found[3] == found[4] == ("GPL-3.0", "directory")
    assert found[5] == ("MIT", "header") and found[6] == (None, "none")
    assert found[7] == ("MIT", "header") and found[8][0] == "GPL-3.0" and found[10] == (None, "none")
    assert licenses.scan(files.limit(0)).count() == 0


def wrapped(text, width=60):
    return "\n".join(textwrap.wrap(text, width))


def test_whole_license_texts_and_headers_over_several_lines(spark):
    mit, isc, bsd = (next(t for name, t in licenses.TEMPLATES if name == n and len(t) > 400)
                     for n in ("MIT", "ISC", "BSD-3-Clause"))
    assert mit != isc
    prose = "\n".join(f"word{i} other{i} and more{i} of it" for i in range(60))
    notice = "Licensed under the Apache License, Version 2.0 (the\nLicense); you may not use this\nfile except in compliance with the License."
    gpl = "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n" + prose
    rows = [
        ("p/LICENSE", "MIT License\n\nCopyright (c) 2020 Some Body\n\n" + wrapped(mit)),
        ("p/src/a.py", "x = 1"), ("p/src/deep/b.py", prose), ("q/legal/terms.txt", wrapped(isc, 40)),
        ("q/legal/x", ""), ("q/x", None), ("r/c.py", wrapped(notice) + "\n" + prose), ("r/d.py", prose),
        ("s/COPYING", gpl), ("s/e.py", prose), ("t/f.py", gpl), ("t/g.py", prose),
        ("u/LICENSE.txt", wrapped(bsd, 70)), ("u/h.py", "no license is named here but licensed"),
    ]
    schema = "path string, text string, n int, own string, up string, license string, of_path string, basis int, Similarity int"
    files = spark.createDataFrame([(*r, i, "o", "u", "l", "p", 1, 2) for i, r in enumerate(rows)], schema)
    scanned = licenses.scan(files)
    assert scanned.columns == ["n", "own", "up", "of_path", "path", "license", "basis", "similarity"]
    found = {r.path: (r.license, r.basis) for r in scanned.collect()}
    assert found["p/LICENSE"][0] == "MIT"
    assert found["p/src/a.py"] == found["p/src/deep/b.py"] == ("MIT", "directory")
    assert found["q/legal/terms.txt"][0] == "ISC" and found["q/legal/x"] == ("ISC", "directory")
    assert found["q/x"] == (None, "none")
    # A header in the middle of a program is its own, and no license of its folder.
    assert found["r/c.py"] == ("Apache-2.0", "header") and found["r/d.py"] == (None, "none")
    # A long text counts for its folder if it is named like a license file.
    assert found["s/COPYING"] == ("GPL-3.0", "header") and found["s/e.py"] == ("GPL-3.0", "directory")
    assert found["t/f.py"] == ("GPL-3.0", "header") and found["t/g.py"] == (None, "none")
    assert found["u/LICENSE.txt"][0] == "BSD-3-Clause" and found["u/h.py"] == ("BSD-3-Clause", "directory")
    again = {r.path: r.similarity for r in scanned.collect()}
    assert again["p/LICENSE"] > 0.9 and again["p/src/a.py"] == again["p/LICENSE"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        sql_table(con, SMALL, table)
    found = queries.REGISTRY[name](spark, SMALL)
    result = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(found.columns)
    assert Counter(map(tuple, found.select(columns).collect())) == Counter(result.fetchall())


def test_license_scan_runs_no_python(spark):
    plan = queries.op10_license_scan(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)


# --- neighbours ----------------------------------------------------------------------------


def exact(rows, ids, k):
    vectors = np.array([v for _, v in rows], float)
    names = np.array([i for i, _ in rows])
    out = {}
    for q in ids:
        at = next(n for n, (i, _) in enumerate(rows) if i == q)
        score = (vectors * vectors[at]).sum(axis=1)
        best = [n for n in np.lexsort((names, -score)) if names[n] != q][:k]
        out[q] = [(int(names[n]), score[n]) for n in best]
    return out


def test_recall_over_all_rows(spark):
    table = common.table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    found = ann.nearest(table, F.col("vec_id") % 20 == 0).collect()
    wanted = exact(rows, [i for i, _ in rows if i % 20 == 0], 20)
    got = {q: {r.vec_id for r in found if r.query_id == q} for q in wanted}
    assert len(found) == 20 * len(wanted)
    assert np.mean([len(got[q] & {i for i, _ in wanted[q]}) / 20 for q in wanted]) >= 0.9


def test_ties_blocks_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROWS", 16)
    monkeypatch.setattr(ann, "QUERIES", 4)
    draw = np.random.default_rng(2)
    same = [1.0, 2.0, -0.5]
    rows = [(i, same if i % 3 else draw.normal(size=3).tolist()) for i in range(1, 200)]
    odd = [(0, None), (20, []), (40, [0.0, 0.0, 0.0]), (60, [float("nan"), 1.0, 1.0]), (80, [1.0, None, 2.0]),
           (None, same), (100, [1.0, 2.0]), (300, [3.0, 1.0])]
    rows = [r for r in rows if r[0] not in {i for i, _ in odd}]
    table = spark.createDataFrame([(*r, "x") for r in rows + odd],
                                  "vec_id long, embedding array<double>, codes string")
    found = ann.nearest(table, F.col("vec_id") % 20 == 0, share=1.0).orderBy("query_id", "rank").collect()
    wanted = exact(rows, [i for i, _ in rows if i % 20 == 0], 20)
    wanted |= {100: [(300, 5.0)], 300: [(100, 5.0)]}
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == wanted
    assert ann.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# --- pipeline ------------------------------------------------------------------------------


def texts_frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string")


def test_pipeline_stages(spark):
    docs = common.table(spark, SMALL, "documents")
    columns, kept = docs.columns, docs
    texts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = common.materialize(stage(spark, kept, SMALL), name)
        assert kept.columns == columns
        texts.append({r.doc_id: r.text for r in kept.collect()})
    good, single, cut, clean = texts
    scores = {r.doc_id: r.predicted for r in queries.op3_quality(spark, SMALL).collect()}
    assert set(good) == {i for i, p in scores.items() if p}
    # One of each group of near copies stays: the smallest id.
    assert [(False, i) for i in sorted(single)] == first_of_groups(list(good.items()))
    # What is cut is covered by strings that repeat; a character cut apart goes whole.
    raws = [(t or "").encode() for t in single.values()]
    for (i, raw), mask in zip(zip(single, raws), covered(raws, corpus_pipeline.REPEAT_BYTES)):
        assert (cut[i] or "") == np.frombuffer(raw, np.uint8)[~mask].tobytes().decode(errors="ignore")
    found = decontaminate.overlaps(texts_frame(spark, cut), common.table(spark, SMALL, "benchmark"))
    assert set(cut) - set(clean) == {r.doc_id for r in found.collect()}
    assert set(cut) == set(single) and set(clean) <= set(cut)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(clean)


def test_pipeline_workers_get_small_batches_and_no_pandas(spark):
    docs = common.table(spark, SMALL, "documents").limit(20)
    for name, stage in corpus_pipeline.STAGES:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        out = stage(spark, docs, SMALL)
        if name == "decontamination":
            continue
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(common.SMALL_BATCH_BYTES)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "PANDAS" not in plan.upper()
    assert not hasattr(quality, "pd") and not hasattr(suffix, "pd")


def test_pipeline_of_odd_rows_and_nothing(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = common.materialize(stage(spark, docs, SMALL), name)
        assert (docs.count() > 0) == (n > 0)
