"""SimHash, repeated strings, decontamination and components against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import regex
import xxhash

from folioforge.llm import common, components, decontaminate, simhash, suffix
from odd import SMALL, no_documents, odd_documents, odd_rows


def union_find(n, pairs):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def fingerprint(text: str, size: int = 4) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    runs = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_near_duplicates(found, rows):
    """``rows`` are (doc_id, text)."""
    prints = [fingerprint(text) for _, text in rows]
    close = [(i, j) for i, j in combinations(range(len(rows)), 2)
             if (prints[i] ^ prints[j]).bit_count() <= 4]
    roots = union_find(len(rows), close)
    ids = {}
    for i, root in enumerate(roots):
        if rows[i][0] is not None:
            ids[root] = min(rows[i][0], ids.get(root, rows[i][0]))
    wanted = Counter((row[0], f"{prints[i]:016x}", ids.get(roots[i])) for i, row in enumerate(rows))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == wanted


def test_near_duplicates_of_odd_rows_and_whole_documents(spark):
    check_near_duplicates(simhash.near_duplicates(odd_documents(spark)).collect(),
                          [(r[0], r[1]) for r in odd_rows()])
    docs = common.table(spark, SMALL, "documents")
    check_near_duplicates(simhash.near_duplicates(docs).collect(),
                          [(r.doc_id, r.text) for r in docs.collect()])
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


def test_covering_masks_lose_no_pair():
    draw = random.Random(3)
    masks = simhash.covering_masks(4)
    for _ in range(5000):
        flipped = sum(1 << i for i in draw.sample(range(64), draw.randint(0, 4)))
        flipped -= (1 << 64) if flipped >> 63 else 0
        assert any(mask & flipped == 0 for mask in masks)


def test_dense_buckets_keep_all_components(spark):
    draw = random.Random(4)
    centre, bits = draw.getrandbits(64), set()
    while len(bits) < 120:
        bits.add(centre ^ sum(1 << i for i in draw.sample(range(64), draw.randint(0, 5))))
    bits = sorted(bits) + [draw.getrandbits(64) for _ in range(40)]
    signed = [b - (1 << 64) if b >> 63 else b for b in bits]
    nodes = spark.createDataFrame([(b,) for b in signed], "bits long")
    close = [(i, j) for i, j in combinations(range(len(bits)), 2)
             if (bits[i] ^ bits[j]).bit_count() <= 4]
    wanted = union_find(len(bits), close)
    for bucket in (8, 2048):
        found = simhash.links(nodes, bucket=bucket).collect()
        place = {b: i for i, b in enumerate(signed)}
        pairs = [(place[r.u], place[r.v]) for r in found]
        assert all((bits[i] ^ bits[j]).bit_count() <= 4 for i, j in pairs)
        assert union_find(len(bits), pairs) == wanted


def test_roots_of_chains_stars_and_repeated_edges(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(7, 7), (3, 2), (3, 2)]
    found = dict(map(tuple, components.roots(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert found == {**{i: 0 for i in range(41)}, **{x: 100 for x in range(100, 140)}}
    assert components.roots(spark.createDataFrame([], "u long, v long")).count() == 0


def first_of_groups(rows):
    """The (id, text) that stay of (id, text) rows: of each component the smallest id, nulls last."""
    prints = [fingerprint(text) for _, text in rows]
    roots = union_find(len(rows), [(i, j) for i, j in combinations(range(len(rows)), 2)
                                   if (prints[i] ^ prints[j]).bit_count() <= 4])
    ids = {}
    for (name, _), root in zip(rows, roots):
        ids[root] = min(ids.get(root, (True, 0)), (name is None, name or 0))
    return sorted(ids.values())


def test_one_of_each_group_of_near_copies_stays(spark):
    rows = odd_rows()
    kept = simhash.one_per_group(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns
    kept = kept.collect()
    assert Counter(r.doc_id for r in kept).most_common(1)[0][1] == 1
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == first_of_groups(
        [(r[0], r[1]) for r in rows])
    assert {tuple(r) for r in kept} <= set(rows)
    assert simhash.one_per_group(no_documents(spark)).count() == 0


def test_equal_ids_and_texts_leave_one_row_per_group(spark):
    draw = random.Random(23)
    text = lambda: " ".join("".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(80))
    a, b, c = text(), text(), text()
    rows = [(1, a), (1, a), (1, b), (2, b), (None, c), (None, c), (3, a), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter(map(tuple, simhash.one_per_group(docs).collect()))
    assert found == {(1, a): 1, (1, b): 1, (None, c): 1}


# --- repeated strings ----------------------------------------------------------------------


def covered(raws, width):
    count = Counter(raw[i : i + width] for raw in raws for i in range(len(raw) - width + 1))
    masks = []
    for raw in raws:
        mask = np.zeros(len(raw), bool)
        for i in range(len(raw) - width + 1):
            if count[raw[i : i + width]] > 1:
                mask[i : i + width] = True
        masks.append(mask)
    return masks


def check_summaries(found, rows, width):
    raws = [(text or "").encode() for _, text in rows]
    wanted = Counter()
    for (name, _), raw, mask in zip(rows, raws, covered(raws, width)):
        kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
        runs = int((np.diff(mask.astype(int), prepend=0) == 1).sum())
        wanted[name, len(raw), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(tuple(r) for r in found) == wanted


def test_removed_bytes_of_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    check_summaries(suffix.summaries(odd_documents(spark)).collect(), rows, 400)
    assert suffix.summaries(no_documents(spark)).count() == 0


def test_removed_bytes_of_random_texts_on_both_paths(spark, monkeypatch):
    draw = random.Random(9)
    parts = ["".join(draw.choice("abc") for _ in range(draw.randint(5, 90))) for _ in range(25)]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for group in (suffix.GROUP, 3):
        monkeypatch.setattr(suffix, "GROUP", group)
        for width in (40, 63):
            check_summaries(suffix.summaries(docs, width).collect(), rows, width)


def test_a_text_with_many_copies_is_cut_once(spark, monkeypatch):
    draw = random.Random(11)
    text = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    first, middle = text(60), text(70)
    rows = list(enumerate([first + middle] * 50 + [text(60) + middle + text(50), text(60) + middle]))
    written = {}

    def materialize(df, name):
        df = common_materialize(df, name)
        written[name] = df
        return df

    common_materialize = common.materialize
    monkeypatch.setattr(common, "materialize", materialize)
    monkeypatch.setattr(suffix, "GROUP", 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_summaries(suffix.summaries(docs, 40).collect(), rows, 40)
    assert 0 < written["contexts"].count() == written["mixed-kinds"].count()


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(suffix, "CHUNK", 700)
    draw = random.Random(2)
    text = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    shared = text(900)
    raws = [text(2500) + shared + text(333), shared + text(1200), text(5000)]
    owner = np.zeros(1, int)
    assert len(list(suffix._pieces([r.encode() for r in raws], 100))) > 1 and len(owner)
    rows = list(enumerate(raws))
    check_summaries(suffix.summaries(spark.createDataFrame(rows, "doc_id long, text string"), 100).collect(),
                    rows, 100)


def test_suffixes_sort_as_bytes_do():
    draw = random.Random(6)
    texts = [bytes(draw.choice(b"ab") for _ in range(draw.randint(1, 12))) for _ in range(300)]
    group = np.array([draw.randrange(5) for _ in texts])
    sizes = np.array([len(t) for t in texts])
    raw = np.frombuffer(b"".join(texts), np.uint8)
    order = suffix.Suffixes(raw, np.cumsum(sizes) - sizes, sizes).sort(group)
    assert [(group[i], texts[i], i) for i in order] == sorted(
        (group[i], t, i) for i, t in enumerate(texts))


def test_texts_without_repeats_keep_all_columns(spark):
    docs = odd_documents(spark)
    rest = suffix.without_repeats(docs)
    assert rest.columns == docs.columns and rest.count() == docs.count()
    texts = {r.doc_id: r.text for r in rest.collect()}
    assert texts[0] is None and texts[3] == "one" and texts[7] == ""


# --- decontamination -----------------------------------------------------------------------


def items(spark):
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("klmnopqrst") for _ in range(draw.randint(3, 8)))
    first, second = [word() for _ in range(30)], [word() for _ in range(14)]
    rows = [(1, " ".join(first), "x"), (2, " ".join(second), "x"), (3, "too short", "x"), (4, None, "x"),
            (None, " ".join(first), "x")]
    return first, second, spark.createDataFrame(rows, "item_id long, text string, key string")


def test_overlaps_tolerate_substitutions(spark):
    first, second, tests = items(spark)
    changed = [w if i % 6 != 4 else "other" for i, w in enumerate(first)]
    different = [w if i % 2 else "other" for i, w in enumerate(first)]
    filler = ["filler"] * 20
    rows = [
        (1, " ".join([*filler, *first, *filler])), (2, "! ".join([*filler, *changed]).upper()),
        (3, " ".join(different)), (4, " ".join(filler * 30)), (5, " ".join(first[:10] + filler)),
        (6, " ".join(second)), (7, None), (8, ""), (1, " ".join([*filler, *first, *filler])),
        (None, " ".join(second)), (9, " ".join(first[8:25] + filler)),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, seed string")
    found = Counter((r.doc_id, r.item_id) for r in decontaminate.overlaps(docs, tests).collect())
    assert found == {(1, 1): 2, (1, None): 2, (2, 1): 1, (2, None): 1, (6, 2): 1, (None, 2): 1,
                     (9, 1): 1, (9, None): 1}
    kept = decontaminate.clean(docs, tests)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 7, 8]


def test_short_items_are_found_with_a_fifth_of_their_words_changed(spark):
    assert all(n - len(mask) + 1 - mask.count("x") * (n // 5) >= 1 for n in range(1, 300)
               for mask in [next(m for low, m in decontaminate.MASKS if n >= low)])
    draw = random.Random(31)
    tests, rows, wanted = [], [], set()
    for n in [*range(1, 31), 45, 59]:
        item = [f"w{n}x{i}" for i in range(n)]
        tests.append((n, " ".join(item)))
        for _ in range(12):
            changed = list(item)
            for at in draw.sample(range(n), n // 5):
                changed[at] = "other"
            wanted.add((len(rows), n))
            rows.append((len(rows), " ".join(["filler"] * 9 + changed + ["filler"] * 9)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(tests, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(docs, items).collect()}
    assert found == wanted


def test_every_whole_item_in_a_document_is_found(spark):
    docs, tests = (common.table(spark, SMALL, n) for n in ("documents", "benchmark"))
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    texts = {r.doc_id: plain(r.text) for r in docs.collect()}
    wanted = {(d, r.item_id) for r in tests.collect() for d, t in texts.items() if plain(r.text) in t}
    found = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(docs, tests).collect()}
    assert wanted and wanted <= found
    assert decontaminate.overlaps(no_documents(spark), tests).count() == 0
    assert decontaminate.overlaps(docs, tests.limit(0)).count() == 0


def slow_overlaps(doc, item):
    """Whether some alignment of two lists of words is an overlap, by trying all of them."""
    number = {w: i for i, w in enumerate(dict.fromkeys([*doc, *item]))}
    m = len(item)
    padded = np.array([-1] * m + [number[w] for w in doc] + [-1] * m)
    wanted = np.array([number[w] for w in item])
    same = np.lib.stride_tricks.sliding_window_view(padded, m) == wanted
    outside = np.lib.stride_tricks.sliding_window_view(padded, m) < 0
    if (same.sum(axis=1) >= 0.8 * m).any():
        return True
    for row, out in zip(same[same.sum(axis=1) >= 13], outside[same.sum(axis=1) >= 13]):
        now = 0
        for hit, beyond in zip(row.tolist(), out.tolist()):
            now = 0 if beyond else max(0, now + (1 if hit else -4))
            if now >= 13:
                return True
    return False


def test_overlaps_of_whole_tables_are_those_of_all_alignments(spark):
    docs, tests = (common.table(spark, SMALL, n) for n in ("documents", "benchmark"))
    split = lambda t: [w for w in regex.split(r"[^\p{L}\p{N}]+", (t or "").lower()) if w]
    items = [(r.item_id, split(r.text)) for r in tests.collect()]
    wanted = set()
    for r in docs.collect():
        words = split(r.text)
        said = set(words)
        # Fewer words in common than either kind of overlap needs.
        wanted |= {(r.doc_id, i) for i, item in items
                   if sum(w in said for w in item) >= min(13, 0.8 * len(item)) and slow_overlaps(words, item)}
    found = decontaminate.overlaps(docs, tests).collect()
    assert len(found) == len({(r.doc_id, r.item_id) for r in found})
    assert {(r.doc_id, r.item_id) for r in found} == wanted and wanted


def test_decontamination_runs_no_python(spark):
    plan = decontaminate.overlaps(odd_documents(spark), common.table(spark, SMALL, "benchmark"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", text)
