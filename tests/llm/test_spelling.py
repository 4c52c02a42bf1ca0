"""Spelling variants against a comparison of all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from folioforge.llm import common, queries, spelling
from odd import SMALL, no_documents, odd_documents, odd_rows


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def slow_counts(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if doc_id is not None and h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def slow_variants(count):
    by_length = {}
    for w in count:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, ()) if one_edit(w, v)]
            for w in count}
    form = {}
    for w, n in count.items():
        best = min(near[w], key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= 2 * n else None
    rows = set()
    for w, n in count.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, len(near[w]), count[form[w]] if form[w] else None))
    return rows


def random_words(draw, letters, longest, n):
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(5, longest))) for _ in range(n)}
    for w in list(words)[: n // 2]:
        at = draw.randrange(len(w))
        words |= {w[:at] + w[at + 1 :], w[:at] + draw.choice(letters) + w[at:],
                  w[:at] + draw.choice(letters) + w[at + 1 :]}
    return sorted(w for w in words if len(w) >= 5)


def test_acceptor_is_minimal_and_accepts_its_words():
    draw = random.Random(1)
    words = random_words(draw, "ab", 8, 60)
    found = spelling.Acceptor(words)
    used, open_, accepted = set(), [(0, "")], []
    while open_:
        state, done = open_.pop()
        used.add(state)
        accepted += [done] * found.final[state]
        open_ += [(to, done + c) for c, to in found.arcs[state].items()]
    assert sorted(accepted) == words
    # One state per different set of endings.
    endings = {frozenset(w[len(p):] for w in words if w.startswith(p))
               for p in {w[:i] for w in words for i in range(len(w) + 1)}}
    assert len(used) == len(endings)


@pytest.mark.parametrize("letters,longest", [("ab", 9), ("abc", 7), ("abcdefgh", 12), ("aßé", 8)])
def test_composition_gives_every_pair_once(letters, longest):
    draw = random.Random(longest)
    for size in (2, 10, 80):
        words = random_words(draw, letters, longest, size)
        found = [tuple(sorted(p)) for p in spelling.near_words(words)]
        wanted = {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b)}
        assert len(found) == len(set(found)) and set(found) == wanted


def test_equal_heads_and_tails_are_kept():
    words = ["preAxpost", "preBxpost", "prexpost", "preAxypost"]
    assert {tuple(sorted(p)) for p in spelling.near_words(words, 3, 4)} == {
        ("preAxpost", "preBxpost"), ("preAxpost", "prexpost"), ("preBxpost", "prexpost"),
        ("preAxpost", "preAxypost")}
    assert spelling.near_words(["a" * 3000, "a" * 3001, "b" + "a" * 2999], 0, 0) != []


@pytest.mark.parametrize("crowd", [spelling.CROWD, 5, 1])
def test_partitions_lose_and_repeat_no_pair(spark, crowd):
    draw = random.Random(7)
    words = random_words(draw, "ab", 9, 150) + random_words(draw, "xyzué", 7, 150) + [
        "q" * n for n in range(5, 40)] + ["common" + c for c in "abcdefghij"]
    words = sorted(set(words))
    rows = [(w, 3 + i % 50) for i, w in enumerate(words)]
    found = Counter(map(tuple, spelling.near_pairs(
        spark.createDataFrame(rows, "word string, n long"), crowd).collect()))
    count = dict(rows)
    wanted = {(a, b, count[b]) for a in words for b in words if one_edit(a, b)}
    assert set(found) == wanted and set(found.values()) == {1}


def test_variants_of_odd_rows(spark):
    found = spelling.variants(odd_documents(spark), prepare=spelling.misspelt).collect()
    assert Counter(map(tuple, found)) == Counter(
        slow_variants(slow_counts([(r[0], r[1]) for r in odd_rows()])))
    assert spelling.variants(no_documents(spark)).count() == 0


def test_chains_of_forms_lead_to_one_root(spark):
    words = {"aaaaa" + "b" * k: 3 * 2**k for k in range(9)}
    text = " ".join(w for w, n in words.items() for _ in range(n))
    docs = spark.createDataFrame([(1, text), (2, None), (None, "")], "doc_id long, text string")
    found = {r.word: r for r in spelling.variants(docs).collect()}
    top = "aaaaa" + "b" * 8
    assert {r.root for r in found.values()} == {top} and found[top].form is None
    assert all(r.n == words[w] and r.n_near == 1 + (0 < len(w) - 5 < 8) for w, r in found.items())


def test_variants_of_whole_documents(spark):
    docs = common.table(spark, SMALL, "documents").collect()
    found = set(map(tuple, queries.op11_spelling_variants(spark, SMALL).collect()))
    assert found == slow_variants(slow_counts([(r.doc_id, r.text) for r in docs]))
    assert any(r[1] for r in found)
