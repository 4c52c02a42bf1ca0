"""Periodic runs against a search of all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from folioforge.llm import common, queries, runs
from odd import SMALL, no_documents, odd_documents, odd_rows


def slow_runs(words, min_length=12):
    """(start, length, period) of all runs: for each period the stretches that keep it."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        same = [words[i] == words[i + q] for i in range(n - q)] + [False]
        start = None
        for i, hit in enumerate(same):
            if hit and start is None:
                start = i
            elif not hit and start is not None:
                length = i + q - start
                # A stretch with a shorter period is a run of that one.
                if length >= max(min_length, 2 * q) and not any(
                        s <= start and start + length <= s + m for s, m in found):
                    found[start, length] = q
                start = None
    return sorted((s, n, q) for (s, n), q in found.items())


def slow_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    found = slow_runs(words)
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in sorted(found, key=lambda r: (r[0], r[2])))
    rest = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest())


def found_in(words, min_length=12):
    return sorted(runs.runs_of([[str(w).encode() for w in words]], min_length)[0])


@pytest.mark.parametrize("letters,size", [(1, 40), (2, 60), (2, 200), (3, 120), (5, 80)])
def test_runs_of_random_words(letters, size):
    draw = random.Random(letters * size)
    for _ in range(60):
        words = [draw.randrange(letters) for _ in range(draw.randint(0, size))]
        if draw.random() < 0.5 and words:
            part = words[: draw.randint(1, len(words))]
            words = words + part * draw.randint(1, 4) + words[: draw.randint(0, 3)]
        for least in (12, 5, 4):
            assert found_in(words, least) == slow_runs(words, least)


def test_runs_within_runs_and_powers():
    fibonacci = [["b"], ["a"]]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    square = ["x"] * 9 + ["y"]
    for words in (fibonacci[-1], (square * 3 + ["z"]) * 3, ["x"] * 500, ["x", "y"] * 200 + ["x"] * 30,
                  list(range(400)) * 2, [*range(100), *range(50), *range(100), *range(50)]):
        assert found_in(words) == slow_runs(words)


def test_texts_of_a_chunk_share_nothing(monkeypatch):
    draw = random.Random(3)
    texts = [[draw.choice([b"a", b"b"]) for _ in range(draw.randint(0, 60))] for _ in range(80)]
    wanted = [slow_runs(words) for words in texts]
    for chunk in (runs.CHUNK, 100):
        monkeypatch.setattr(runs, "CHUNK", chunk)
        assert [sorted(r) for r in runs.runs_of(texts)] == wanted
    words = [b"a"] * 50
    assert runs.runs_of([words[:6], words[6:12]]) == [[], []]


def test_large_classes_are_merged_by_sorting(monkeypatch):
    monkeypatch.setattr(runs, "FEW", 1)
    draw = random.Random(4)
    for _ in range(40):
        words = [draw.randrange(2) for _ in range(30)] * 3 + [draw.randrange(2) for _ in range(60)]
        assert found_in(words) == slow_runs(words)


def test_runs_of_odd_rows(spark):
    odd = odd_documents(spark)
    found = runs.periodic_runs(odd, prepare=runs.planted, keep_runs=True).collect()
    short = [r for r in odd_rows() if len((r[1] or "").split()) < 3000]
    wanted = Counter(slow_row(r[0], r[1]) for r in short)
    got = Counter(tuple(r)[:-1] for r in found)
    assert wanted <= got and sum(got.values()) == len(odd_rows())
    assert runs.periodic_runs(no_documents(spark)).count() == 0
    assert runs.planted(None, [b"a"] * 30) == [b"a"] * 30


def test_runs_of_whole_documents(spark):
    """Every document of the smallest tables; long ones are searched by arrays."""
    found = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, SMALL).collect()}
    docs = common.table(spark, SMALL, "documents").collect()
    assert set(found) == {r.doc_id for r in docs}
    some = 0
    for row in docs:
        if len(row.text or "") < 9000:
            assert found[row.doc_id] == slow_row(row.doc_id, row.text)
            some += found[row.doc_id][1] > 0
    assert some > 5


def test_planted_tails_are_found_in_long_texts():
    draw = np.random.default_rng(5)
    words = [b"%d" % x for x in draw.integers(0, 4000, 30_000)]
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    for i in ids:
        g = zlib.crc32(str(i).encode()) // 10
        a = g % len(words)
        period = 1 + (len(words) - a) // (3 + g % 8)
        (found,) = [r for r in runs.runs_of([runs.planted(i, words)])[0] if r[2] == period]
        assert found[0] <= a and found[0] + found[1] == len(words)
