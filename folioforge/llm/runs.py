"""Periodic runs of words by uniting suffix classes in order of falling common prefixes.

A run is a stretch of words with smallest period q, at least ``max(min_length, 2 q)`` long, that
no neighbouring word extends.  Suffixes of each text are sorted by prefix doubling; neighbours
with a common prefix are the edges of a forest, united from the longest prefix down (Kruskal).
Every class holds its positions in order.  When a union at prefix length l makes two positions
adjacent whose distance is d <= l, the words from the first on have period d over d + l words,
and no shorter one, since its position would lie between the two.  The pair seeds a run if the
word before does not extend it, so every run is found once, at its first word.

A run of ``min_length`` words needs a common prefix of half that, so only few positions of
natural text are sorted beyond their first words.  All comparisons are of words, none of hashes.

A null text has no words; a null id plants nothing.  Repeated ids and rows are judged one by
one, an empty table gives none.  Only ``doc_id`` and ``text`` are read, so other columns may have
any name.  A document is worked on in one task, in memory that grows with its own length.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MIN_LENGTH = 12
#: Words of several documents that are sorted together; a longer document is sorted alone.
CHUNK = 1 << 17
#: Positions of a smaller class inserted one by one; more are merged by sorting.
FEW = 8

Run = tuple[int, int, int]  # start, length, period
Prepare = Callable[[int | None, list[bytes]], list[bytes]]


# --- suffixes ------------------------------------------------------------------------------


def suffix_edges(
    ids: np.ndarray, end: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, lcp) of neighbours in suffix order that share at least ``least`` words.

    ``ids`` are the words' numbers, ``end`` the end of each position's own text: suffixes of
    different texts share nothing.
    """
    n = len(ids)
    if n < 2:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    base = int(ids.max()) + 2
    place = np.arange(n)
    second = np.where(place + 1 < end, np.append(ids[1:], 0) + 1, 0)
    # Texts in order of their ends; within one by the first two words.
    pair = ids * base + second
    order = np.lexsort((pair, end))
    fresh = np.ones(n, bool)
    fresh[1:] = (pair[order[1:]] != pair[order[:-1]]) | (end[order[1:]] != end[order[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels = [(2, rank.astype(np.int32))]
    width = 2
    while True:
        # Slots of classes with several members; a class keeps its slots while it is split.
        lone = fresh & np.append(fresh[1:], True)
        slots = np.flatnonzero(~lone)
        if not len(slots):
            break
        who = order[slots]
        after = np.where(who + width < end[who], rank[np.minimum(who + width, n)] + 1, 0)
        key = rank[who] * (n + 1) + after
        by = np.argsort(key, kind="stable")
        who, key = who[by], key[by]
        order[slots] = who
        new = np.ones(len(who), bool)
        new[1:] = key[1:] != key[:-1]
        fresh[slots] = new
        rank[who] = np.maximum.accumulate(np.where(new, slots, 0))
        width *= 2
        levels.append((width, rank.astype(np.int32)))
    # Neighbours that share the words of the last level below ``least``.
    near = max((k for k, (w, _) in enumerate(levels) if w <= least), default=0)
    known = levels[near][1]
    at = np.flatnonzero(known[order[1:]] == known[order[:-1]])
    i, j = order[at], order[at + 1]
    lcp = np.zeros(len(at), np.int64)
    for width, ranks in reversed(levels):
        same = ranks[i + lcp] == ranks[j + lcp]
        lcp += np.where(same, width, 0)
    padded = np.append(ids, -1)
    open_ = (i + lcp < end[i]) & (j + lcp < end[j])
    lcp += open_ & (padded[np.minimum(i + lcp, n)] == padded[np.minimum(j + lcp, n)])
    far = lcp >= least
    return i[far], j[far], lcp[far]


def find_runs(
    ids: np.ndarray, begin: np.ndarray, end: np.ndarray, min_length: int = MIN_LENGTH
) -> list[Run]:
    """The runs of all texts of a buffer, starts counted from the buffer's first word.

    ``begin`` and ``end`` are those of each position's own text.
    """
    if min_length < 4:
        raise ValueError("runs of fewer than four words are not looked for")
    i, j, lcp = suffix_edges(ids, end, -(-min_length // 2))
    by = np.argsort(-lcp, kind="stable")
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    found: list[Run] = []
    first = begin.tolist() if len(by) else []
    word = ids.tolist() if len(by) else []

    def root(x: int) -> int:
        top = parent.get(x, x)
        while top != x:
            above = parent.get(top, top)
            parent[x] = above
            x, top = above, parent.get(above, above)
        return x

    def seed(a: int, b: int, common_: int) -> None:
        """``a`` and ``b`` > ``a`` have become neighbours."""
        d = b - a
        if d <= common_ and d + common_ >= min_length and (
                a == first[a] or word[a - 1] != word[b - 1]):
            found.append((a, d + common_, d))

    for a, b, n in zip(i[by].tolist(), j[by].tolist(), lcp[by].tolist()):
        a, b = root(a), root(b)
        large, small = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(large) < len(small):
            large, small, a, b = small, large, b, a
        parent[b] = a
        last = len(small) - 1
        for k, x in enumerate(small):
            at = bisect_left(large, x)
            # Only neighbours from the other class are new, and only if none lies between.
            if at and (not k or small[k - 1] < large[at - 1]):
                seed(large[at - 1], x, n)
            if at < len(large) and (k == last or small[k + 1] > large[at]):
                seed(x, large[at], n)
        if last < FEW:
            for x in small:
                insort(large, x)
        else:
            large.extend(small)
            large.sort()
        members[a] = large
    return found


# --- documents -----------------------------------------------------------------------------


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a periodic tail planted in one of ten documents, by a checksum of the id."""
    if doc_id is None or not words:
        return words
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a : a + p]
    return words[:a] + (tail * (-(-(n - a) // p)))[: n - a]


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that lie in no run, or in the first period of each run they lie in."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, n in zip(words, np.cumsum(gone[:-1]).tolist()) if not n]


def _summary(words: list[bytes], runs: list[Run]) -> tuple:
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in sorted(runs, key=lambda r: (r[0], r[2])))
    start, length, period = best or (None, None, None)
    return (
        len(runs), start, length, period, best and 1000 * length // period,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(b" ".join(kept_words(words, runs))).hexdigest(),
    )


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[Run]]:
    """The runs of each text, in no order; texts are sorted together up to ``CHUNK`` words."""
    found: list[list[Run]] = [[] for _ in texts]
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= CHUNK):
            size += len(texts[stop])
            stop += 1
        some = texts[at:stop]
        number = {w: k for k, w in enumerate(set().union(*some))}
        ids = np.fromiter((number[w] for words in some for w in words), np.int64, size)
        sizes = np.array([len(words) for words in some])
        begin = np.cumsum(sizes) - sizes
        own = np.repeat(np.arange(at, stop), sizes)
        first = np.repeat(begin, sizes)
        for start, length, period in find_runs(ids, first, np.repeat(begin + sizes, sizes), min_length):
            found[own[start]].append((int(start - first[start]), length, period))
        at = stop
    return found


SUMMARY = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)
RUNS = "runs array<struct<start:long,length:long,period:long>>"


def periodic_runs(
    docs: DataFrame, min_length: int = MIN_LENGTH, prepare: Prepare | None = None,
    keep_runs: bool = False,
) -> DataFrame:
    """One row per document: its number of runs, the longest one and digests.

    ``collapsed_sha256`` is of the words left when each run keeps its first period only.
    ``prepare`` changes the words of a document first; ``keep_runs`` adds all runs.
    """
    common.python_batches(docs.sparkSession)
    types = [pa.int64()] * 5 + [pa.string()] * 2
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
             "collapsed_sha256"]
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = common.column(batch, "doc_id").cast(pa.int64())
            texts = [raw.split() for raw in common.texts(batch, "raw")]
            if prepare:
                texts = [prepare(i, words) for i, words in zip(doc_ids.to_pylist(), texts)]
            found = runs_of(texts, min_length)
            rows = [_summary(words, runs) for words, runs in zip(texts, found)]
            columns = list(zip(*rows)) if rows else [[]] * 7
            arrays = [doc_ids, *(pa.array(c, t) for c, t in zip(columns, types))]
            if keep_runs:
                arrays.append(pa.array(
                    [[dict(zip(("start", "length", "period"), r)) for r in sorted(runs)]
                     for runs in found], kind))
            yield pa.RecordBatch.from_arrays(
                arrays, ["doc_id", *names, *(["runs"] if keep_runs else [])])

    # Bytes, not strings: words end at blanks and the controls 9 to 13 alone.
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw")
    schema = SUMMARY + (f", {RUNS}" if keep_runs else "")
    return docs.select("doc_id", raw).mapInArrow(run, schema)
