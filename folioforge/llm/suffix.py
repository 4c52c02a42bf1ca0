"""Removal of repeated byte strings by a hash-compared sort of sampled suffixes.

A byte goes if it is covered by a string of ``width`` bytes that starts anywhere else, too.
Every window of that width is represented by one anchor inside it: the leftmost 16-byte gram
with the smallest hash among its first places.  Equal windows have equal anchors, so only
anchors are exchanged, with a polynomial hash of the bytes every window of that anchor contains (k1)
and a cryptographic one of all bytes of its windows together (k2).

* k1 occurs once: none of its windows is repeated.
* (k1, k2) occurs several times: all of its windows are.  Their bytes are not brought together;
  64 bits of a cryptographic hash tell that they agree, besides the 64 of k1.
* Otherwise windows are compared one by one.  The bytes around one anchor of each kind meet by
  k1; suffixes are sorted from the anchors on by mergesort, comparing through prefix hashes
  and a binary search for the common extension; neighbours with equal bytes on both sides are
  repeated windows, checked byte by byte.  Kinds of an overfull k1 are compared by a polynomial
  and a cryptographic hash of every window, 64 bits each, counted in a combining aggregate, so no
  anchor fills a task.

Texts move twice at most: those with windows to compare, one copy of each, and those with spans.
Marks of fixed size, broadcast, keep nearly all others where they are.

A null text is empty.  Texts are compared by place, so repeated rows count as repeats, also of
equal ids; texts shorter than ``width`` lose nothing.  Spans are kept per different text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WIDTH = 400
GRAM = 16
#: Window starts handled at once; longer texts are cut, with overlap.
CHUNK = 1 << 17
#: Kinds of one k1 that are sorted together, and all kinds sorted in one task.
GROUP = 2000
TASK = 2000
PLACE_BITS = np.uint64(28)
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bits of the marks by which texts are kept where they are.
MARKS = 1 << 25

ANCHORS = "k1 long, k2 long, d1 long, d2 long, at int, left int, span int"


def spread(width: int) -> int:
    """Places of a window in which its anchor is sought."""
    return max(1, min(width * 3 // 5, width - GRAM + 1))


# --- hashes --------------------------------------------------------------------------------


@lru_cache(maxsize=6)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Prefixes:
    """Polynomial hashes modulo 2^64 of any part of a buffer."""

    def __init__(self, raw: np.ndarray, base: np.uint64) -> None:
        size = max(1 << 16, 1 << int(len(raw) + 1).bit_length())
        self.inverse = _powers(pow(int(base), -1, 1 << 64), size)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(int(base), size)[: len(raw)],
                  dtype=np.uint64, out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.inverse[begin])


def strong(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Cryptographic hashes of parts of a buffer, 64 bits each."""
    data, new = memoryview(raw), hashlib.blake2b
    return np.frombuffer(b"".join(
        [new(data[i:j], digest_size=8).digest() for i, j in zip(begin.tolist(), end.tolist())]
    ), np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


# --- anchors -------------------------------------------------------------------------------


def anchors(raw: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(k1, k2, at, left, span) of the anchors of all windows that stay within one owner."""
    reach = spread(width)
    if len(raw) < width:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    first = Prefixes(raw, BASE)
    places = np.arange(len(raw) - GRAM + 1)
    grams = first.of(places, places + GRAM)
    low = (grams >> PLACE_BITS << PLACE_BITS) | places.astype(np.uint64)
    step = 1
    while step * 2 <= reach:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    starts = len(raw) - width + 1
    low = np.minimum(low[:starts], low[reach - step : reach - step + starts])
    at = (low & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
    inside = owner[:starts] == owner[width - 1 :]
    begin = np.flatnonzero(inside & ((np.diff(at, prepend=-1) != 0) | ~np.append(False, inside[:-1])))
    stop = np.flatnonzero(inside & ((np.diff(at, append=-1) != 0) | ~np.append(inside[1:], False)))
    at = at[begin]
    k1 = first.of(at, at + width - reach + 1)
    k2 = strong(raw, begin, stop + width) ^ mix(((at - begin) << 20 | (stop - begin)).astype(np.uint64))
    return k1.view(np.int64), k2.view(np.int64), at, at - begin, stop - begin


def _pieces(raws: list[bytes], width: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """The texts' bytes in buffers of bounded size: (text, place of the piece, piece)."""
    who: list[int] = []
    base: list[int] = []
    held: list[bytes] = []
    size = 0
    for i, raw in enumerate(raws):
        for begin in range(0, max(0, len(raw) - width + 1), CHUNK):
            part = raw[begin : begin + CHUNK + width - 1]
            if size + len(part) > 2 * CHUNK and held:
                yield who, base, held
                who, base, held, size = [], [], [], 0
            who.append(i)
            base.append(begin)
            held.append(part)
            size += len(part)
    if held:
        yield who, base, held


def digest(text: str | Column) -> list[Column]:
    """A text's digest in two columns, d1 and d2."""
    text = F.col(text) if isinstance(text, str) else text
    return [F.xxhash64(text).alias("d1"), F.xxhash64(F.lit(7), text).alias("d2")]


def all_anchors(texts: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, d2 = (np.asarray(common.column(batch, c)) for c in ("d1", "d2"))
            raws = [text.encode() for text in common.texts(batch)]
            for who, base, held in _pieces(raws, width):
                sizes = np.array([len(x) for x in held])
                owner = np.repeat(np.arange(len(held)), sizes)
                begin = np.cumsum(sizes) - sizes
                raw = np.frombuffer(b"".join(held), np.uint8)
                k1, k2, at, left, span = anchors(raw, owner, width)
                own = owner[at]
                text = np.array(who)[own]
                where = at - begin[own] + np.array(base)[own]
                columns = [k1, k2, d1[text], d2[text]] + [
                    x.astype(np.int32) for x in (where, left, span)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns],
                    ["k1", "k2", "d1", "d2", "at", "left", "span"])

    return texts.select("d1", "d2", "text").mapInArrow(run, ANCHORS)


# --- suffixes around anchors ---------------------------------------------------------------


class Suffixes:
    """Suffixes of one buffer from the anchors on, compared through prefix hashes."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, length: np.ndarray) -> None:
        self.raw, self.at, self.length = raw, at, length
        self.hashes = Prefixes(raw, BASE)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension, by binary search."""
        low = np.zeros(len(i), np.int64)
        high = np.minimum(self.length[i], self.length[j])
        a, b = self.at[i], self.at[j]
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            same = self.hashes.of(a, a + middle) == self.hashes.of(b, b + middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low

    def less(self, i: np.ndarray, j: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        n = self.common(i, j)
        ends_i, ends_j = n >= self.length[i], n >= self.length[j]
        last = len(self.raw) - 1
        x = self.raw[np.minimum(self.at[i] + n, last)]
        y = self.raw[np.minimum(self.at[j] + n, last)]
        return np.where(ends_i & ends_j, or_equal, np.where(ends_i, True, np.where(ends_j, False, x < y)))

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes by group, then by their bytes: bottom-up mergesort.

        All runs of a level are merged at once: a suffix moves to its place in its own run plus
        the number of suffixes of the partner run before it, found by binary search.
        """
        order = np.argsort(group, kind="stable")
        begin = np.searchsorted(group[order], group[order], side="left")
        end = np.searchsorted(group[order], group[order], side="right")
        width, longest = 1, int((end - begin).max(initial=0))
        index = np.arange(len(order))
        while width < longest:
            run = (index - begin) // width
            low = np.minimum(begin + (run ^ 1) * width, end)
            high = np.minimum(low + width, end)
            first, right = low.copy(), run % 2 == 1
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                # Of equal suffixes those of the left run stay in front.
                before = self.less(order[middle], order[open_], right[open_])
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
            pair = begin + (run // 2) * 2 * width
            place = pair + (index - begin) % width + (low - first)
            # A right run's own places count from its pair's start, too.
            moved = np.empty_like(order)
            moved[place] = order
            order, width = moved, width * 2
        return order


def repeated_windows(
    contexts: list[bytes], group: np.ndarray, left: np.ndarray, span: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """(context, offset) of all windows that another context of the group holds, too.

    A context holds the windows that start ``offset`` bytes before its anchor, for offsets from
    ``left - span`` to ``left``.
    """
    raw = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(c) for c in contexts], np.int64)
    at = np.cumsum(sizes) - sizes + left
    suffixes = Suffixes(raw, at, sizes - left)
    order = suffixes.sort(group)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    who, where = [], []
    for offset in range(int(left.max()) + 1):
        own = np.flatnonzero((offset <= left) & (offset >= left - span))
        if len(own) < 2:
            continue
        before = suffixes.hashes.of(at[own] - offset, at[own])
        own = own[np.lexsort((rank[own], before, group[own]))]
        i, j = own[:-1], own[1:]
        begin_i, begin_j = at[i] - offset, at[j] - offset
        near = np.flatnonzero(
            (group[i] == group[j])
            & (suffixes.hashes.of(begin_i, at[i]) == suffixes.hashes.of(begin_j, at[j]))
            & (suffixes.hashes.of(at[i], begin_i + width) == suffixes.hashes.of(at[j], begin_j + width)))
        if not len(near):
            continue
        # The hashes agree; so must the bytes.
        for cut in range(0, len(near), 4096):
            some = near[cut : cut + 4096]
            bytes_ = np.arange(width)
            same = (raw[begin_i[some, None] + bytes_] == raw[begin_j[some, None] + bytes_]).all(axis=1)
            for side in (i, j):
                who.append(side[some[same]])
                where.append(np.full(int(same.sum()), offset))
    if not who:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.unique(np.stack([np.concatenate(who), np.concatenate(where)], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


# --- marks ---------------------------------------------------------------------------------


def marks_of(digests: DataFrame) -> Broadcast:
    """A bit for every d1; ``MARKS`` bits in all, however many digests there are."""
    bit = F.pmod("d1", F.lit(MARKS))
    word = F.shiftright(bit, 6)
    one = F.expr(f"shiftleft(1L, cast(pmod(d1, {MARKS}) & 63 as int))")
    rows = digests.groupBy(word.alias("word")).agg(F.bit_or(one).alias("bits")).collect()
    marks = np.zeros(MARKS // 64, np.int64)
    for row in rows:
        marks[row.word] = row.bits
    return digests.sparkSession.sparkContext.broadcast(marks)


def marked(marks: np.ndarray, d1: np.ndarray) -> np.ndarray:
    """Whether a digest may be among those that were marked; certainly not, where it is false."""
    bit = d1 % MARKS
    return (marks[bit >> 6] >> (bit & 63)) & 1 == 1


# --- jobs ----------------------------------------------------------------------------------

SPANS = "d1 long, d2 long, begin long, stop long"
CONTEXTS = "k1 long, n long, d1 long, d2 long, at int, left int, span int, bytes binary"


def _first_copies(shared: Broadcast):
    """The first row of every different text (d1, d2) of a task, of texts that are marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            d1, d2 = (np.asarray(common.column(batch, c)) for c in ("d1", "d2"))
            new = []
            for i in np.flatnonzero(marked(shared.value, d1)).tolist():
                key = (int(d1[i]), int(d2[i]))
                if key not in seen:
                    seen.add(key)
                    new.append(i)
            yield batch.take(pa.array(new, pa.int64()))

    return run


def _sorted_kinds(width: int):
    def run(key: tuple, kinds: pa.Table) -> pa.Table:
        seen: dict[tuple, dict] = {}
        for row in kinds.to_pylist():
            # Copies of a text bring the same kind again.
            seen.setdefault((row["k1"], row["d1"], row["d2"], row["at"], row["left"]), row)
        rows = list(seen.values())
        numbers = {name: np.array([r[name] for r in rows], np.int64)
                   for name in ("k1", "n", "d1", "d2", "at", "left", "span")}
        who, offset = repeated_windows(
            [r["bytes"] for r in rows], numbers["k1"], numbers["left"], numbers["span"], width)
        wanted = numbers["n"][who] == 1
        who, begin = who[wanted], numbers["at"][who[wanted]] - offset[wanted]
        order = np.lexsort((begin, who))
        who, begin = who[order], begin[order]
        new = np.flatnonzero((np.diff(who, prepend=-1) != 0) | (np.diff(begin, prepend=-2) != 1))
        last = np.append(new[1:], len(who)) - 1 if len(who) else new
        return pa.table({"d1": numbers["d1"][who[new]], "d2": numbers["d2"][who[new]],
                         "begin": begin[new], "stop": begin[last] + width})

    return run


def _hashed_windows(contexts: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = np.frombuffer(row["bytes"], np.uint8)
                start = np.arange(row["span"] + 1)
                h1 = Prefixes(raw, BASE).of(start, start + width).view(np.int64)
                h2 = strong(raw, start, start + width).view(np.int64)
                same = lambda name: np.full(len(start), row[name])
                yield pa.RecordBatch.from_pydict({
                    "h1": h1, "h2": h2, "n": same("n"), "d1": same("d1"), "d2": same("d2"),
                    "begin": row["at"] - row["left"] + start})

    return contexts.mapInArrow(run, "h1 long, h2 long, n long, d1 long, d2 long, begin long")


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(d1, d2, spans): the covered spans, not merged, of every different text that has any."""
    spark = docs.sparkSession
    common.python_batches(spark, common.SMALL_BATCH_BYTES)
    texts = common.documents(docs).select("text", *digest("text"))
    every = all_anchors(texts, width)
    # Written first: a join with an aggregate in the same stage could not split a hot k1.
    twice = common.materialize(
        every.groupBy("k1").agg(F.count("*").alias("n")).where("n > 1").select("k1"), "repeated")
    shared = common.materialize(every.join(twice, "k1", "left_semi"), "anchors")
    kinds = common.materialize(
        shared.groupBy("k1", "k2").agg(
            F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("d1", "d2", "at", "left", "span"))
        ), "kinds")
    whole = kinds.where("n > 1").select("k1", "k2")  # read from the written table
    spans = shared.join(whole, ["k1", "k2"], "left_semi").select(
        "d1", "d2", (F.col("at") - F.col("left")).cast("long").alias("begin"),
        (F.col("at") - F.col("left") + F.col("span") + width).cast("long").alias("stop")).distinct()

    mixed = common.materialize(
        kinds.groupBy("k1").agg(F.count("*").alias("kinds")).where("kinds > 1"), "mixed")
    parts = common.materialize(kinds.join(mixed, "k1").drop("k2"), "mixed-kinds")
    wanted = parts.groupBy("d1", "d2").agg(F.collect_list(
        F.struct("k1", "kinds", "n", "at", "left", "span")).alias("wanted"))

    kinds_of = pa.schema(
        [(c, pa.int64()) for c in ("k1", "kinds", "n")]
        + [(c, pa.int32()) for c in ("at", "left", "span")]
        + [("d1", pa.int64()), ("d2", pa.int64()), ("bytes", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for row in batch.to_pylist():
                raw = row["text"].encode()
                for kind in row["wanted"]:
                    begin = kind["at"] - kind["left"]
                    out.append(kind | {"d1": row["d1"], "d2": row["d2"],
                                       "bytes": raw[begin : begin + kind["span"] + width]})
                if len(out) > 4000:
                    yield pa.RecordBatch.from_pylist(out, kinds_of)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, kinds_of)

    schema = ("k1 long, kinds long, n long, at int, left int, span int, d1 long, d2 long, "
              "bytes binary")
    # Of a text's copies each task hands on one, and one of those is cut.
    marks = marks_of(parts.select("d1"))
    single = texts.select("d1", "d2", "text").mapInArrow(
        _first_copies(marks), "d1 long, d2 long, text string")
    single = single.groupBy("d1", "d2").agg(F.first("text").alias("text"))
    contexts = single.join(wanted, ["d1", "d2"]).mapInArrow(cut, schema)
    tasks = max(1, parts.where(F.col("kinds") <= GROUP).count() // TASK + 1)
    crowded = not parts.where(F.col("kinds") > GROUP).isEmpty()
    if crowded:
        contexts = common.materialize(contexts, "contexts")
    compared = (
        contexts.where(F.col("kinds") <= GROUP)
        .groupBy(F.pmod(F.col("k1"), F.lit(tasks)).alias("task"))
        .applyInArrow(_sorted_kinds(width), SPANS)
    )
    spans = spans.union(compared)
    if crowded:
        dense = contexts.where(F.col("kinds") > GROUP).drop("kinds").distinct()
        hashed = _hashed_windows(dense, width)
        often = common.materialize(
            hashed.groupBy("h1", "h2").agg(F.count("*").alias("m")).where("m > 1"), "often")
        spans = spans.union(
            hashed.where("n = 1").join(often, ["h1", "h2"], "left_semi")
            .select("d1", "d2", "begin", (F.col("begin") + width).alias("stop")))
    found = spans.groupBy("d1", "d2").agg(F.collect_list(F.struct("begin", "stop")).alias("spans"))
    return common.materialize(found, "spans")


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, stop in sorted((s["begin"], s["stop"]) for s in spans or ()):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((begin, stop))
    return out


def kept(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    ends = [0, *(stop for _, stop in spans)]
    begins = [*(begin for begin, _ in spans), len(raw)]
    return b"".join(raw[i:j] for i, j in zip(ends, begins))


def _with_spans(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` and the name of a column with the spans of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d1, d2, of1, of2, spans = common.unused(docs, "d1", "d2", "of_d1", "of_d2", "spans")
    found = found.select(F.col("d1").alias(of1), F.col("d2").alias(of2), F.col("spans").alias(spans))
    # A text with very many copies is split by adaptive execution.
    keyed = docs.select("*", *(c.alias(name) for c, name in zip(digest(text), (d1, d2))))
    joined = keyed.join(found, (F.col(d1) == F.col(of1)) & (F.col(d2) == F.col(of2)), "left")
    return joined.drop(d1, d2, of1, of2), spans


SUMMARY = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def summaries(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    docs = common.documents(docs)
    found = repeated_spans(docs, width)
    marks = marks_of(found)

    def rows(ids: pa.Array, texts: list[str], spans: list) -> pa.RecordBatch:
        out: list[tuple] = []
        for text, some in zip(texts, spans):
            raw, gone = text.encode(), merged(some)
            rest = kept(raw, gone)
            out.append((len(raw), len(raw) - len(rest), len(gone), hashlib.sha256(rest).hexdigest()))
        columns = list(zip(*out)) if out else [[]] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [ids.cast(pa.int64()), *(pa.array(c, kind) for c, kind in zip(columns, kinds))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(~marked(marks.value, np.asarray(common.column(batch, "d1")))))
            texts = common.texts(batch)
            yield rows(common.column(batch, "doc_id"), texts, [None] * len(texts))

    def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = pa.array(marked(marks.value, np.asarray(common.column(batch, "d1"))))
            yield batch.select(["doc_id", "text"]).filter(some)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield rows(common.column(batch, "doc_id"), common.texts(batch), common.texts(batch, name))

    keyed = docs.select("doc_id", "text", digest("text")[0])
    schema = docs.select(F.col("doc_id"), "text").schema
    # Both sides grow with the documents, so neither is broadcast.
    joined, name = _with_spans(keyed.mapInArrow(open_, schema), found.hint("merge"))
    return keyed.mapInArrow(whole, SUMMARY).union(joined.mapInArrow(cut, SUMMARY))


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents, all their columns, with repeated bytes taken out of ``text``.

    A character cut apart goes whole; a null text stays null.  ``n_chars``, if there, follows.
    """

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([
            text if not found else
            kept(text.encode(), merged(json.loads(found))).decode(errors="ignore")
            for text, found in zip(texts.to_pylist(), spans.to_pylist())], pa.string())

    joined, spans = _with_spans(docs, repeated_spans(docs, width))
    rest = joined.withColumn("text", cut("text", F.to_json(spans)))
    if "n_chars" in docs.columns:
        n = F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text"))
        rest = rest.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType))
    return rest.select(docs.columns)
