"""Spelling variants: words one edit apart, found by composing finite-state machines.

The words and their counts come out of whole texts, counted per task before anything moves.
Two words are near if one inserted, deleted or replaced character turns one into the other.
The minimised acceptor A of a set of words, a transducer E for one edit and A again are composed:
the composition's states are (state of A, edits done, state of A), before the edit twice the
same state, after it two states whose common strings are enumerated.  Every accepted pair is a
pair of near words.

The vocabulary is never in one place.  Of two near words of m or m + 1 characters the first half
or the last half is the same, so words meet in partitions of equal halves, each of which starts
the composition in the state behind that half.  A partition with more than ``CROWD`` words is
halved again around the place of the edit, down to one character, where the alphabet bounds it;
so no pair is lost.  Each pair belongs to one partition by the length of its common prefix.

Every word points to the form of its own; chains are followed by pointer doubling.  A form has
at least twice its word's count, so there are no cycles and chains are short.

A null text has no words.  A null id changes no word; repeated ids and rows count as they stand;
an empty table gives no rows.  Only ``doc_id`` and ``text`` are read, so other columns may have
any name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import combinations, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Fixed value: the letters of words; A-Z are in lower case by then.
WORD = re.compile("[a-zÀ-ÿ]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
#: Different words counted in a task before they are handed on.
HELD = 400_000
#: Words of one partition that are composed at once; larger ones are halved.
CROWD = 20_000
ROWS_PER_TASK = 60_000

Prepare = Callable[[int | None, dict[str, int]], Iterator[tuple[str, int]]]


# --- words ---------------------------------------------------------------------------------


def misspelt(doc_id: int | None, words: dict[str, int]) -> Iterator[tuple[str, int]]:
    """The words of a document with a character deleted in one of 97, by a checksum."""
    begin = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
    for word, n in words.items():
        if begin is not None:
            h = zlib.crc32(word.encode(), begin)
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
        yield word, n


def word_counts(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
    prepare: Prepare | None = None,
) -> DataFrame:
    """(word, n) of all words of at least ``min_length`` characters with ``min_count`` uses.

    ``prepare`` changes a document's words, which come with their counts, first.
    """
    common.python_batches(docs.sparkSession)

    def flushed(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(total.keys()), pa.string()), pa.array(list(total.values()), pa.int64())],
            ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            ids = common.column(batch, "doc_id").cast(pa.int64()).to_pylist()
            for doc_id, raw in zip(ids, common.texts(batch, "raw")):
                words = Counter(WORD.findall(raw.translate(LOWER).decode(errors="replace")))
                for word, n in prepare(doc_id, words) if prepare else words.items():
                    if len(word) >= min_length:
                        total[word] += n
                if len(total) > HELD:
                    yield flushed(total)
                    total = Counter()
        yield flushed(total)

    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw")
    counted = docs.select("doc_id", raw).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- finite-state machines -----------------------------------------------------------------


class Acceptor:
    """The minimal acceptor of a sorted list of different strings, built word by word."""

    def __init__(self, words: list[str]) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        known: dict[tuple, int] = {}
        path: list[tuple[int, str, int]] = []
        last = ""

        def settle(depth: int) -> None:
            """States below ``depth`` will not change: equal ones become one."""
            while len(path) > depth:
                parent, letter, child = path.pop()
                key = (self.final[child], *self.arcs[child].items())
                self.arcs[parent][letter] = known.setdefault(key, child)

        for word in words:
            depth = same_prefix(last, word)
            settle(depth)
            state = path[-1][2] if path else 0
            for letter in word[depth:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[state][letter] = child = len(self.arcs) - 1
                path.append((state, letter, child))
                state = child
            self.final[state] = True
            last = word
        settle(0)


def same_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


class OneEdit:
    """The composition of an acceptor, a one-edit transducer and the acceptor."""

    def __init__(self, acceptor: Acceptor) -> None:
        self.arcs, self.final = acceptor.arcs, acceptor.final
        self.alive: dict[tuple[int, int], bool] = {}

    def meets(self, p: int, q: int) -> bool:
        """Whether states (p, edited, q) lead to an accepted pair."""
        if p == q:
            return True
        key = (p, q) if p < q else (q, p)
        known = self.alive.get(key)
        if known is not None:
            return known
        seen, open_ = {key}, [key]
        while open_:
            a, b = open_.pop()
            if a == b or (self.final[a] and self.final[b]) or self.alive.get((a, b)):
                self.alive[key] = True
                return True
            if self.alive.get((a, b)) is False:
                continue
            left, right = self.arcs[a], self.arcs[b]
            for letter in left.keys() & right.keys():
                x, y = left[letter], right[letter]
                pair = (x, y) if x < y else (y, x)
                if pair not in seen:
                    seen.add(pair)
                    open_.append(pair)
        self.alive.update(dict.fromkeys(seen, False))
        return False

    def shared(self, p: int, q: int, but: str = "") -> Iterator[str]:
        """The strings accepted from both states that do not start with ``but``."""
        open_ = [(p, q, "")]
        while open_:
            a, b, done = open_.pop()
            if self.final[a] and self.final[b]:
                yield done
            left, right = self.arcs[a], self.arcs[b]
            for letter in left.keys() & right.keys():
                if (done or letter != but) and self.meets(left[letter], right[letter]):
                    open_.append((left[letter], right[letter], done + letter))

    def pairs(self) -> Iterator[tuple[str, str]]:
        """All pairs of accepted strings one edit apart, each once."""
        open_ = [(0, "")]
        while open_:
            state, done = open_.pop()
            arcs = self.arcs[state]
            for letter, to in arcs.items():
                open_.append((to, done + letter))
            if len(arcs) > 1:
                for (c, r), (d, s) in combinations(arcs.items(), 2):
                    if self.meets(r, s):
                        for rest in self.shared(r, s):
                            yield done + c + rest, done + d + rest
            if len(arcs) > 1 or self.final[state]:
                # A letter put in stands as late as it can, so that a pair comes once.
                for letter, to in arcs.items():
                    for rest in self.shared(state, to, letter):
                        yield done + rest, done + letter + rest


def near_words(words: list[str], head: int = 0, tail: int = 0) -> list[tuple[str, str]]:
    """All pairs one edit apart of different words with an equal head and tail of these lengths."""
    if len(words) < 2:
        return []
    first = words[0]
    begin, end = first[:head], first[len(first) - tail :]
    parts = sorted(word[head : len(word) - tail] for word in words)
    return [(begin + a + end, begin + b + end) for a, b in OneEdit(Acceptor(parts)).pairs()]


# --- partitions ----------------------------------------------------------------------------
#
# (m, head, tail, below): pairs whose shorter word has m characters, which agree in the first
# ``head`` and the last ``tail`` ones and whose common prefix is shorter than ``below``.

PART = ["m", "head", "tail", "below", "front", "back"]


def _halves(df: DataFrame) -> DataFrame:
    """Both halves of each partition: the edit lies behind the middle, or before it."""
    free = F.col("m") - F.col("head") - F.col("tail")
    middle = (F.col("head") + F.ceil(free / 2)).cast("int")
    late = F.struct(middle.alias("head"), F.col("tail").alias("tail"), F.col("below").alias("below"))
    early = F.struct(F.col("head").alias("head"),
                     (F.col("tail") + F.floor(free / 2)).cast("int").alias("tail"),
                     middle.alias("below"))
    split = df.select("word", "n", "m", F.inline(F.array(late, early)))
    return split.select(
        "word", "n", *PART[:4], F.substring(F.col("word"), F.lit(1), F.col("head")).alias("front"),
        F.right(F.col("word"), F.col("tail")).alias("back"))


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The near words of partitions that come sorted, one after the other."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))

    out: tuple[list, list, list] = ([], [], [])

    def flushed() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())],
            ["word", "near", "near_n"])
        for column in out:
            column.clear()
        return batch

    for (m, head, tail, below, *_), group in groupby(rows(), key=lambda row: row[:6]):
        counts = {row[6]: row[7] for row in group}
        if len(counts) < 2:
            continue
        for a, b in near_words(list(counts), head, tail):
            # Two words of m + 1 characters belong to another partition.
            if min(len(a), len(b)) == m and same_prefix(a, b) < below:
                for column, values in zip(out, ((a, b), (b, a), (counts[b], counts[a]))):
                    column.extend(values)
        if len(out[0]) > 50_000:
            yield flushed()
    yield flushed()


def near_pairs(vocabulary: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word, near, near_n): every pair of near words, both ways round, of (word, n) rows."""
    length = F.length("word")
    whole = vocabulary.select(
        "word", "n", F.explode(F.array(length, length - 1)).alias("m")).select(
        "word", "n", "m", F.lit(0).alias("head"), F.lit(0).alias("tail"),
        (F.col("m") + 1).alias("below"))
    rows = common.materialize(_halves(whole.where("m > 0")), "halves")
    ready = None
    while True:
        crowds = rows.groupBy(*PART).agg(F.count("*").alias("members")).where(
            (F.col("members") > crowd) & (F.col("m") - F.col("head") - F.col("tail") > 1))
        crowds = common.materialize(crowds.select(*(F.col(c).alias(f"of_{c}") for c in PART)), "crowds")
        on = [F.col(c) == F.col(f"of_{c}") for c in PART]
        if crowds.isEmpty():
            ready = rows if ready is None else ready.unionByName(rows)
            break
        small = rows.join(crowds, on, "left_anti")
        ready = small if ready is None else ready.unionByName(small)
        rows = common.materialize(_halves(rows.join(crowds, on, "left_semi")), "halves")
    ready = common.materialize(ready, "partitions")
    tasks = ready.count() // ROWS_PER_TASK + 1
    dealt = ready.repartition(tasks, *PART).sortWithinPartitions(*PART)
    return dealt.select(*PART, "word", "n").mapInArrow(_composed, "word string, near string, near_n long")


# --- forms ---------------------------------------------------------------------------------


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of acyclic (word, up) rows: every round doubles the steps taken."""
    while True:
        further = links.select(F.col("word").alias("of_word"), F.col("up").alias("next"))
        links = common.materialize(
            links.join(further, F.col("up") == F.col("of_word"), "left").select(
                "word", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("moved")),
            "roots")
        if links.where("moved").isEmpty():
            return links.select("word", F.col("up").alias("root"))
        links = links.select("word", "up")


def variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
    prepare: Prepare | None = None,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts.

    ``form`` is the commonest near word (of equally common ones the first in code-point order) if
    it has at least ``ratio`` times the word's count; ``root`` is the last of the forms' chain.
    """
    if ratio < 2:
        raise ValueError("a form must have a larger count than its word, or chains would not end")
    vocabulary = common.materialize(word_counts(docs, min_length, min_count, prepare), "vocabulary")
    best: Column = F.min(F.struct((-F.col("near_n")).alias("c"), "near"))
    near = near_pairs(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("m"))
    near = near.select(F.col("word").alias("of"), "n_near", F.col("m.near").alias("near"),
                       (-F.col("m.c")).alias("near_n"))
    found = vocabulary.join(near, F.col("word") == F.col("of"), "left")
    enough = F.col("near_n") >= ratio * F.col("n")
    words = common.materialize(found.select(
        "word", F.when(enough, F.col("near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("near_n")).alias("form_n")), "words")
    links = words.where("form is not null").select("word", F.col("form").alias("up"))
    root = _roots(common.materialize(links, "forms")).withColumnRenamed("word", "of")
    return words.join(root, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
