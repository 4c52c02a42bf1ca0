"""Log-likelihoods by a gated recurrent language model, trained here on the documents' words.

Words are counted over all training documents.  The ``words`` commonest are the model's own; any
other word belongs to one of ``TAILS`` groups by its last letters, which the model predicts like
a word, and within a group words have probabilities by their counts over the whole corpus, with
one share for a word never seen.  So every token has a probability, and those of all words sum
to one.

The model is a gated recurrent unit.  Its output is factored: a softmax over classes of words of
alike frequency, then one over the words of the class.  It starts from the words' frequencies and
is trained with numpy by backpropagation truncated at ``STEPS`` words, while the state runs on
through a document's windows.  All training documents are used once: they are dealt out to tasks
in ``ROUNDS`` rounds, every task trains a copy of the model, and the copies are averaged, summed
block by block in the tasks.  A model has a fixed size, whatever the corpus; only that reaches the
driver.  Documents are scored whole, their state carried from window to window.

Counts of words beyond ``KNOWN`` are joined, not broadcast: documents bring out such words with
their number.  A word that common in training is never one of them.

A null text is an empty one and holds the end token alone.  A null id belongs to the training
documents.  Repeated ids and rows count and are scored one by one; without training documents
all words are unseen; an empty table gives no rows.  Only ``doc_id`` and ``text`` are read, so
other columns may have any name.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
END = b""
FOLDS, HELD_FOLD = 7, 2

#: Words whose counts go to every task, and words the model has of its own.
KNOWN = 1 << 18
WORDS = 2048
TAILS = 64
CLASSES = 24
EMBEDDING, HIDDEN = 16, 24
ROUNDS = 4
#: Tokens that one task trains on in a round.
TASK_TOKENS = 2_000_000
STEPS, LANES = 16, 256
LONGEST = 1024
SCORE_STEPS, SCORE_LANES = 32, 512
#: Tokens scored at once, so that few steps are left to the lanes with the longest texts.
SCORE_TOKENS = 2_000_000
RATE = 0.15
FIRST = 1e-4
CLIP = 1.0
SEED = 13
#: Numbers of the model that are averaged together, and copies that are added in one task.
BLOCK = 1 << 14
COPIES = 64
#: Different words counted in a task before they are handed on.
HELD = 400_000
#: Ranges of counts per doubling, in which the commonest words are chosen.
COUNT_RANGES = 64


# --- vocabulary ----------------------------------------------------------------------------


class Vocabulary(NamedTuple):
    words: list[bytes]  # the known words, commonest first
    counts: np.ndarray
    own: int  # the model's words are the first of them
    entry: np.ndarray  # place in the model of each own word, then of each group of other words
    entry_counts: np.ndarray  # by place
    tails: np.ndarray  # (tokens, different words) of each group
    tokens: int
    different: int

    @property
    def classes(self) -> np.ndarray:
        """The place where each class of the model begins, and the end."""
        weight = np.sqrt(self.entry_counts + 1.0)
        share = np.cumsum(weight) / weight.sum()
        n = len(share)
        cuts = np.searchsorted(share, np.arange(1, CLASSES) / CLASSES)
        return np.unique(np.concatenate([[0], np.minimum(cuts, n), [n]]))


def tail_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAILS


def vocabulary(words: list[bytes], counts: np.ndarray, tails: np.ndarray, own: int,
               tokens: int, different: int) -> Vocabulary:
    own = min(own, len(words))
    every = np.concatenate([counts[:own], tails[:, 0]])
    order = np.argsort(-every, kind="stable")
    entry = np.empty(len(order), np.int64)
    entry[order] = np.arange(len(order))
    return Vocabulary(words, counts, own, entry, every[order], tails, tokens, different)


class Codes(dict):
    """Place of a known word; -1 for any other."""

    def __missing__(self, word: bytes) -> int:
        return -1


class Encoder:
    def __init__(self, known: Vocabulary) -> None:
        self.known = known
        self.codes = Codes(zip(known.words, range(len(known.words))))
        self.groups = known.entry[known.own :]
        group = np.array([tail_of(w) for w in known.words[known.own :]], np.int64)
        # Of each known word; the last place is for those that are not.
        self.place = np.concatenate([known.entry[: known.own], self.groups[group], [0]])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Of all texts' tokens, one text behind the other: places among the known words (-1 for
        others), places in the model, the texts' lengths, and the words that are unknown."""
        split = [raw.translate(LOWER).split() for raw in texts]
        lengths = np.array([len(words) + 1 for words in split], np.int64)
        words: list[bytes] = []
        for some in split:
            words += some
            words.append(END)
        codes = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        places = self.place[codes]
        other = np.flatnonzero(codes < 0)
        unknown = [words[i] for i in other.tolist()]
        places[other] = self.groups[np.fromiter(map(tail_of, unknown), np.int64, len(unknown))]
        return codes, places, lengths, unknown


# --- the model -----------------------------------------------------------------------------


def shapes(entries: int, classes: int) -> dict[str, tuple[int, ...]]:
    return {
        "embedding": (entries, EMBEDDING), "inner": (EMBEDDING, 3 * HIDDEN),
        "state": (HIDDEN, 3 * HIDDEN), "gates": (3 * HIDDEN,),
        "class_weights": (HIDDEN, classes), "class_bias": (classes,),
        "word_weights": (entries, HIDDEN), "word_bias": (entries,),
    }


class Model:
    """The parameters as views of one array of numbers, and the classes' limits."""

    def __init__(self, numbers: np.ndarray, limits: np.ndarray) -> None:
        self.numbers, self.limits = numbers, limits
        self.parts: dict[str, np.ndarray] = {}
        at = 0
        for name, shape in shapes(int(limits[-1]), len(limits) - 1).items():
            size = int(np.prod(shape))
            self.parts[name] = numbers[at : at + size].reshape(shape)
            at += size
        # Small integers: sorting by them takes one pass.
        self.class_of = np.repeat(np.arange(len(limits) - 1, dtype=np.int16), np.diff(limits))


def untrained(known: Vocabulary) -> Model:
    """A model that gives each entry its frequency, whatever went before."""
    limits = known.classes
    sizes = [int(np.prod(s)) for s in shapes(int(limits[-1]), len(limits) - 1).values()]
    model = Model(np.zeros(sum(sizes), np.float32), limits)
    draw = np.random.default_rng(SEED)
    for name, scale in (("embedding", 0.1), ("inner", EMBEDDING**-0.5), ("state", HIDDEN**-0.5)):
        part = model.parts[name]
        part[:] = draw.normal(0, scale, part.shape)
    counts = known.entry_counts + 1.0
    model.parts["class_bias"][:] = np.log(np.add.reduceat(counts, limits[:-1]))
    model.parts["word_bias"][:] = np.log(counts)
    return model


def unroll(model: Model, inputs: np.ndarray, keep: np.ndarray, state: np.ndarray,
           way_back: bool = False):
    """States after each of the (step, lane) ``inputs``; ``keep`` is 0 where a document begins.

    With ``way_back`` also what each step reads (state, embedding and a one), gates, candidates
    and what the state adds to them, else none; these are kept lane by lane, (step, number,
    lane), so that the parts of a step lie together.
    """
    parts = model.parts
    steps, lanes = inputs.shape
    kind = model.numbers.dtype
    read_by = np.vstack([parts["state"], parts["inner"], parts["gates"]]).T
    # The logistic function is a hyperbolic tangent of half its argument.
    to_gates = read_by[: 2 * HIDDEN] * kind.type(0.5)
    to_candidate = np.ascontiguousarray(read_by[2 * HIDDEN :, HIDDEN:])
    turn = np.ascontiguousarray(read_by[2 * HIDDEN :, :HIDDEN])
    states = np.empty((steps, HIDDEN, lanes), kind)
    begins = (keep == 0).any(axis=1).tolist()
    kept = steps if way_back else 1
    stored = tuple(np.empty((kept, size, lanes), kind)
                   for size in (HIDDEN + EMBEDDING + 1, 2 * HIDDEN, HIDDEN, HIDDEN))
    stored[0][:, -1] = 1
    given = np.empty((HIDDEN, lanes), kind)
    state = np.ascontiguousarray(state.T)
    for t in range(steps):
        x, g, inner, n = (part[t if way_back else 0] for part in stored)
        h = x[:HIDDEN]
        if begins[t]:
            np.multiply(state, keep[t], out=h)
        else:
            h[:] = state
        x[HIDDEN:-1] = parts["embedding"][inputs[t]].T
        np.matmul(to_gates, x, out=g)
        np.tanh(g, out=g)
        g += 1
        g *= 0.5
        np.matmul(turn, h, out=inner)
        np.matmul(to_candidate, x[HIDDEN:], out=given)
        np.multiply(g[HIDDEN:], inner, out=n)
        n += given
        np.tanh(n, out=n)
        state = states[t]
        np.subtract(h, n, out=state)
        state *= g[:HIDDEN]
        state += n
    return np.ascontiguousarray(states.transpose(0, 2, 1)), stored if way_back else ()


def _softmax(
    states: np.ndarray, weights: np.ndarray, bias: np.ndarray, reach: float, target: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log of each target's probability, exponentials of the logits, their sums).

    ``reach`` is above all logits, as states lie between -1 and 1; where a row is so far below
    that its sum vanishes, its own maximum is taken.
    """
    logits = states @ weights
    logits += bias - logits.dtype.type(reach)
    rows = np.arange(len(target))
    chosen = logits[rows, target]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    far = np.flatnonzero(total < 1e-20)
    if len(far):
        again = states[far] @ weights + bias
        again -= again.max(axis=1, keepdims=True)
        chosen[far] = again[np.arange(len(far)), target[far]]
        logits[far] = np.exp(again)
        total[far] = logits[far].sum(axis=1)
    return chosen - np.log(total), logits, total


def _reach(model: Model) -> tuple[float, np.ndarray]:
    """What no logit exceeds: of the classes, and of the words of each class."""
    parts = model.parts
    classes = np.abs(parts["class_weights"]).sum(axis=0) + parts["class_bias"]
    words = np.abs(parts["word_weights"]).sum(axis=1) + parts["word_bias"]
    return float(classes.max()), np.maximum.reduceat(words, model.limits[:-1])


def by_class(
    model: Model, target: np.ndarray
) -> tuple[np.ndarray, list[tuple[int, int, int, slice]]]:
    """The targets' order by class, and (class, begin, end) of each that occurs, but for those of
    one word, and where it lies in that order."""
    group = model.class_of[target]
    order = np.argsort(group, kind="stable")
    group = group[order]
    begins = np.flatnonzero(np.diff(group, prepend=-1))
    found = []
    for i, j in zip(begins.tolist(), [*begins[1:].tolist(), len(order)]):
        c = int(group[i])
        low, high = int(model.limits[c]), int(model.limits[c + 1])
        if high - low > 1:
            found.append((c, low, high, slice(i, j)))
    return order, found


def log_probabilities(model: Model, states: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural logs of the targets' probabilities after the states, one row each."""
    parts = model.parts
    top, tops = _reach(model)
    order, classes = by_class(model, target)
    states, target = states[order], target[order]
    logs = _softmax(states, parts["class_weights"], parts["class_bias"], top,
                    model.class_of[target])[0].astype(np.float64)
    for c, low, high, rows in classes:
        logs[rows] += _softmax(states[rows], parts["word_weights"][low:high].T,
                               parts["word_bias"][low:high], tops[c], target[rows] - low)[0]
    found = np.empty_like(logs)
    found[order] = logs
    return found


def gradients(model: Model, inputs: np.ndarray, keep: np.ndarray, state: np.ndarray,
              target: np.ndarray, wanted: np.ndarray):
    """(loss, slopes, last state) of a window; ``wanted`` marks the targets that count.

    Slopes of embeddings come as (rows, slopes), those of word weights and biases per class.
    """
    parts = model.parts
    steps, lanes = inputs.shape
    states, (before, gates, inner, candidates) = unroll(model, inputs, keep, state, True)
    at = np.flatnonzero(wanted.reshape(-1))
    order, by = by_class(model, target.reshape(-1)[at])
    at = at[order]
    h, aim = states.reshape(-1, HIDDEN)[at], target.reshape(-1)[at]
    scale = h.dtype.type(1 / max(1, len(at)))
    classes = model.class_of[aim]
    top, tops = _reach(model)
    logs, p, total = _softmax(h, parts["class_weights"], parts["class_bias"], top, classes)
    loss = -float(logs.sum())
    p *= (scale / total)[:, None]
    p[np.arange(len(at)), classes] -= scale
    slopes: dict[str, np.ndarray] = {"class_weights": h.T @ p, "class_bias": p.sum(axis=0)}
    back = p @ parts["class_weights"].T
    words: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    for c, low, high, rows in by:
        some = h[rows]
        weights = parts["word_weights"][low:high]
        logs, p, total = _softmax(
            some, weights.T, parts["word_bias"][low:high], tops[c], aim[rows] - low)
        loss -= float(logs.sum())
        p *= (scale / total)[:, None]
        p[np.arange(len(some)), aim[rows] - low] -= scale
        back[rows] += p @ weights
        words.append((low, high, p.T @ some, p.sum(axis=0)))
    outer = np.zeros((steps * lanes, HIDDEN), h.dtype)
    outer[at] = back
    outer = np.ascontiguousarray(outer.reshape(steps, lanes, HIDDEN).transpose(0, 2, 1))
    of_gates = np.zeros((HIDDEN + EMBEDDING + 1, 2 * HIDDEN), h.dtype)
    of_candidate = np.zeros((EMBEDDING + 1, HIDDEN), h.dtype)
    of_turn = np.zeros((HIDDEN, HIDDEN), h.dtype)
    read = np.empty((steps, lanes, EMBEDDING), h.dtype)
    row = np.empty((3 * HIDDEN, lanes), h.dtype)
    up, reset, dn = row[:HIDDEN], row[HIDDEN : 2 * HIDDEN], row[2 * HIDDEN :]
    to_gates = np.ascontiguousarray(parts["state"][:, : 2 * HIDDEN])
    turn = np.ascontiguousarray(parts["state"][:, 2 * HIDDEN :])
    later = np.zeros((HIDDEN, lanes), h.dtype)
    begins = (keep == 0).any(axis=1).tolist()
    # Step by step, as a step's numbers fit a core's own cache.
    for t in range(steps - 1, -1, -1):
        x, z, r, n = before[t], gates[t, :HIDDEN], gates[t, HIDDEN:], candidates[t]
        dh = outer[t]
        dh += later
        rest = 1 - z
        np.multiply(n, n, out=dn)
        np.subtract(1, dn, out=dn)
        dn *= rest
        dn *= dh
        np.subtract(x[:HIDDEN], n, out=up)
        up *= z
        up *= rest
        up *= dh
        np.subtract(1, r, out=reset)
        reset *= r
        reset *= inner[t]
        reset *= dn
        turned = dn * r
        later = to_gates @ row[: 2 * HIDDEN]
        later += turn @ turned
        dh *= z
        later += dh
        if begins[t]:
            later *= keep[t]
        of_gates += x @ row[: 2 * HIDDEN].T
        of_candidate += x[HIDDEN:] @ dn.T
        of_turn += x[:HIDDEN] @ turned.T
        np.matmul(row.T, parts["inner"].T, out=read[t])
    slopes["state"] = np.hstack([of_gates[:HIDDEN], of_turn])
    slopes["inner"] = np.hstack([of_gates[HIDDEN:-1], of_candidate[:-1]])
    slopes["gates"] = np.hstack([of_gates[-1], of_candidate[-1]])
    flat = inputs.reshape(-1)
    order = np.argsort(flat.astype(np.uint16), kind="stable")
    begins = np.flatnonzero(np.diff(flat[order], prepend=-1))
    embedded = (np.add.reduceat(read.reshape(-1, EMBEDDING)[order], begins), flat[order][begins])
    return loss, (slopes, embedded, words), states[-1]


class Trainer:
    """Stochastic gradients with per-parameter rates.

    ``seen`` are the sums of squared slopes so far, by which steps become smaller.
    """

    def __init__(self, model: Model, seen: Model) -> None:
        self.model, self.seen = model, seen

    def _step(self, name: str, slope: np.ndarray, where=slice(None)) -> None:
        part, seen = self.model.parts[name], self.seen.parts[name]
        total = seen[where] + slope * slope
        seen[where] = total
        part[where] -= RATE * slope / np.sqrt(total)

    def step(self, slopes, share: float) -> None:
        dense, (embedded, rows), words = slopes
        norm = np.sqrt(sum(float((g * g).sum()) for g in dense.values()))
        size = np.float32(min(1.0, CLIP / (norm + 1e-9)) * share)
        for name, slope in dense.items():
            self._step(name, slope * size)
        self._step("embedding", embedded * size, rows)
        for low, high, weights, bias in words:
            self._step("word_weights", weights * size, slice(low, high))
            self._step("word_bias", bias * size, slice(low, high))


class Lanes:
    """Texts that run through lanes, one behind the other, each to the emptiest lane."""

    def __init__(self, texts: list[np.ndarray], lanes: int) -> None:
        own: list[list[int]] = [[] for _ in range(min(lanes, len(texts)))]
        load = [(0, lane) for lane in range(len(own))]
        for i, text in enumerate(texts):
            size, lane = load[0]
            own[lane].append(i)
            heapq.heapreplace(load, (size + len(text), lane))
        sizes = [sum(len(texts[i]) for i in some) for some in own]
        self.order = [i for _, some in sorted(zip(sizes, own), key=lambda x: -x[0]) for i in some]
        # All lanes one behind the other; lane by lane its begin and size, the largest first.
        self.sizes = np.array(sorted(sizes, reverse=True), np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.lengths = np.array([len(texts[i]) for i in self.order], np.int64)
        self.places = np.concatenate([np.empty(0, np.int64), *(texts[i] for i in self.order)])
        self.first = np.zeros(len(self.places) + 1, bool)
        self.first[np.cumsum(self.lengths) - self.lengths] = True

    def windows(self, steps: int, longest: int, end: int):
        """(index, target, first, wanted) of the lanes that are left, which come first.

        ``first`` marks the words a text begins with, ``wanted`` all but the filling behind a
        lane's last.  Windows grow up to ``longest`` steps as lanes become fewer, so that each has
        as many words.
        """
        words, at = steps * len(self.sizes), 0
        while (n := int((self.sizes > at).sum())):
            steps = min(longest, max(steps, words // n))
            step = at + np.arange(steps)[:, None]
            wanted = step < self.sizes[:n]
            index = np.where(wanted, self.begins[:n] + step, 0)
            yield index, np.where(wanted, self.places[index], end), self.first[index] & wanted, wanted
            at += steps


def train_on(
    model: Model, seen: Model, texts: list[np.ndarray], end: int
) -> tuple[int, float]:
    """Train on texts of model places that end in ``end``; gives tokens and the mean loss.

    A text's words follow the end token, which is the last to be predicted; its state starts anew.
    """
    trainer = Trainer(model, seen)
    lanes = Lanes(texts, LANES)
    state = np.zeros((len(lanes.sizes), HIDDEN), np.float32)
    last = np.full(len(lanes.sizes), end, np.int64)
    tokens, total = 0, 0.0
    for _, target, first, wanted in lanes.windows(STEPS, LONGEST, end):
        left = target.shape[1]
        inputs = np.vstack([last[None, :left], target[:-1]])
        inputs[first] = end
        n = int(wanted.sum())
        loss, slopes, state = gradients(
            model, inputs, (~first).astype(np.float32), state[:left], target, wanted)
        # Few texts say little of the others, however long they are.
        trainer.step(slopes, left / LANES * n / wanted.size)
        last = target[-1]
        tokens, total = tokens + n, total + loss
    return tokens, total / max(1, tokens)


def score_texts(model: Model, texts: list[np.ndarray], end: int) -> np.ndarray:
    """Sums of the natural logs of the probabilities of each text's tokens, all in one pass."""
    scores = np.zeros(len(texts), np.float64)
    by_length = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lanes = Lanes([texts[i] for i in by_length], SCORE_LANES)
    who = np.repeat(np.array(by_length, np.int64)[lanes.order], lanes.lengths)
    state = np.zeros((len(lanes.sizes), HIDDEN), np.float32)
    last = np.full(len(lanes.sizes), end, np.int64)
    for index, target, first, wanted in lanes.windows(SCORE_STEPS, LONGEST, end):
        left = target.shape[1]
        inputs = np.vstack([last[None, :left], target[:-1]])
        inputs[first] = end
        states, _ = unroll(model, inputs, (~first).astype(np.float32), state[:left])
        chosen = np.flatnonzero(wanted.reshape(-1))
        logs = log_probabilities(
            model, states.reshape(-1, HIDDEN)[chosen], target.reshape(-1)[chosen])
        scores += np.bincount(who[index.reshape(-1)[chosen]], logs, len(texts))
        state, last = states[-1], target[-1]
    return scores


# --- jobs ----------------------------------------------------------------------------------


def held_out(name: str = "doc_id"):
    key = F.col(name).cast("string").cast("binary")
    return F.coalesce(F.crc32(key) % FOLDS == HELD_FOLD, F.lit(False))


def _raw(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
        F.coalesce("text", F.lit("")).cast("binary").alias("raw"))


def token_counts(raw: DataFrame) -> DataFrame:
    """(word, n) of all tokens; the end token is the empty word."""

    def flushed(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(total.keys()), pa.binary()), pa.array(list(total.values()), pa.int64())],
            ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in common.texts(batch, "raw"):
                total.update(text.translate(LOWER).split())
                total[END] += 1
                if len(total) > HELD:
                    yield flushed(total)
                    total = Counter()
        yield flushed(total)

    return raw.select("raw").mapInArrow(run, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n"))


def learn_vocabulary(counts: DataFrame, known: int = KNOWN, own: int = WORDS) -> Vocabulary:
    """Of (word, n) counts, a written table; what reaches the driver has a fixed size.

    The known words are those of the largest counts, as many ranges of counts as hold no more
    than ``known`` words; so no task ranks them all.
    """
    size = F.floor(F.log2("n") * COUNT_RANGES).cast("int")
    ranges = counts.groupBy(size.alias("size")).agg(
        F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    total = sum(r.n for r in ranges), sum(r.words for r in ranges)
    least, room = 1 << 30, known
    for r in sorted(ranges, key=lambda r: -r["size"]):
        room -= r.words
        if room < 0:
            break
        least = r["size"]
    top = sorted(counts.where(size >= least).collect(), key=lambda r: (-r.n, bytes(r.word)))
    # The end token is always the model's own.
    rows = [(bytes(r.word), r.n) for r in top]
    own = min(own, max(1, len(rows)))
    if END not in [w for w, _ in rows[:own]]:
        ends = counts.where(F.length("word") == 0).first()
        rows = [(w, n) for w, n in rows if w != END]
        rows.insert(own - 1, (END, ends.n if ends else 0))
        rows = rows[: max(1, known)]
    mine = [w for w, _ in rows[:own]]
    spark = counts.sparkSession
    taken = F.broadcast(spark.createDataFrame([(w,) for w in mine], "word binary"))
    group = F.pmod(F.crc32(F.expr("substring(word, -2)")), F.lit(TAILS)).cast("int")
    tails = np.zeros((TAILS, 2), np.int64)
    for r in counts.join(taken, "word", "left_anti").groupBy(group.alias("g")).agg(
            F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        tails[r.g] = r.n, r.v
    return vocabulary([w for w, _ in rows], np.array([n for _, n in rows], np.int64), tails, own,
                      total[0], total[1])


def _averaged(copies: DataFrame) -> np.ndarray:
    """The mean of (task, block, tokens, numbers) copies of a model, weighted by their tokens.

    Copies are added ``COPIES`` at a time, until one is left per block.
    """
    def add(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("task")  # sums do not depend on the order of arrival
        sums = [np.frombuffer(x, np.float32) for x in rows["numbers"].to_pylist()]
        return pa.table({
            "task": pa.array([key[1].as_py()], pa.int64()),
            "block": pa.array([key[0].as_py()], pa.int64()),
            "tokens": pa.array([sum(rows["tokens"].to_pylist())], pa.int64()),
            "numbers": pa.array([np.add.reduce(sums).tobytes()], pa.binary())})

    schema = "task long, block long, tokens long, numbers binary"
    copies = common.materialize(copies, "copies")
    most = copies.agg(F.max("task")).first()[0]
    while most:
        copies = copies.groupBy("block", F.expr(f"task div {COPIES}")).applyInArrow(add, schema)
        copies = common.materialize(copies, "copies")
        most //= COPIES
    blocks = sorted(copies.collect(), key=lambda r: r.block)  # one model
    if not blocks or not blocks[0].tokens:
        return np.empty(0, np.float32)
    whole = np.concatenate([np.frombuffer(r.numbers, np.float32) for r in blocks])
    return whole / np.float32(blocks[0].tokens)


CODED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, known_base double, "
    "rest double, places binary, tail_words array<binary>, tail_n array<int>"
)


def coded_documents(raw: DataFrame, known: Vocabulary) -> DataFrame:
    """Documents as places in the model, the sums of what the tasks know, and words they do not.

    ``known_base`` sums the logs of the known words' counts, ``rest`` what the words that are not
    the model's own have within their groups, but for the words the tasks do not know.
    """
    shared = raw.sparkSession.sparkContext.broadcast(known)  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        encoder = Encoder(known)
        # By code; the last is that of unknown words, which the tasks know nothing of.
        logs = np.append(np.log10(known.counts + 1.0), 0.0)
        seen = np.append(known.counts > 0, False)
        inner = np.concatenate([np.zeros(known.own), logs[known.own :]])
        sizes = np.zeros(len(known.entry))
        sizes[encoder.groups] = np.log10(known.tails.sum(axis=1) + 1.0)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, places, lengths, unknown = encoder.encode(common.texts(batch, "raw"))
            stop = np.cumsum(lengths)
            begin = stop - lengths
            total = lambda x: np.add.reduceat(x, begin)
            missing = total((codes < 0).astype(np.int64))
            raw_places = places.astype("<u2").tobytes()
            tails = [Counter(unknown[j - n : j]) for n, j in zip(missing.tolist(), np.cumsum(missing).tolist())]
            out = [
                np.arange(row, row + len(lengths)), lengths, total(seen[codes].astype(np.int64)),
                total(logs[codes]), total(inner[codes] - sizes[places]),
                [raw_places[2 * i : 2 * j] for i, j in zip(begin.tolist(), stop.tolist())],
                [list(tail.keys()) for tail in tails], [list(tail.values()) for tail in tails]]
            row += len(lengths)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(),
                     pa.list_(pa.binary()), pa.list_(pa.int32())]
            first, *rest = (pa.array(column, kind) for column, kind in zip(out, types))
            yield pa.RecordBatch.from_arrays(
                [first, common.column(batch, "doc_id"), common.column(batch, "held_out"), *rest],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "known_base", "rest", "places",
                 "tail_words", "tail_n"])

    return raw.mapInArrow(run, CODED)


def train(coded: DataFrame, known: Vocabulary, rounds: int = ROUNDS,
          task_tokens: int = TASK_TOKENS) -> Model:
    """A model fitted to all coded documents that are not held out, each used in one round."""
    spark = coded.sparkSession
    end = int(known.entry[known.words.index(END)])
    # Documents of equal keys are equal, so their order makes no difference.
    key = F.xxhash64("doc_id", "places")
    training = coded.where(~F.col("held_out")).select(
        key.alias("key"), "n_tokens", "places", F.pmod(key, F.lit(rounds)).cast("int").alias("round"))
    sizes = {r.round: r.n for r in training.groupBy("round").agg(F.sum("n_tokens").alias("n")).collect()}
    model = untrained(known)
    seen = Model(np.full(len(model.numbers), FIRST, np.float32), model.limits)
    for number in sorted(sizes):
        now = spark.sparkContext.broadcast((model.numbers, seen.numbers, model.limits))

        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            *both, limits = now.value
            copy, own = (Model(x.copy(), limits) for x in both)
            texts = [np.frombuffer(x, "<u2").astype(np.int64)
                     for batch in batches for x in batch.column(0).to_pylist()]
            tokens, _ = train_on(copy, own, texts, end)
            whole = np.concatenate([copy.numbers, own.numbers]) * np.float32(tokens)
            blocks = [whole[i : i + BLOCK].tobytes() for i in range(0, len(whole), BLOCK)]
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([task] * len(blocks), pa.int64()), pa.array(range(len(blocks)), pa.int64()),
                 pa.array([tokens] * len(blocks), pa.int64()), pa.array(blocks, pa.binary())],
                ["task", "block", "tokens", "numbers"])

        tasks = -(-sizes[number] // task_tokens)
        dealt = training.where(F.col("round") == number).repartition(tasks, "key")
        copies = dealt.sortWithinPartitions("key").select("places").mapInArrow(
            fit, "task long, block long, tokens long, numbers binary")
        numbers = _averaged(copies)
        if len(numbers):
            half = len(numbers) // 2
            model, seen = (Model(x, model.limits) for x in (numbers[:half], numbers[half:]))
    return model


def grouped(
    batches: Iterator[pa.RecordBatch], tokens: int
) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """(row, places) of batches put together until they have ``tokens`` tokens, and of what is left."""
    rows: list[pa.Array] = []
    texts: list[np.ndarray] = []
    size = 0
    for batch in batches:
        rows.append(common.column(batch, "row"))
        texts += [np.frombuffer(x, "<u2").astype(np.int64) for x in common.texts(batch, "places")]
        size += sum(map(len, texts[len(texts) - batch.num_rows :]))
        if size >= tokens:
            yield pa.concat_arrays(rows), texts
            rows, texts, size = [], [], 0
    if texts:
        yield pa.concat_arrays(rows), texts


def _scored(coded: DataFrame, known: Vocabulary, model: Model) -> DataFrame:
    """(row, model_score): log10 probabilities of the documents' places."""
    shared = coded.sparkSession.sparkContext.broadcast((model.numbers, model.limits))
    end = int(known.entry[known.words.index(END)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for rows, texts in grouped(batches, SCORE_TOKENS):
            scores = score_texts(model, texts, end) / np.log(10)
            yield pa.RecordBatch.from_arrays([rows, pa.array(scores)], ["row", "model_score"])

    return coded.select("row", "places").mapInArrow(run, "row long, model_score double")


def log_likelihoods(docs: DataFrame, known: int = KNOWN, own: int = WORDS, rounds: int = ROUNDS,
                    task_tokens: int = TASK_TOKENS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    ``base_score`` is the log10 probability by the words' frequencies, ``score`` by the model.
    """
    common.python_batches(docs.sparkSession)
    raw = _raw(docs)
    counts = common.materialize(token_counts(raw.where(~F.col("held_out"))), "token-counts")
    words = learn_vocabulary(counts, known, own)
    coded = common.materialize(coded_documents(raw, words), "coded")
    model = train(coded, words, rounds, task_tokens)
    # Unknown words are rarer than all known ones, so no word is common but one unseen in training.
    tail = coded.select("row", F.inline(F.arrays_zip("tail_words", "tail_n"))).select(
        "row", F.col("tail_words").alias("word"), F.col("tail_n").alias("times"))
    joined = tail.join(counts, "word", "left")
    sums = joined.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("more"))
    whole = coded.drop("places", "tail_words", "tail_n").join(_scored(coded, words, model), "row").join(
        sums, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    size = float(np.log10(words.tokens + words.different + 1.0))
    return whole.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("known_base") + more - F.col("n_tokens") * size).alias("base_score"),
        (F.col("model_score") + F.col("rest") + more).alias("score"))
