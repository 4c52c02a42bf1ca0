"""Quality scores by a factorisation machine.

Features are hashed words, statistics of the text's structure and its length, all from the
text.  The score is the logistic of w0 + <w, x> + 1/2 sum_f ((sum_i v_if x_i)^2 -
sum_i v_if^2 x_i^2): all pairwise interactions of low rank in time linear in the features.

The model is fitted on the driver on at most ``SAMPLE`` labelled rows, those with the smallest
hash of their id; scoring runs over all rows in the tasks.  Rows whose crc32(id as text) mod 4
is 2 are held out.  A label that is null or belongs to no document is ignored; if an id has
several, the smallest counts.  Without any label every score is 0.5, with labels of one kind
only it is that kind's share.  A null text is an empty one and is scored too.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SAMPLE = 6000
WORD_BITS = 15
RANK = 6
EPOCHS = 8
RATE = 0.1
PENALTY = 2e-5
BATCH = 128
SEED = 11
THRESHOLD = 0.7

BINS = 12
#: Shares of bytes: lower case, upper case, digits, spaces, line ends, common marks, other
#: ASCII marks, bytes of other characters; then shares of different words, of the commonest
#: word, of words without a letter or digit in ASCII, of different lines; mean lengths of words
#: and lines, and the length of the text.
STATISTICS = 15
FEATURES = (1 << WORD_BITS) + STATISTICS * BINS

_KINDS = np.full(256, 6, np.uint8)
_KINDS[ord("a") : ord("z") + 1] = 0
_KINDS[ord("A") : ord("Z") + 1] = 1
_KINDS[ord("0") : ord("9") + 1] = 2
_KINDS[[32, 9]] = 3
_KINDS[[10, 13]] = 4
_KINDS[[ord(c) for c in ".,;:'\"-"]] = 5
_KINDS[128:] = 7

_WORDS: dict[str, int] = {}
_CACHE = 100_000


class Model(NamedTuple):
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def statistics(text: str, words: Counter, total: int) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    shares = np.bincount(_KINDS[raw], minlength=8) / max(1, len(raw))
    lines = text.split("\n")
    marks = sum(n for w, n in words.items() if not any(c.isalnum() for c in w))
    n = max(1, total)
    return np.concatenate([
        np.sqrt(shares),
        [
            len(words) / n,
            max(words.values(), default=0) / n,
            marks / n,
            len(set(lines)) / len(lines),
            min(1.0, len(raw) / n / 16),
            min(1.0, np.log1p(len(raw) / len(lines)) / 10),
            min(1.0, np.log1p(len(raw)) / 14),
        ],
    ])


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(index, value) of the features of a text that are not zero."""
    split = text.split()
    words = Counter(split)
    if len(_WORDS) > _CACHE:
        _WORDS.clear()
    at = np.empty(len(words), np.int64)
    for i, word in enumerate(words):
        place = _WORDS.get(word)
        if place is None:
            place = zlib.crc32(word.encode()) & ((1 << WORD_BITS) - 1)
            if len(word) < 40:
                _WORDS[word] = place
        at[i] = place
    value = np.log1p(np.fromiter(words.values(), np.float64, len(words)))
    norm = np.sqrt((value**2).sum()) or 1.0
    place = np.minimum(BINS - 1, (statistics(text, words, len(split)) * BINS).astype(np.int64))
    bins = (1 << WORD_BITS) + np.arange(STATISTICS) * BINS + place
    # Words that share an index are summed by the scores' sums themselves.
    return (np.concatenate([at, bins]),
            np.concatenate([value / norm, np.full(STATISTICS, STATISTICS**-0.5)]))


def margins(model: Model, index: np.ndarray, value: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Scores before the logistic of rows whose features start at ``begin``."""
    linear = np.add.reduceat(model.weights[index] * value, begin)
    vx = model.factors[index] * value[:, None]
    sums = np.add.reduceat(vx, begin, axis=0)
    squares = np.add.reduceat(vx**2, begin, axis=0)
    return model.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """Logistic loss by stochastic gradients with per-parameter rates."""
    draw = np.random.default_rng(SEED)
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        bias = {0.0: -30.0, 1.0: 30.0}.get(share, 0.0)
        return Model(bias, np.zeros(FEATURES), np.zeros((FEATURES, RANK)))
    weights, factors = np.zeros(FEATURES), draw.normal(0, 0.05, (FEATURES, RANK))
    bias = float(np.log(share / (1 - share)))
    seen_w, seen_v, seen_b = np.full(FEATURES, 1e-6), np.full((FEATURES, RANK), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = draw.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            sizes = np.array([len(rows[i][0]) for i in chosen])
            begin = np.cumsum(sizes) - sizes
            index = np.concatenate([rows[i][0] for i in chosen])
            value = np.concatenate([rows[i][1] for i in chosen])
            model = Model(bias, weights, factors)
            error = (sigmoid(margins(model, index, value, begin)) - labels[chosen]) / len(chosen)
            each = np.repeat(error, sizes) * value
            vx = factors[index] * value[:, None]
            sums = np.repeat(np.add.reduceat(vx, begin, axis=0), sizes, axis=0)
            slope = each[:, None] * (sums - vx)
            used, to = np.unique(index, return_inverse=True)
            g_w = np.bincount(to, each, len(used)) + PENALTY * weights[used]
            g_v = np.stack([np.bincount(to, slope[:, f], len(used)) for f in range(RANK)], 1)
            g_v += PENALTY * factors[used]
            seen_w[used] += g_w**2
            seen_v[used] += g_v**2
            seen_b += error.sum() ** 2
            weights[used] -= RATE * g_w / np.sqrt(seen_w[used])
            factors[used] -= RATE * 0.5 * g_v / np.sqrt(seen_v[used])
            bias -= RATE * error.sum() / np.sqrt(seen_b)
    return Model(bias, weights, factors)


def held_out(id_col: str | Column) -> Column:
    key = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE
) -> Model:
    """Fit on labelled rows that are not held out."""
    common.python_batches(docs.sparkSession, common.SMALL_BATCH_BYTES)
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out("doc_id"))
        .groupBy(F.col("doc_id").alias("of_doc"))
        .agg(F.min(label_col).alias("label"))
        .orderBy(F.xxhash64("of_doc"), "of_doc")
        .limit(sample)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text) for text in common.texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [common.column(batch, "doc_id"), common.column(batch, "label"),
                 pa.array([x[0].astype("<i4").tobytes() for x in found], pa.binary()),
                 pa.array([x[1].astype("<f4").tobytes() for x in found], pa.binary())],
                ["doc_id", "label", "at", "value"])

    # The sample has a bounded number of rows, so it may be broadcast.
    rows = (
        common.documents(docs)
        .join(F.broadcast(known), F.col("doc_id") == F.col("of_doc"))
        .select(F.col("doc_id").cast("long"), "text", F.col("label").cast("int").alias("label"))
        .mapInArrow(run, "doc_id long, label int, at binary, value binary")
        .collect()
    )
    rows.sort(key=lambda r: (r.doc_id, r.at))
    pairs = [(np.frombuffer(r.at, "<i4").astype(np.int64),
              np.frombuffer(r.value, "<f4").astype(np.float64)) for r in rows]
    return fit(pairs, np.array([r.label for r in rows], np.float64))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    spark = docs.sparkSession
    common.python_batches(spark, common.SMALL_BATCH_BYTES)
    shared = spark.sparkContext.broadcast(model)  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for text in common.texts(batch):
                index, value = features(text)
                scores.append(margins(shared.value, index, value, np.array([0]))[0])
            yield pa.RecordBatch.from_arrays(
                [common.column(batch, "doc_id").cast(pa.int64()),
                 pa.array(sigmoid(np.array(scores, np.float64)))], ["doc_id", "score"])

    scored = common.documents(docs, id_col).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all their columns, that score at least ``THRESHOLD``."""
    spark = docs.sparkSession
    common.python_batches(spark, common.SMALL_BATCH_BYTES)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in batches:
            found = (features(text) for text in part.to_pylist())
            yield pa.array([margins(shared.value, i, v, np.array([0]))[0] for i, v in found],
                           pa.float64())

    limit = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    return docs.where(judged(F.coalesce(F.col("text"), F.lit(""))) >= limit)
