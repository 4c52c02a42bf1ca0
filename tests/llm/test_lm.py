"""The recurrent language model against slow versions, its slopes against differences."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from folioforge.llm import common, lm, queries
from odd import SMALL, no_documents, odd_documents, odd_rows


def tokens_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), ""]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def slow_base(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) of (doc_id, text) rows."""
    counts = Counter(t for i, text in rows if not held(i) for t in tokens_of(text))
    size = sum(counts.values()) + len(counts) + 1
    return [
        (i, held(i), len(words), sum(counts[t] > 0 for t in words), sum(counts.values()),
         sum(math.log10((counts[t] + 1) / size) for t in words))
        for i, text in rows for words in [tokens_of(text)]]


def check_base(found, rows):
    key = lambda r: (str(r[0]), r[2], r[3], r[5])
    wanted = sorted(slow_base(rows), key=key)
    got = sorted((tuple(r)[:6] for r in found), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in wanted]
    assert np.allclose([r[5] for r in got], [r[5] for r in wanted], rtol=1e-9)


def small_vocabulary(texts, known=60, own=25):
    counts = Counter(t.encode() for text in texts for t in tokens_of(text))
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:known]
    if b"" not in dict(top[:own]):
        top = [*top[: own - 1], (b"", counts[b""]), *[x for x in top[own - 1 :] if x[0]]][:known]
    mine = {w for w, _ in top[:own]}
    tails = np.zeros((lm.TAILS, 2), np.int64)
    for w, n in counts.items():
        if w not in mine:
            tails[lm.tail_of(w)] += (n, 1)
    found = lm.vocabulary([w for w, _ in top], np.array([n for _, n in top], np.int64), tails, own,
                          sum(counts.values()), len(counts))
    return found, counts


@pytest.fixture(scope="module")
def trained():
    draw = np.random.default_rng(1)
    texts = [" ".join(f"w{int(x)}" for x in draw.zipf(1.4, n) if x < 500) for n in draw.integers(0, 90, 60)]
    texts += ["x y z " * 40] * 5
    known, counts = small_vocabulary(texts)
    model = lm.untrained(known)
    seen = lm.Model(np.full(len(model.numbers), lm.FIRST, np.float32), model.limits)
    encoder = lm.Encoder(known)
    end = int(known.entry[known.words.index(b"")])
    coded = [encoder.encode([t.encode()])[1] for t in texts]
    losses = [lm.train_on(model, seen, coded, end)[1] for _ in range(8)]
    return texts, known, counts, model, encoder, end, coded, losses


def slow_state(parts, place, h):
    a, b = parts["embedding"][place] @ parts["inner"] + parts["gates"], h @ parts["state"]
    k = lm.HIDDEN
    gate = lambda x: 1 / (1 + np.exp(-x))
    z, r = gate(a[:k] + b[:k]), gate(a[k : 2 * k] + b[k : 2 * k])
    return (1 - z) * np.tanh(a[2 * k :] + r * b[2 * k :]) + z * h


def slow_entries(model, h):
    """Probabilities of all entries after state ``h``."""
    parts = {k: v.astype(np.float64) for k, v in model.parts.items()}
    softmax = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    classes = softmax(h @ parts["class_weights"] + parts["class_bias"])
    words = parts["word_weights"] @ h + parts["word_bias"]
    return np.concatenate([p * softmax(words[i:j]) for p, i, j in zip(
        classes, model.limits[:-1], model.limits[1:])])


def test_training_lowers_the_loss_and_probabilities_sum_to_one(trained):
    texts, known, counts, model, encoder, end, coded, losses = trained
    assert losses[-1] < losses[0] - 0.05
    entries = slow_entries(model, np.full(lm.HIDDEN, 0.3))
    assert np.isclose(entries.sum(), 1)
    # Every entry is an own word or a group, and a group's words with one never seen sum to one.
    assert sorted(known.entry.tolist()) == list(range(len(entries)))
    for g in range(lm.TAILS):
        inside = [n for w, n in counts.items()
                  if w not in known.words[: known.own] and lm.tail_of(w) == g]
        assert np.isclose(sum(n + 1 for n in inside) + 1, known.tails[g].sum() + 1)


def test_whole_texts_score_as_word_by_word(trained, monkeypatch):
    texts, known, counts, model, encoder, end, coded, _ = trained
    parts = {k: v.astype(np.float64) for k, v in model.parts.items()}
    wanted = []
    for places in coded:
        h, last, total = np.zeros(lm.HIDDEN), end, 0.0
        for place in places:
            h = slow_state(parts, last, h)
            total += math.log(slow_entries(model, h)[place])
            last = place
        wanted.append(total)
    for lanes, steps in ((256, 32), (3, 5), (1, 7)):
        monkeypatch.setattr(lm, "SCORE_LANES", lanes)
        monkeypatch.setattr(lm, "SCORE_STEPS", steps)
        assert np.allclose(lm.score_texts(model, coded, end), wanted, rtol=1e-4)
    assert len(lm.score_texts(model, [], end)) == 0


def test_batches_are_scored_together_in_long_windows(trained, monkeypatch):
    _, _, _, model, _, end, coded, _ = trained
    batches = [pa.RecordBatch.from_pydict({
        "row": pa.array(range(i, min(i + 7, len(coded))), pa.int64()),
        "places": pa.array([x.astype("<u2").tobytes() for x in coded[i : i + 7]], pa.binary())})
        for i in range(0, len(coded), 7)]
    batches.insert(2, batches[0].slice(0, 0))
    for tokens in (1, 500, 10**9):
        groups = list(lm.grouped(iter(batches), tokens))
        assert [r for rows, _ in groups for r in rows.to_pylist()] == list(range(len(coded)))
        assert all(sum(map(len, texts)) >= tokens for _, texts in groups[:-1])
        scores = np.concatenate([lm.score_texts(model, texts, end) for _, texts in groups])
        assert np.allclose(scores, lm.score_texts(model, coded, end), rtol=1e-4)
    assert len(groups) == 1 and not list(lm.grouped(iter([]), 5))
    # A long text beside short ones: as many words in its windows as in those before.
    calls = []
    unroll = lm.unroll
    monkeypatch.setattr(lm, "unroll", lambda model, inputs, *rest: calls.append(inputs.shape) or unroll(
        model, inputs, *rest))
    lm.score_texts(model, [np.full(2000, end), *[np.full(30, end)] * 9], end)
    assert len(calls) < 12


def test_slopes_are_those_of_the_loss(trained):
    _, known, _, model, _, end, _, _ = trained
    draw = np.random.default_rng(2)
    big = lm.Model(model.numbers.astype(np.float64), model.limits)
    big.numbers += draw.normal(0, 0.1, len(big.numbers))
    entries = int(model.limits[-1])
    inputs, target = draw.integers(0, entries, (2, 5, 4))
    keep, wanted = np.ones((5, 4)), np.ones((5, 4), bool)
    keep[2, 1] = keep[0, 3] = 0
    wanted[4, 2] = wanted[3, 2] = False
    state = draw.normal(0, 0.5, (4, lm.HIDDEN))
    loss = lambda: lm.gradients(big, inputs, keep, state, target, wanted)[0] / wanted.sum()
    _, (dense, (embedded, rows), words), _ = lm.gradients(big, inputs, keep, state, target, wanted)
    slopes = lm.Model(np.zeros(len(big.numbers)), model.limits)
    for name, slope in dense.items():
        slopes.parts[name][:] = slope
    slopes.parts["embedding"][rows] = embedded
    for low, high, weights, bias in words:
        slopes.parts["word_weights"][low:high] = weights
        slopes.parts["word_bias"][low:high] = bias
    for name, part in big.parts.items():
        flat, slope = part.reshape(-1), slopes.parts[name].reshape(-1)
        some = draw.choice(len(flat), min(12, len(flat)), replace=False)
        for i in [*some, int(np.abs(slope).argmax())]:
            value, change = flat[i], 1e-2
            flat[i] = value + change
            up = loss()
            flat[i] = value - change
            down = loss()
            flat[i] = value
            assert abs((up - down) / (2 * change) - slope[i]) < 2e-3 * max(0.05, abs(slope[i])), name


def test_lanes_hold_every_word_once_in_windows_of_a_size():
    draw = np.random.default_rng(4)
    texts = [draw.integers(1, 50, n) for n in (1, 40, 3, 7, 90, 2, 5)]
    lanes = lm.Lanes(texts, 4)
    rows = [[] for _ in range(4)]
    for index, target, first, wanted in lanes.windows(3, 8, 0):
        assert target.size <= 12 and (lanes.places[index][wanted] == target[wanted]).all()
        for lane in range(target.shape[1]):
            rows[lane] += [(t, f) for t, f, w in zip(target[:, lane], first[:, lane], wanted[:, lane]) if w]
    found = []
    for row in rows:
        for word, begins in row:
            if begins:
                found.append([])
            found[-1].append(int(word))
    assert sorted(found) == sorted(t.tolist() for t in texts)
    assert list(lm.Lanes([], 4).windows(3, 8, 0)) == []


def test_copies_are_averaged_by_their_tokens(spark, monkeypatch):
    monkeypatch.setattr(lm, "COPIES", 3)
    rows, total = [], np.zeros(10)
    for task in range(11):
        numbers = np.arange(10, dtype=np.float32) * (task + 1)
        total += numbers * (task + 5)
        whole = numbers * np.float32(task + 5)
        rows += [(task, b, task + 5, bytearray(whole[6 * b : 6 * b + 6].tobytes())) for b in range(2)]
    frame = spark.createDataFrame(rows, "task long, block long, tokens long, numbers binary")
    assert np.allclose(lm._averaged(frame), total / sum(t + 5 for t in range(11)))
    assert len(lm._averaged(frame.limit(0))) == 0


def test_likelihoods_of_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    found = lm.log_likelihoods(odd_documents(spark)).collect()
    check_base(found, rows)
    assert all(np.isfinite(r.score) and r.score < 0 for r in found)
    assert lm.log_likelihoods(no_documents(spark)).count() == 0


def test_without_training_documents_all_words_are_unseen(spark):
    ids = [i for i in range(100) if held(i)][:3]
    rows = [(ids[0], "a b c"), (ids[1], None), (ids[2], "a")]
    found = lm.log_likelihoods(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_base(found, rows)
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 for r in found)


def test_small_vocabularies_give_the_same_base(spark):
    """Most words' counts are joined instead of broadcast, and several tasks train."""
    docs = common.table(spark, SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = lm.log_likelihoods(docs, known=50, own=20, rounds=2, task_tokens=10_000).collect()
    check_base(found, rows)
    assert sum(r.score for r in found) > 1.02 * sum(r.base_score for r in found)


def test_likelihoods_of_whole_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op13_likelihoods(spark, folder).collect()
    check_base(found, [(r.doc_id, r.text) for r in common.table(spark, folder, "documents").collect()])
    for fold in (True, False):
        some = [r for r in found if r.held_out == fold]
        # The model gives documents it has not seen a higher probability than frequencies do.
        assert sum(r.score for r in some) > 0.98 * sum(r.base_score for r in some)
        assert sum(r.score > r.base_score for r in some) > 0.8 * len(some)


def test_logits_far_below_their_bound_keep_their_probabilities():
    draw = np.random.default_rng(6)
    states = draw.uniform(-1, 1, (9, lm.HIDDEN)).astype(np.float32)
    weights = draw.normal(0, 1, (lm.HIDDEN, 12)).astype(np.float32)
    weights[:, 5] = 40 * np.sign(draw.normal(size=lm.HIDDEN))
    bias = draw.normal(0, 3, 12).astype(np.float32)
    target = np.arange(9)
    logits = states.astype(np.float64) @ weights + bias
    wanted = logits - np.log(np.exp(logits - logits.max(axis=1, keepdims=True)).sum(axis=1))[:, None]
    wanted -= logits.max(axis=1, keepdims=True)
    reach = float((np.abs(weights).sum(axis=0) + bias).max())
    assert (logits.max(axis=1) < reach - 100).any()
    found, exps, total = lm._softmax(states, weights, bias, reach, target)
    assert np.allclose(found, wanted[np.arange(9), target], rtol=1e-4, atol=1e-3)
    assert np.allclose((exps / total[:, None]).sum(axis=1), 1, rtol=1e-5)


def test_targets_come_in_order_of_their_classes_and_steps_lane_by_lane():
    limits = np.array([0, 1, 4, 4 + 6])
    sizes = [int(np.prod(s)) for s in lm.shapes(10, 3).values()]
    draw = np.random.default_rng(4)
    model = lm.Model(draw.normal(0, 0.3, sum(sizes)).astype(np.float32), limits)
    target = draw.integers(0, 10, 50)
    order, classes = lm.by_class(model, target)
    assert sorted(order.tolist()) == list(range(50))
    assert [c for c, *_ in classes] == [1, 2]  # that of one word has nothing to add
    for c, low, high, rows in classes:
        assert (low, high) == (limits[c], limits[c + 1])
        assert order[rows].tolist() == np.flatnonzero((target >= low) & (target < high)).tolist()
    steps, lanes = 5, 3
    inputs = draw.integers(0, 10, (steps, lanes))
    keep = np.ones((steps, lanes), np.float32)
    keep[2, 1] = 0
    state = draw.normal(0, 0.3, (lanes, lm.HIDDEN)).astype(np.float32)
    states, (read, gates, inner, candidates) = lm.unroll(model, inputs, keep, state, True)
    assert np.array_equal(lm.unroll(model, inputs, keep, state)[0], states)
    parts, h = model.parts, state
    logistic = lambda x: 1 / (1 + np.exp(-x))
    cut = 2 * lm.HIDDEN
    for t in range(steps):
        h = h * keep[t][:, None]
        given = parts["embedding"][inputs[t]] @ parts["inner"] + parts["gates"]
        turned = h @ parts["state"]
        z, r = np.split(logistic(given[:, :cut] + turned[:, :cut]), 2, axis=1)
        n = np.tanh(given[:, cut:] + r * turned[:, cut:])
        assert np.allclose(read[t, : lm.HIDDEN].T, h, atol=1e-5) and (read[t, -1] == 1).all()
        assert np.allclose(gates[t].T, np.hstack([z, r]), atol=1e-5)
        assert np.allclose(inner[t].T, turned[:, cut:], atol=1e-5)
        assert np.allclose(candidates[t].T, n, atol=1e-5)
        h = (1 - z) * n + z * h
        assert np.allclose(states[t], h, atol=1e-5)
