"""The classifiers against slow plain versions: counting of n-grams, forward pass, training step, votes."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyhouse.llm import features, language_id, quality_classifier
from tallyhouse.llm.text import as_block

WHOLE = (1 << 64) - 1
BASE, MIX = 0x5851F42D4C957F2D, 0x9E3779B97F4A7C15
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def mixed(x):
    x = (x ^ x >> 31) * MIX & WHOLE
    x = (x ^ x >> 29) * BASE & WHOLE
    return x ^ x >> 32


def plain_character_grams(text, sizes, buckets):
    data, found = (text or "").encode(), Counter()
    for n in sizes:
        for i in range(len(data) - n + 1):
            h = 0
            for b in data[i:i + n]:
                h = (h * BASE + b + 1) & WHOLE
            found[(mixed(h) + n & WHOLE) % buckets] += 1
    return found


def plain_word_grams(text, sizes, buckets):
    words, found = WORD.findall((text or "").encode()), Counter()
    hashes = [mixed(sum((b + 1) * pow(BASE, i, 1 << 64) for i, b in enumerate(w)) + len(w) & WHOLE) for w in words]
    for n in sizes:
        for i in range(len(words) - n + 1):
            h = 0
            for x in hashes[i:i + n]:
                h = (h * BASE + x) & WHOLE
            found[(mixed(h) + n & WHOLE) % buckets] += 1
    again = sum(a == b for a, b in zip(words, words[1:]))
    if again:
        found[features.REPEAT % buckets] += again
    return found


def quality_grams(text, buckets):
    q = quality_classifier
    return plain_word_grams(text, q.WORD_SIZES, buckets) + plain_character_grams(text, q.CHARACTER_SIZES, buckets)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(4)
    return [None, "", " ", "a", "ab a ab", "no no no more", "É ü ß 漢字 😀", "x" * 300, "\x00\x85\xa0\n\ttail.\n",
            *(" ".join("".join(draw.choices("abcé ", k=7)) for _ in range(12)) for _ in range(8)), "ab a ab"]


def test_grams_equal_plain_counts(texts):
    block, buckets = as_block(pa.array(texts)), 997
    counted = features.counted(*quality_classifier._grams(block, buckets), len(block))
    assert [dict(zip(f.tolist(), c.tolist())) for f, c in counted] == [dict(quality_grams(t, buckets)) for t in texts]
    counted = features.counted(*features.character_grams(block, language_id.SIZES, buckets), len(block))
    assert [dict(zip(f.tolist(), c.tolist())) for f, c in counted] == [
        dict(plain_character_grams(t, language_id.SIZES, buckets)) for t in texts]


def test_quality_scores_equal_a_plain_forward_pass(texts):
    buckets, draw = 64, np.random.default_rng(2)
    model = quality_classifier.Model(draw.normal(0, 5, (buckets, 3)).astype(np.float32),
                                     draw.normal(0, 1, 3).astype(np.float32), [0, 1, 2])
    found = model.probabilities(as_block(pa.array(texts)))
    for text, row in zip(texts, found):
        grams = quality_grams(text, buckets)
        total = grams.total() + quality_classifier.NEUTRAL
        logits = [sum(n * float(model.logits[f, k]) for f, n in grams.items()) / total + float(model.bias[k]) for k in range(3)]
        exps = [math.exp(v - max(logits)) for v in logits]
        assert np.allclose(row, [e / sum(exps) for e in exps], atol=1e-5)


def test_a_quality_step_equals_a_plain_one():
    """One row and one epoch: the vectors and the layer after a single step."""
    buckets, d, rate = 8, 3, 0.5
    found, counts, label = np.array([1, 4, 6]), np.array([2, 1, 7]), 1
    vectors = np.random.default_rng(7).uniform(-1, 1, (buckets, d)).astype(np.float32) / d
    model = quality_classifier.train([(found, counts, label)], buckets, d, epochs=1, rate=rate, seed=7)
    share = [c / (10 + quality_classifier.NEUTRAL) for c in counts.tolist()]
    mean = [sum(s * float(vectors[f, j]) for s, f in zip(share, found)) for j in range(d)]
    error = [0.5, 0.5 - 1]  # the layer begins at 0, so both labels are alike
    layer = [[-rate * mean[j] * error[k] for k in range(2)] for j in range(d)]
    # The step on the vectors goes through the layer as it was, which is 0.
    logits = [[sum(float(vectors[f, j]) * layer[j][k] for j in range(d)) for k in range(2)] for f in range(buckets)]
    assert np.allclose(model.logits, logits, atol=1e-6) and np.allclose(model.bias, [-rate / 10 * e for e in error])


def test_two_quality_steps_move_the_vectors_through_the_layer():
    buckets, d, rate = 8, 3, 0.5
    row = (np.array([1, 4]), np.array([3, 5]), 0)
    model = quality_classifier.train([row], buckets, d, epochs=2, rate=rate, seed=7)
    vectors = [[float(v) for v in r] for r in np.random.default_rng(7).uniform(-1, 1, (buckets, d)).astype(np.float32) / d]
    layer, bias, share = [[0.0] * 2 for _ in range(d)], [0.0, 0.0], [3 / 58, 5 / 58]
    for pace in (rate, rate / 2):
        mean = [sum(s * vectors[f][j] for s, f in zip(share, (1, 4))) for j in range(d)]
        logits = [sum(mean[j] * layer[j][k] for j in range(d)) + bias[k] for k in range(2)]
        exps = [math.exp(v - max(logits)) for v in logits]
        error = [e / sum(exps) - (k == 0) for k, e in enumerate(exps)]
        back = [sum(layer[j][k] * error[k] for k in range(2)) for j in range(d)]
        layer = [[layer[j][k] - pace * mean[j] * error[k] for k in range(2)] for j in range(d)]
        bias = [b - pace / 10 * e for b, e in zip(bias, error)]
        for s, f in zip(share, (1, 4)):
            vectors[f] = [v - pace * s / sum(x * x for x in share) * back[j] for j, v in enumerate(vectors[f])]
    expected = [[sum(v[j] * layer[j][k] for j in range(d)) for k in range(2)] for v in vectors]
    assert np.allclose(model.logits, expected, atol=1e-5) and np.allclose(model.bias, bias, atol=1e-6)


def plain_language(model, grams):
    """Language and score of a text from its n-grams: family first, then votes within it."""
    total = max(1, grams.total())
    margins = [sum(n * float(model.weights[f, k]) for f, n in grams.items()) / total + float(model.bias[k])
               for k in range(model.weights.shape[1])]
    n = len(model.families)
    best = max(range(n), key=lambda k: (margins[k], -k))
    logistic = lambda x: 1 / (1 + math.exp(-max(-30, min(30, 2 * x))))
    members, score = model.members[model.families[best]], logistic(margins[best])
    if len(members) == 1:
        return members[0], score
    votes, sums = Counter(), Counter()
    for k, (a, b) in enumerate(model.pairs):
        if a in members:
            votes[a if margins[n + k] >= 0 else b] += 1
            sums[a] += margins[n + k]
            sums[b] -= margins[n + k]
    winner = max(members, key=lambda m: (votes[m], sums[m], members.index(m)))
    return winner, score * logistic(sums[winner] / (len(members) - 1))


def test_languages_equal_a_plain_vote(texts):
    buckets, draw = 128, np.random.default_rng(5)
    members = {"f": ["a", "b", "c"], "g": ["d"], "h": ["e", "f"]}
    pairs = [("a", "b"), ("a", "c"), ("b", "c"), ("e", "f")]
    seen = set()
    for _ in range(6):
        model = language_id.Model(draw.normal(0, 3, (buckets, 7)).astype(np.float32), draw.normal(0, 0.3, 7), list("fgh"), members, pairs)
        names, scores = model.predict(as_block(pa.array(texts)))
        for text, name, score in zip(texts, names, scores):
            wanted, value = plain_language(model, plain_character_grams(text, language_id.SIZES, buckets))
            assert name == wanted and abs(score - value) < 1e-5
        seen |= set(names)
    assert len(seen) >= 4


def test_a_tie_of_votes_goes_to_the_larger_margins():
    # Each of three languages beats one other; the sums of margins decide, and of equal ones the last.
    for margins, winner in (([1, -2, 1], "c"), ([2, -1, 1], "a"), ([1, -1, 1], "c")):
        model = language_id.Model(np.zeros((4, 4), np.float32), np.array([0.0, *margins]), ["f"], {"f": list("abc")},
                                  [("a", "b"), ("a", "c"), ("b", "c")])
        assert model.predict(as_block(pa.array(["x"])))[0] == [winner]
        assert plain_language(model, Counter({0: 1}))[0] == winner


def test_a_machine_step_equals_a_plain_one():
    weights = np.array([0.5, -0.25, 1.0, 0.0])
    for sign, inside in ((1, True), (-1, True), (1, False)):
        values, bias = np.array([0.25, 0.75]) * (1 if inside else 40), 0.1
        margin = sign * (0.5 * values[0] + 1.0 * values[1] + bias)
        assert (margin < 1) == inside
        shrunk = [w * (1 - 2.0 * language_id.PENALTY) for w in weights]
        if inside:
            shrunk[0] += 2.0 * 1.5 * sign * values[0]
            shrunk[2] += 2.0 * 1.5 * sign * values[1]
            bias += 2.0 * 1.5 * sign * language_id.BIAS_SHARE
        after = weights.copy()
        assert math.isclose(language_id.subgradient_step(after, 0.1, np.array([0, 2]), values, sign, 1.5, 2.0), bias)
        assert np.allclose(after, shrunk)


def test_machines_settle_however_long_they_are_trained(monkeypatch):
    """The penalty bounds the weights; twice the epochs give nearly the same machine."""
    monkeypatch.setattr(language_id, "PENALTY", 1e-2)
    monkeypatch.setattr(language_id, "START", 3)
    draw = random.Random(1)
    rows = [(np.array([s, 2, 3]), np.array([0.6, 0.2 + draw.random() / 10, 0.1])) for s in (0, 1) for _ in range(40)]
    signs = np.array([1] * 40 + [-1] * 40)
    short, long = (language_id._machine(rows, signs, 5, epochs, np.random.default_rng(0))[0] for epochs in (100, 200))
    assert np.linalg.norm(long - short) < 0.1 * np.linalg.norm(long) and short[0] > 0 > short[1]
    assert all(s * (v @ long[f]) > 0 for (f, v), s in zip(rows, signs))
    assert not language_id._machine([], np.zeros(0, int), 5, 3, np.random.default_rng(0))[0].any()
