"""Both classifiers: held-out accuracy on the given tables, and odd inputs."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tests.conftest import SF_DIR
from tests.llm.shapes import docs
from tillscope.llm import nbsvm, toxicity

BIG = SF_DIR.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def quality(spark):
    return nbsvm.query(spark, BIG).toPandas()


def test_quality_on_held_out_rows(spark, quality):
    labels = spark.read.parquet(f"{BIG}/labels.parquet").toPandas()
    held = quality[quality.held_out].merge(labels, on="doc_id")
    assert len(held) > 30 and (held.predicted == held.quality).mean() >= 0.95
    assert set(quality[quality.held_out].doc_id) == {
        i for i in quality.doc_id if zlib.crc32(str(i).encode()) % 5 == 0
    }
    assert quality.score.between(0, 1).all() and (quality.predicted == (quality.score >= 0.3)).all()


def test_features_are_the_ngrams_of_the_whole_text():
    assert len(nbsvm.features(None)) == len(nbsvm.features(b" \n")) == 0
    one = nbsvm.features(b"One two")
    assert len(one) == 2 + 1 + 2 + 1  # two words, a pair, two shapes (with and without a capital), a pair
    assert set(one) < set(nbsvm.features(b"x " * 50_000 + b"One two"))
    assert set(nbsvm.features(b"la la")) != set(nbsvm.features(b"la lb"))


def test_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(40, 6, replace=False)) for _ in range(60)]
    labels = np.array([int(r[0] < 5) for r in rows])
    ratios = nbsvm._log_ratios(rows, labels)
    weights, bias = nbsvm._coordinate_descent(rows, ratios, labels)
    signs = np.where(labels == 1, 1, -1)
    values = [ratios[r] / np.sqrt(ratios[r] @ ratios[r] + 1e-12) for r in rows]
    cost = nbsvm.COST * np.where(labels == 1, len(labels) / (2 * labels.sum()), len(labels) / (2 * (1 - labels).sum()))

    def loss(w, b):
        margins = np.array([v @ w[r] for v, r in zip(values, rows)]) + b
        return 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - signs * margins)).sum()

    best = loss(weights, bias)
    for _ in range(200):
        nudge = np.zeros_like(weights)
        nudge[:] = 0
        at = np.unique(np.concatenate(rows))
        nudge[at] = rng.standard_normal(len(at)) * 0.02
        assert loss(weights + nudge, bias + rng.standard_normal() * 0.02) >= best - 0.02


def toy(n=120, seed=3):
    rng = random.Random(seed)
    plain = ["la", "mo", "ren", "tis", "vel", "dor", "kai", "sun"]
    rows = []
    for i in range(n):
        words = [rng.choice(plain) + rng.choice(plain) for _ in range(rng.choice([5, 30, 80]))]
        if i % 3 == 0:
            words[rng.randrange(len(words))] = "vrak" + rng.choice(plain)
        rows.append((" ".join(words).encode(), int(i % 3 == 0)))
    return rows


@pytest.fixture(scope="module")
def network():
    return toxicity.fit(toy(360))


def test_toxic_words_never_seen_are_found_by_their_letters(network):
    clean = ["lamo", "rentis", "veldor"] * 20
    bad = clean[:31] + ["vraktoo"] + clean[31:]
    scores = toxicity._scores(network, [[w.encode() for w in t] for t in (clean, bad, clean * 40 + bad)])
    assert scores[0] < 0.3 <= scores[1] and scores[2] >= 0.3


def test_network_gradients():
    net = toxicity.Network()
    for name in ("inputs", "bias", "attention", "output", "offset"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.recurrent = [r.astype(np.float64) for r in net.recurrent]
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((7, toxicity.INPUT))
    windows = rng.integers(0, 7, (4, toxicity.WINDOW))
    windows[1, 9:] = toxicity.PAD
    labels, costs = np.array([1.0, 0.0, 1.0, 0.0]), np.ones(4)

    def loss():
        forward, backward, mask = net._read(vectors @ net.inputs + net.bias, windows, False)
        logit = net._pooled(forward[0], backward[0], mask)[0]
        return np.mean(np.logaddexp(0, -logit) * labels + np.logaddexp(0, logit) * (1 - labels))

    grads, into, _ = net.gradients(vectors, windows, labels, costs)
    pairs = [(net.inputs, grads["inputs"]), (net.recurrent[0], grads["recurrent0"]),
             (net.recurrent[1], grads["recurrent1"]), (net.attention, grads["attention"]), (vectors, into)]
    for weights, grad in pairs:
        at = tuple(rng.integers(0, s) for s in weights.shape)
        old = weights[at]
        weights[at] = old + 1e-3
        up = loss()
        weights[at] = old - 1e-3
        down = loss()
        weights[at] = old
        assert (up - down) / 2e-3 == pytest.approx(float(grad[at]), abs=2e-5)


def test_windows_overlap_and_cover_everything():
    for n in (0, 1, 23, 24, 25, 36, 37, 1000):
        starts = toxicity.window_starts(n)
        seen = set()
        for s in starts:
            seen |= set(range(s, min(n, s + toxicity.WINDOW)))
        assert seen == set(range(n)) and (n <= toxicity.WINDOW or starts[-1] + toxicity.WINDOW == n)
        assert all(b - a <= toxicity.STRIDE for a, b in zip(starts, starts[1:]))


def test_short_passages_are_whole_in_a_window():
    """Wherever a passage of WINDOW - STRIDE + 1 words lies, one window holds all of it."""
    length = toxicity.WINDOW - toxicity.STRIDE + 1
    for n in (24, 25, 60, 101):
        starts = toxicity.window_starts(n)
        for at in range(n - length + 1):
            assert any(s <= at and at + length <= s + toxicity.WINDOW for s in starts)


def test_the_curve_is_the_logistic_fit():
    """Against a fine grid, also where classes overlap, are parted, or the logits are large."""
    rng = np.random.default_rng(4)
    for scale, gap in ((1, 1), (5, 0.5), (40, 3), (0.1, 0)):
        labels = (rng.random(300) < 0.1).astype(int)
        logits = scale * (rng.standard_normal(300) + gap * labels) - 3 * scale
        slope, shift = toxicity._curve(logits, labels)
        good, bad = labels.sum(), (1 - labels).sum()
        goal = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))

        def loss(a, b):
            return np.sum(np.logaddexp(0, a * logits + b) - goal * (a * logits + b))

        own = loss(slope, shift)
        assert slope >= 0 and all(
            own <= loss(slope + da / scale, shift + db) + 1e-2 for da in (-0.05, 0, 0.05) for db in (-0.1, 0, 0.1) if slope + da / scale >= 0
        )
    assert toxicity._curve(np.array([1.0, 1.0, 1.0]), np.array([0, 1, 0]))[0] >= 0


@pytest.mark.parametrize("scores", [nbsvm.quality_scores, toxicity.toxicity_scores])
def test_odd_rows(spark, scores):
    rows = [(i, t.decode(), "s") for i, (t, _) in enumerate(toy(40))]
    odd = [(None, "vrakla mo", None), (900, None, "s"), (901, "", "s"), (901, "", "s"), (902, "la " * 30_000, "s")]
    df = docs(spark, rows + odd, extra="score")
    marks = [(i, y, y) for i, (_, y) in enumerate(toy(40))] + [(None, 1, 1), (900, None, None), (901, 1, 7)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = scores(df, labels).collect()
    assert len(got) == 45 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert len({r.score for r in got if r.doc_id == 901}) == 1
    none = labels.limit(0)
    assert all(r.score == pytest.approx(0.5) for r in scores(df, none).collect())
    assert scores(df.limit(0), labels).count() == 0


def test_accepted_keeps_all_columns(spark):
    df = docs(spark, [(1, "la mo", "s"), (2, None, None)], extra="quality_score")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    kept = nbsvm.accepted(df, labels)
    assert kept.columns == df.columns and kept.count() == 2
