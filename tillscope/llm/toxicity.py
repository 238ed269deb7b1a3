"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word goes in as the sum of a word vector and the mean vector of its character
n-grams. Overlapping windows of every whole text are read in both directions,
attention pools the states of a window into one logit, and a document scores as
its most toxic window. The network is trained here, in numpy, on windows of a
bounded sample: which windows of a toxic document are the toxic ones is first
guessed from word counts and then told by the network itself.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import remainder, table
from tillscope.llm.labelled import SAMPLE_ROWS, labelled_sample

#: Words of a window, and between the starts of two.
WINDOW, STRIDE = 24, 6
#: The same for windows that are trained on.
TRAIN_STRIDE = 12
#: Parts of the examples that are left out in turn to set the curve.
FOLDS = 2
INPUT, HIDDEN = 16, 8
WORD_SLOTS, GRAM_SLOTS = 1 << 15, 1 << 15
GRAMS = (3, 4)
#: Bytes of text that are scored at once.
BATCH_BYTES = 2_000_000
#: Windows that are read side by side.
ROWS_READ = 2048
#: Passes over the windows in each round of training, and rows of a step. After a round
#: the network tells the toxic windows anew and the clean ones that it doubts.
EPOCHS, ROWS = (4, 3, 3, 3), 128
RATE, WORD_DROPOUT = 0.015, 0.25
CLEAN_WINDOWS, DOUBTED_WINDOWS, DOUBTED = 1, 3, -2.0
TOXIC = 0.3
HELD_OUT_MODULUS, HELD_OUT = 4, 2
PAD = -1


# --- words ------------------------------------------------------------------------------

def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def gram_slots(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(slots, counts): the n-gram slots of all words, one word behind the other.

    Words stand between two border signs; one too short for any n-gram has one of its own.
    """
    joined = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), dtype=np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(joined))  # bytes up to the word's end
    owner = np.repeat(np.arange(len(words)), sizes)
    found, owners = [], []
    value = np.zeros(len(joined), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        value = value * np.uint64(0x9E3779B97F4A7C15) + np.concatenate([joined[n - 1 :], np.zeros(n - 1, np.uint64)]) + np.uint64(n)
        if n in GRAMS:
            there = left >= n
            mixed = (value[there] ^ (value[there] >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
            found.append((mixed >> np.uint64(64 - GRAM_SLOTS.bit_length() + 1)).astype(np.int64))
            owners.append(owner[there])
    slots, owners = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return slots[order], np.bincount(owners, minlength=len(words))


def word_slots(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), dtype=np.int64, count=len(words)) & (WORD_SLOTS - 1)


def _means(vectors: np.ndarray, slots: np.ndarray, counts: np.ndarray) -> np.ndarray:
    starts = np.cumsum(counts) - counts
    return np.add.reduceat(vectors[slots], starts, axis=0) / counts[:, None].astype(vectors.dtype)


def window_starts(count: int, stride: int = STRIDE) -> np.ndarray:
    """Starts of the windows of a text of ``count`` words: every word is in one, the last ends it."""
    if count <= WINDOW:
        return np.zeros(1, dtype=np.int64)
    return np.append(np.arange(0, count - WINDOW, stride), count - WINDOW)


# --- the network -------------------------------------------------------------------------

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(x * np.float32(0.5)) + np.float32(1))


class Network:
    """Weights: words, grams (vectors), and for each direction inputs, recurrent, bias;
    attention and output over the states of both directions."""

    def __init__(self, seed: int = 13):
        rng = np.random.default_rng(seed)
        small = lambda *shape: (rng.standard_normal(shape) * 0.3 / np.sqrt(shape[0])).astype(np.float32)
        self.words = np.zeros((WORD_SLOTS, INPUT), np.float32)
        self.grams = (rng.standard_normal((GRAM_SLOTS, INPUT)) * 0.1).astype(np.float32)
        self.inputs = small(INPUT, 6 * HIDDEN) * np.float32(3)
        self.bias = np.zeros(6 * HIDDEN, np.float32)
        self.recurrent = [small(HIDDEN, 3 * HIDDEN), small(HIDDEN, 3 * HIDDEN)]
        self.attention = small(2 * HIDDEN)
        self.output = small(2 * HIDDEN)
        self.offset = np.zeros(1, np.float32)
        self.slope, self.shift = 1.0, 0.0

    def projections(self, words: list[bytes], keep: np.ndarray | None = None) -> np.ndarray:
        """What each word adds to the gates of both directions."""
        if not words:
            return np.zeros((0, 6 * HIDDEN), np.float32)
        out = np.empty((len(words), 6 * HIDDEN), np.float32)
        for at in range(0, len(words), 20_000):
            some = words[at : at + 20_000]
            vectors = _means(self.grams, *gram_slots(some)) + self.words[word_slots(some)]
            out[at : at + len(some)] = vectors @ self.inputs + self.bias
        return out

    def _direction(self, gates: np.ndarray, mask: np.ndarray | None, side: int, keep: bool):
        """States after each step: gates is (steps, rows, 3 * HIDDEN) in reading order."""
        recurrent = self.recurrent[side]
        state = np.zeros((gates.shape[1], HIDDEN), np.float32)
        states, trace = [], []
        for t in range(len(gates)):
            inner = state @ recurrent
            both = _sigmoid(gates[t, :, : 2 * HIDDEN] + inner[:, : 2 * HIDDEN])
            update, reset = both[:, :HIDDEN], both[:, HIDDEN:]
            new = np.tanh(gates[t, :, 2 * HIDDEN :] + reset * inner[:, 2 * HIDDEN :])
            after = new + update * (state - new)
            if mask is not None:
                after = np.where(mask[t][:, None], after, state)
            if keep:
                trace.append((state, inner, update, reset, new))
            state = after
            states.append(state)
        return states, trace

    def logits(self, table_: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Logit of each window: rows of word numbers into ``table_`` (projections), PAD behind the end."""
        out = np.empty(len(windows), np.float32)
        for at in range(0, len(windows), ROWS_READ):
            forward, backward, mask = self._read(table_, windows[at : at + ROWS_READ], keep=False)
            out[at : at + ROWS_READ] = self._pooled(forward[0], backward[0], mask)[0]
        return out

    def _read(self, table_, windows, keep):
        steps = windows.T
        mask = steps != PAD
        whole = bool(mask.all())
        gates = table_[np.where(mask, steps, 0)]
        half = 3 * HIDDEN
        forward = self._direction(gates[:, :, :half], None if whole else mask, 0, keep)
        backward = self._direction(gates[::-1, :, half:], None if whole else mask[::-1], 1, keep)
        return forward, (backward[0][::-1], backward[1]), mask

    def _pooled(self, forward, backward, mask):
        a, o = self.attention, self.output
        weights = np.stack([f @ a[:HIDDEN] + b @ a[HIDDEN:] for f, b in zip(forward, backward)])
        weights = np.exp(np.where(mask, weights - weights.max(axis=0), -1e9))
        weights /= np.maximum(weights.sum(axis=0), 1e-30)  # nothing is read of a window without words
        values = np.stack([f @ o[:HIDDEN] + b @ o[HIDDEN:] for f, b in zip(forward, backward)])
        return (weights * values).sum(axis=0) + self.offset[0], weights, values

    def gradients(self, vectors: np.ndarray, windows: np.ndarray, labels: np.ndarray, costs: np.ndarray):
        """Gradients of the mean logistic loss, for the dense weights by name and for ``vectors``."""
        table_ = vectors @ self.inputs + self.bias
        forward, backward, mask = self._read(table_, windows, keep=True)
        logit, weights, values = self._pooled(forward[0], backward[0], mask)
        slope = ((_sigmoid(logit) - labels) * costs / len(labels)).astype(np.float32)
        to_values = weights * slope
        to_weights = weights * (values - (weights * values).sum(axis=0)) * slope
        grads = {"offset": np.array([slope.sum()], np.float32)}
        halves = {"output": to_values, "attention": to_weights}
        for name, by in halves.items():
            grads[name] = np.concatenate([
                sum(s.T @ g for s, g in zip(states, by)) for states in (forward[0], backward[0])
            ])
        steps = np.where(mask, windows.T, 0)
        into = np.zeros((len(vectors), 6 * HIDDEN), np.float32)
        for side, (states, trace) in enumerate((forward, backward)):
            part = slice(0, HIDDEN) if side == 0 else slice(HIDDEN, None)
            outer = to_values[:, :, None] * self.output[part] + to_weights[:, :, None] * self.attention[part]
            order = range(len(trace) - 1, -1, -1)
            carried = np.zeros((len(labels), HIDDEN), np.float32)
            recurrent, change = self.recurrent[side], np.zeros_like(self.recurrent[side])
            for k in order:
                t = k if side == 0 else len(trace) - 1 - k  # the step of the window that was read k-th
                state, inner, update, reset, new = trace[k]
                live = mask[t][:, None]
                total = carried + outer[t]
                flow = np.where(live, total, 0)
                d_new = flow * (1 - update) * (1 - new * new)
                d_update = flow * (state - new) * update * (1 - update)
                d_reset = d_new * inner[:, 2 * HIDDEN :] * reset * (1 - reset)
                gate = np.concatenate([d_update, d_reset, d_new], axis=1)
                back = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
                change += state.T @ back
                carried = np.where(live, flow * update + back @ recurrent.T, total)
                np.add.at(into[:, side * 3 * HIDDEN : (side + 1) * 3 * HIDDEN], steps[t], gate)
            grads[f"recurrent{side}"] = change
        grads["inputs"] = vectors.T @ into
        grads["bias"] = into.sum(axis=0)
        return grads, into @ self.inputs.T, logit


# --- training ----------------------------------------------------------------------------

class _Adam:
    def __init__(self):
        self.moments: dict[str, tuple] = {}

    def step(self, weights: dict[str, np.ndarray], grads: dict[str, np.ndarray], rate: float) -> None:
        for name, grad in grads.items():
            first, second, n = self.moments.get(name, (np.zeros_like(grad), np.zeros_like(grad), 0))
            first, second, n = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad, n + 1
            self.moments[name] = first, second, n
            weights[name] -= (rate * (first / (1 - 0.9**n)) / (np.sqrt(second / (1 - 0.99**n)) + 1e-8)).astype(np.float32)


def _sparse_step(vectors: np.ndarray, squares: np.ndarray, slots: np.ndarray, grads: np.ndarray, rate: float) -> None:
    """Adagrad on the rows that a step has met."""
    order = np.argsort(slots, kind="stable")
    rows, starts = np.unique(slots[order], return_index=True)
    total = np.add.reduceat(grads[order], starts, axis=0)
    squares[rows] += total * total
    vectors[rows] -= rate * total / (np.sqrt(squares[rows]) + 1e-6)


class _Trainer:
    def __init__(self, network: Network, words: list[bytes]):
        self.network, self.adam = network, _Adam()
        self.slots, self.counts = gram_slots(words)
        self.starts = np.cumsum(self.counts) - self.counts
        self.own = word_slots(words)
        self.word_squares = np.zeros_like(network.words)
        self.gram_squares = np.zeros_like(network.grams)
        self.rng = np.random.default_rng(17)

    def step(self, windows: np.ndarray, labels: np.ndarray, costs: np.ndarray) -> None:
        net = self.network
        used, place = np.unique(windows[windows != PAD], return_inverse=True)
        local = np.full(windows.shape, PAD)
        local[windows != PAD] = place
        counts = self.counts[used]
        grams = np.concatenate([self.slots[self.starts[w] : self.starts[w] + self.counts[w]] for w in used])
        named = (self.rng.random(len(used)) >= WORD_DROPOUT).astype(np.float32)[:, None]
        vectors = _means(net.grams, grams, counts) + net.words[self.own[used]] * named
        grads, into, _ = net.gradients(vectors, local, labels, costs)
        dense = {"inputs": net.inputs, "bias": net.bias, "recurrent0": net.recurrent[0], "recurrent1": net.recurrent[1],
                 "attention": net.attention, "output": net.output, "offset": net.offset}
        self.adam.step(dense, grads, RATE)
        _sparse_step(net.words, self.word_squares, self.own[used], into * named, 0.1)
        _sparse_step(net.grams, self.gram_squares, grams, np.repeat(into / counts[:, None], counts, axis=0), 0.1)

    def epochs(self, windows: np.ndarray, labels: np.ndarray, count: int) -> None:
        share = max(1, labels.sum()) / len(labels)
        costs = np.where(labels == 1, 0.3 / share, 0.7 / max(1 - share, 1e-3))
        for _ in range(count):
            order = self.rng.permutation(len(windows))
            for at in range(0, len(order), ROWS):
                rows = order[at : at + ROWS]
                self.step(windows[rows], labels[rows].astype(np.float32), costs[rows])


def _windows(codes: np.ndarray, stride: int) -> np.ndarray:
    starts = window_starts(len(codes), stride)
    out = np.full((len(starts), WINDOW), PAD)
    for k, at in enumerate(starts):
        part = codes[at : at + WINDOW]
        out[k, : len(part)] = part
    return out


def fit(examples: list[tuple[bytes, int]], folds: int = FOLDS) -> Network:
    """Trains on the windows of labelled texts; the curve to a score is set on rows left out.

    Each of ``folds`` parts of the examples is judged by a network that is trained on the
    others, and the curve is laid through these logits. Without examples of both classes
    every score is the smoothed share of label 1; with fewer than ``folds`` of a class
    the curve is laid through the examples' own logits.
    """
    network = Network()
    labels = np.array([y for _, y in examples], dtype=int)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        network.slope, network.shift = 0.0, float(np.log(share / (1 - share)))
        return network
    best = _train(network, examples, labels)
    if folds > 1 and min(labels.sum(), (1 - labels).sum()) >= folds:
        # every class in turn goes to the parts, so that none lacks one
        part = np.empty(len(labels), dtype=int)
        for label in (0, 1):
            rows = np.flatnonzero(labels == label)
            part[rows] = np.arange(len(rows)) % folds
        for k in range(folds):
            other = Network()
            _train(other, [e for e, p in zip(examples, part) if p != k], labels[part != k])
            left = np.flatnonzero(part == k)
            best[left] = _best(other, [tokens(examples[i][0]) for i in left])
    network.slope, network.shift = _curve(best, labels)
    return network


def _curve(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the logits: Newton's steps, halved until the loss falls."""
    centre, width = logits.mean(), max(logits.std(), 1e-6)
    design = np.stack([(logits - centre) / width, np.ones_like(logits)], axis=1)
    good, bad = labels.sum(), (1 - labels).sum()
    goal = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))

    def loss(beta: np.ndarray) -> float:
        margin = design @ beta
        return float((np.logaddexp(0, margin) - goal * margin).sum() + 5e-4 * beta @ beta)

    beta, now = np.zeros(2), loss(np.zeros(2))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - goal) + 1e-3 * beta
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2), gradient)
        while np.abs(step).max() > 1e-9 and loss(beta - step) > now:
            step /= 2
        beta, before = beta - step, now
        now = loss(beta)
        if before - now < 1e-10:
            break
    slope = max(float(beta[0] / width), 0.0)
    return slope, float(beta[1] - slope * centre)


def _train(network: Network, examples: list[tuple[bytes, int]], labels: np.ndarray) -> np.ndarray:
    """Trains the network; returns the greatest logit of each example."""
    vocab: dict[bytes, int] = {}
    texts = [np.array([vocab.setdefault(w, len(vocab)) for w in tokens(t)], dtype=np.int64) for t, _ in examples]
    words = list(vocab)
    windows = [_windows(c, TRAIN_STRIDE) for c in texts]
    # how much likelier a word is in toxic documents than in others
    seen = np.zeros((2, len(words)))
    for codes, label in zip(texts, labels):
        seen[label, np.unique(codes)] += 1
    odds = np.log((seen[1] + 0.5) / (labels.sum() + 1)) - np.log((seen[0] + 0.5) / ((1 - labels).sum() + 1))
    padded = np.append(np.clip(odds, 0, None) ** 2, 0.0)  # PAD is the last
    guess = [padded[w].max(axis=1) for w in windows]
    trainer, rng = _Trainer(network, words), np.random.default_rng(19)
    clean = [found[rng.integers(0, len(found), CLEAN_WINDOWS)] for found, label in zip(windows, labels) if label == 0]
    for round_, epochs in enumerate(EPOCHS):
        toxic = []
        for found, label, score in zip(windows, labels, guess):
            if label == 1:  # the likeliest window, and others that are nearly as likely
                toxic.append(found[score >= (0.8 * score.max() if round_ == 0 else min(score.max(), 1.0))])
            elif round_:  # stays for the rounds to come
                worst = np.argsort(-score)[:DOUBTED_WINDOWS]
                clean.append(found[worst[score[worst] > DOUBTED]])
        chosen = np.concatenate(toxic + clean)
        trainer.epochs(chosen, (np.arange(len(chosen)) < sum(map(len, toxic))).astype(int), epochs)
        every = network.logits(network.projections(words), np.concatenate(windows))
        guess = np.split(every, np.cumsum([len(w) for w in windows])[:-1])
    return _best(network, [tokens(t) for t, _ in examples])


def fitted(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Network:
    usable = remainder(F.col("doc_id"), HELD_OUT_MODULUS) != HELD_OUT
    return fit(labelled_sample(docs, labels, "toxic", usable, rows=rows))


# --- scoring -----------------------------------------------------------------------------

def _best(network: Network, texts: list[list[bytes]], stride: int = STRIDE) -> np.ndarray:
    """The greatest logit of the windows of each text."""
    vocab: dict[bytes, int] = {}
    codes = [np.array([vocab.setdefault(w, len(vocab)) for w in t], dtype=np.int32) for t in texts]
    table_ = network.projections(list(vocab)) if vocab else np.zeros((1, 6 * HIDDEN), np.float32)
    best = np.full(len(texts), -np.inf)
    long = [i for i, c in enumerate(codes) if len(c) >= WINDOW]
    if long:
        every = np.concatenate([codes[i] for i in long])
        offsets = np.cumsum([0] + [len(codes[i]) for i in long])
        starts = [window_starts(len(codes[i]), stride) + at for i, at in zip(long, offsets)]
        owner = np.repeat(long, [len(s) for s in starts])
        starts = np.concatenate(starts)
        for at in range(0, len(starts), 20_000):
            part = starts[at : at + 20_000]
            windows = every[part[:, None] + np.arange(WINDOW)]
            np.maximum.at(best, owner[at : at + 20_000], network.logits(table_, windows))
    short = [i for i, c in enumerate(codes) if len(c) < WINDOW]
    for at in range(0, len(short), 20_000):
        part = short[at : at + 20_000]
        windows = np.full((len(part), WINDOW), PAD)
        for k, i in enumerate(part):
            windows[k, : len(codes[i])] = codes[i]
        best[part] = network.logits(table_, windows)
    return best


def _scores(network: Network, texts: list[list[bytes]]) -> np.ndarray:
    """Score of each text: the greatest logit of its windows, on the fitted curve."""
    return 1 / (1 + np.exp(-np.clip(network.slope * _best(network, texts) + network.shift, -30, 30)))


def score(docs: DataFrame, text: Column, network: Network) -> Column:
    """Score in 0 to 1 of every whole text; null and blank texts are a window without words."""
    shared = docs.sparkSession.sparkContext.broadcast(network)  # two tables of 2 MB and a few weights

    @F.pandas_udf("double")
    def toxicity(texts: pd.Series) -> pd.Series:
        known, result, waiting, size = shared.value, [], [], 0
        for text in texts:
            waiting.append(tokens(text))
            size += len(text or b"")
            if size >= BATCH_BYTES:
                result.append(_scores(known, waiting))
                waiting, size = [], 0
        result.append(_scores(known, waiting))
        return pd.Series(np.concatenate(result))

    return toxicity(text.cast("binary"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text, others).

    The network is fitted on at most ``rows`` labelled documents, none of them held
    out. Null texts are scored as empty ones; a row with a null doc_id is scored
    and not held out; repeated rows get equal scores; empty tables give an empty
    result, and without usable labels every score is one half.
    """
    held_out = F.coalesce(remainder(F.col("doc_id"), HELD_OUT_MODULUS) == HELD_OUT, F.lit(False))
    scored = docs.select("doc_id", "text").withColumn("score", score(docs, F.col("text"), fitted(docs, labels, rows)))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score",
        F.when(F.col("score") >= TOXIC, 1).otherwise(0).alias("predicted"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
