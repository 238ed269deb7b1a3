from __future__ import annotations

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.shapes import docs
from tillscope.llm import lm


def corpus(n=80, seed=5):
    rng = random.Random(seed)
    words = ["The", "cat", "sat", "on", "a", "mat", "ÉTÉ", "dog"]
    rows = []
    for i in range(n):
        at, out = 0, []
        for _ in range(rng.choice([0, 1, 3, 20, 60])):
            at = (at + rng.choice([1, 1, 1, 2])) % len(words) if rng.random() < 0.9 else rng.randrange(len(words))
            out.append(words[at] if rng.random() < 0.95 else f"rare{rng.randrange(1000)}")
        rows.append((i, " ".join(out), "s"))
    return rows + [(1000, None, None), (1001, "", "s"), (1002, "\t\n", "s"), (None, "the cat sat", "s"), (3, "the cat sat", "s")]


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def backoff(rows, order, least_word, least):
    """The model as dictionaries: probability of a word after a history, by recursion."""
    train = [tokens(t) for i, t, _ in rows if not held(i)]
    grams = [collections.Counter() for _ in range(order + 1)]
    for words in train:
        for n in range(1, order + 1):
            grams[n].update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    total, types = sum(grams[1].values()), len(grams[1])
    frequent = {g for g, c in grams[1].items() if c >= least_word * total}
    kept = {n: {g: c for g, c in grams[n].items() if c >= max(1, least * total) and all((w,) in frequent for w in g)} for n in range(2, order + 1)}
    for n in range(3, order + 1):
        kept[n] = {g: c for g, c in kept[n].items() if g[:-1] in kept[n - 1] and g[1:] in kept[n - 1]}

    def p(word, history):
        if not history:
            return (grams[1][(word,)] + 0.5) / (total + 0.5 * (types + 1))
        n = len(history) + 1
        arcs = {g: c for g, c in kept[n].items() if g[:-1] == history}
        if not arcs:
            return p(word, history[1:])
        whole = grams[n - 1][history]
        rest = 1 - sum(c - 0.5 for c in arcs.values()) / whole
        own = (arcs.get(history + (word,), 0.5) - 0.5) / whole
        return own + max(rest, 1e-12) * p(word, history[1:])

    return p, grams[1], total, types


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("least", [1e-6, 0.004])
def test_scores_are_those_of_the_recursive_model(spark, monkeypatch, order, least):
    monkeypatch.setattr(lm, "NGRAM_SHARE", least)
    monkeypatch.setattr(lm, "WORD_SHARE", least)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 700)
    rows = corpus()
    p, counts, total, types = backoff(rows, order, least, least)
    memo = {}

    def cached(word, history):
        key = word, history
        if key not in memo:
            memo[key] = math.log10(p(word, history))
        return memo[key]

    got = lm.language_model_scores(docs(spark, rows, extra="block").repartition(3), order=order).collect()
    expected = []
    for i, t, _ in rows:
        words = tokens(t)
        base = sum(math.log10((counts[(w,)] + 0.5) / (total + 0.5 * (types + 1))) for w in words)
        score = sum(cached(w, tuple(words[max(0, k - order + 1) : k])) for k, w in enumerate(words))
        expected.append((repr(i), held(i), len(words), sum(counts[(w,)] > 0 for w in words), total, round(base, 6), round(score, 6)))
    found = [(repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got]
    assert [x[:5] for x in sorted(found)] == [x[:5] for x in sorted(expected)]
    for a, b in zip(sorted(found), sorted(expected)):
        assert a[5:] == pytest.approx(b[5:], abs=1e-5)


def test_words_of_every_state_share_one():
    rng = np.random.default_rng(2)
    counts = np.array([0, 40, 30, 20, 10.0])
    keys = np.sort(rng.choice([(a << 32) | b for a in range(1, 5) for b in range(1, 5)], 9, replace=False))
    level = lm.Level(keys.astype(np.int64), rng.integers(1, 5, 9))
    model = lm.automaton(counts, [level], 100, 4, 4)
    roots = np.append(np.log10((counts[1:] + 0.5) / 102.5), np.log10(0.5 / 102.5))
    for first in range(1, 4):
        whole = 0.0
        for second, word in enumerate([1, 2, 3, 4, 0]):
            pair = lm.traverse(model, np.array([first, word]), np.array([roots[first - 1], roots[second]]), np.array([2]))
            whole += 10 ** (pair[0] - roots[first - 1])
        assert whole == pytest.approx(1.0)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_pieces_score_like_whole_documents(order):
    rng = np.random.default_rng(order)
    lengths = np.array([1, 500, 2, 7, 0, 64, 3])
    words = rng.choice([1, 2, 3, 4, 5], lengths.sum(), p=[0.4, 0.3, 0.15, 0.1, 0.05])
    grams, levels = {(w,): w for w in range(1, 6)}, []
    for n in range(2, order + 1):
        seen = collections.Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        found = sorted((grams[g[:-1]] << 32 | int(g[-1]), c) for g, c in seen.items())
        numbers = {k: i for i, (k, _) in enumerate(found, 1)}
        grams = {g: numbers[grams[g[:-1]] << 32 | int(g[-1])] for g in seen}
        levels.append(lm.Level(np.array([k for k, _ in found]), np.array([c for _, c in found])))
    counts = np.concatenate(([0], np.bincount(words, minlength=6)[1:])).astype(float)
    model = lm.automaton(counts, levels, len(words), 5, -1)
    roots = np.log10((counts + 0.5) / (len(words) + 3))[words]
    whole = lm.traverse(model, words, roots, lengths, size=10_000)
    for size in (1, 2, 5, 64):
        assert lm.traverse(model, words, roots, lengths, size=size) == pytest.approx(whole)


def test_nothing_to_learn_from(spark):
    only_held = [i for i in range(50) if held(i)][:2]
    got = lm.language_model_scores(docs(spark, [(i, "a b", "s") for i in only_held])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0)] * 2
    assert lm.language_model_scores(docs(spark, [])).count() == 0


def test_rare_ngrams_stay_in_a_large_table(spark):
    """More than a million training tokens: an n-gram that occurs once still has its arc."""
    rows = [(i, "f " * 999, "s") for i in range(2000)]
    train = next(i for i in range(3000, 4000) if not held(i))
    out = next(i for i in range(5000, 6000) if held(i))
    rows += [(train, "x y z", "s"), (out, "x y z", "s")]
    got = {r.doc_id: r for r in lm.language_model_scores(docs(spark, rows)).filter("doc_id >= 3000").collect()}
    total = got[out].train_tokens
    assert total > 1_000_000
    ends = sum(not held(i) for i in range(2000)) + 1
    one = lambda c: (c + 0.5) / (total + 0.5 * 6)  # noqa: E731  f, x, y, z and the end
    p = one(1)  # x
    for count, given in ((1, 2), (1, 3), (ends, 3)):  # y after x, z after x y, the end after y z
        q = one(count)
        for _ in range(given - 1):
            q = 0.5 + 0.5 * q
        p *= q
    assert got[out].score == pytest.approx(math.log10(p), abs=1e-6)
    assert got[train].score == pytest.approx(got[out].score)


@pytest.mark.parametrize("size", [0, 1, 1000])
def test_packed_columns_come_back_and_zero_bytes_take_no_room(size):
    rng = np.random.default_rng(size)
    hashes = rng.integers(-(2**63), 2**63 - 1, size)
    columns = [hashes, np.zeros(size, np.int64), rng.integers(0, 300, size), (rng.integers(0, 9, size) / 2).view(np.int64)]
    for found, given in zip(lm._unpack(lm._pack(*columns), 4), columns, strict=True):
        assert found.dtype == np.int64 and found.tolist() == given.tolist()
    assert len(lm._pack(hashes, columns[1])) == len(lm._pack(hashes)) + 1


def test_tokens_are_those_of_bytes_split():
    texts = [b" A\tb\x0bC\x0cd\re\nF  ", b"", b" \n", b"\xc3\x89 \xff\xfe \x1cx\x85Y", b"a\x00b  a\xa0", b"b"]
    numbers, lengths, vocab = lm._tokens(pa.array(texts, pa.binary()))
    expected = [t.lower().split() + [b""] for t in texts]
    assert [vocab[n] for n in numbers] == [w for words in expected for w in words]
    assert lengths.tolist() == [len(words) for words in expected]
    assert vocab[0] == lm.END and len(set(vocab)) == len(vocab)


def blocks_of(texts, monkeypatch, block_bytes, batch_rows):
    class Context:
        partitionId = staticmethod(lambda: 3)  # noqa: N815

    monkeypatch.setattr(lm, "TaskContext", type("Task", (), {"get": staticmethod(lambda: Context)}))
    monkeypatch.setattr(lm, "BLOCK_BYTES", block_bytes)
    rows = pa.table({
        "doc_id": pa.array([None if i == 2 else i for i in range(len(texts))], pa.int64()),
        "held": [i % 5 == 1 for i in range(len(texts))], "text": pa.array(texts, pa.binary()),
    })
    return list(lm._encode(iter(rows.to_batches(max_chunksize=batch_rows))))


@pytest.mark.parametrize("batch_rows", [1, 3, 100])
def test_blocks_close_with_the_document_that_fills_them(monkeypatch, batch_rows):
    texts = [b"one two", None, b"", b"x " * 40, b"three", b"four five six", b" ", b"y"] * 3
    sizes, expected, own, size = [len(t or b"") + 1 for t in texts], [], [], 0
    for i, n in enumerate(sizes):
        own.append(None if i == 2 else i)
        size += n
        if size >= 20:
            expected.append(own)
            own, size = [], 0
    expected += [own] * bool(own)
    blocks = blocks_of(texts, monkeypatch, 20, batch_rows)
    assert [b.column("doc_ids")[0].as_py() for b in blocks] == expected
    assert [b.column("block")[0].as_py() for b in blocks] == [(3 << 32) + k for k in range(len(blocks))]
    counts = [len(tokens(t and t.decode())) for t in texts]
    assert [n for b in blocks for n in b.column("lengths")[0].as_py()] == counts
    assert sum(b.column("n_train")[0].as_py() for b in blocks) == sum(n for i, n in enumerate(counts) if i % 5 != 1)


def test_ngrams_of_a_block_are_sorted_once_and_only_where_asked_for(monkeypatch):
    texts = [b"a b a b c", b"b a b", b"", b"c c c a b"]
    block = blocks_of(texts, monkeypatch, 10_000, 10)[0]
    sorts = []
    unique = np.unique
    monkeypatch.setattr(np, "unique", lambda *a, **k: sorts.append(1) or unique(*a, **k))
    alone = lm._grams(block, 0, 3, 3)
    assert len(alone) == 1 and len(sorts) == 1
    every = lm._grams(block, 0, 1, 3)
    assert len(every) == 3 and len(sorts) == 3
    assert alone[0].hashes.tolist() == every[2].hashes.tolist() == sorted(every[2].hashes, key=lambda h: int(h) % 2**64)
    words = [tokens(t.decode()) for t in texts]
    for n, own in enumerate(every, 1):
        seen = [tuple(w[k : k + n]) for w in words for k in range(len(w) - n + 1)]
        train = collections.Counter(tuple(w[k : k + n]) for i, w in enumerate(words) if i != 1 for k in range(len(w) - n + 1))
        ends = [int(x) for x in own.ending if x]
        assert len(own.hashes) == len(set(seen)) == len(set(zip(seen, ends, strict=True)))
        assert all(own.train[number - 1] == train[g] for g, number in zip(seen, ends, strict=True))
    text_of = {int(number): g for number, g in zip(every[1].ending, [g for w in words for g in [None, *zip(w, w[1:])]], strict=True) if number}
    for number, g in zip([x for x in every[2].ending if x], [g for w in words for g in zip(w, w[1:], w[2:])], strict=True):
        assert text_of[every[2].keys[number - 1] >> 32] == g[:2] and text_of[every[2].suffix[number - 1]] == g[1:]


def test_arcs_known_before_the_walk_are_those_that_a_search_finds():
    rng = np.random.default_rng(4)
    lengths = np.array([300, 1, 40, 0, 9])
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    words = rng.choice([1, 2, 3, 4], lengths.sum())
    ending, levels, arcs, before = words, [], [], 0
    for n in (2, 3):  # half of the n-grams, with their prefixes and suffixes
        ends = np.flatnonzero(np.arange(len(words)) - starts >= n - 1)
        ends = ends[(ending[ends - 1] > 0) & (ending[ends] > 0)]
        keys = (ending[ends - 1] << 32) | words[ends]
        kept = np.unique(keys)[::2]
        number = np.zeros(len(words), dtype=np.int64)
        number[ends] = np.where(np.isin(keys, kept), np.searchsorted(kept, keys) + 1, 0)
        levels.append(lm.Level(kept, rng.integers(1, 5, len(kept))))
        arcs.append(np.where(number > 0, number + before - 1, -1))
        ending, before = number, before + len(kept)
    counts = np.concatenate(([0], np.bincount(words, minlength=5)[1:])).astype(float)
    model = lm.automaton(counts, levels, len(words), 4, 4)
    roots = np.log10((counts + 0.5) / (len(words) + 2.5))[words]
    for size in (4, 1000):
        searched = lm.traverse(model, words, roots, lengths, size=size)
        assert lm.traverse(model, words, roots, lengths, size=size, arcs=np.array(arcs)) == pytest.approx(searched)


def test_shuffles_of_written_counts_are_let_go(spark, monkeypatch):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen, written = spark.conf.get(name, None), [], lm.written
    monkeypatch.setattr(lm, "written", lambda df, to: seen.append((to, spark.conf.get(name, None))) or written(df, to))
    lm.language_model_scores(docs(spark, [(1, "a b c", "s")]))
    assert [to for to, on in seen if on == "true"] == ["lm-counts-3", "lm-counts-2", "lm-counts-1"]
    assert spark.conf.get(name, None) == before
    with pytest.raises(ZeroDivisionError), lm.shuffles_let_go(spark):
        1 / 0  # noqa: B018
    assert spark.conf.get(name, None) == before
