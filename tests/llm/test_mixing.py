from __future__ import annotations

import collections
import math
import random
import re

import pytest

from tests.llm.shapes import docs, rows_of
from tillscope.llm import mixing


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    """Repeated resharing: what passes a limit goes to the sources that are not at theirs, by weight."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while left > 1e-9 and free:
        whole = sum(weight[s] for s in free)
        over = {s for s in free if target[s] + left * weight[s] / whole >= repeats * sizes[s]}
        if not over:
            for s in free:
                target[s] += left * weight[s] / whole
            break
        base = sum(target[s] for s in free) + left
        for s in over:
            target[s] = float(repeats * sizes[s])
        free -= over
        left = base - sum(target[s] for s in over)
        for s in free:
            target[s] = 0.0
    return target


def sample(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        source = rng.choice(["b", "a", "Z", "é", "hot", "hot", "hot", None, "tiny" if i < 2 else "a"])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), source))
    return rows + [(1000, None, "a"), (1001, "", "a"), (1002, " \n\t ", "empty"), (1003, None, "empty")]


@pytest.mark.parametrize("block", [16, 1024])
def test_targets_and_taken_words(spark, block):
    rows = sample()
    df = docs(spark, rows, extra="rank")
    got = mixing.mixed_documents(df, block_words=block).collect()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    total = collections.Counter()
    for i in size:
        total[source[i]] += size[i]
    targets = brute_targets(dict(total))
    taken = collections.Counter()
    assert sorted(r.doc_id for r in got) == sorted(size)
    for r in got:
        assert r["size"] == size[r.doc_id] and r.source_size == total[source[r.doc_id]]
        assert r.target == pytest.approx(targets[source[r.doc_id]], abs=1e-6)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source[r.doc_id]] += r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 0.5
    again = mixing.mixed_documents(df.repartition(5), block_words=block)
    assert rows_of(again, "doc_id", "taken") == sorted(((r.doc_id, r.taken) for r in got), key=repr)


def test_pieces_cover_each_pass_once_and_blocks_are_equal(spark):
    df = docs(spark, sample(2))
    pieces, sizes = mixing.mix(df, block_words=64)
    pieces = pieces.collect()
    per = collections.defaultdict(list)
    for p in pieces:
        per[p.doc_id, p["pass"]].append((p.from_word, p.from_word + p.words))
    known = {r.doc_id: r["size"] for r in sizes.collect()}
    for (doc, _), spans in per.items():
        spans.sort()
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= known[doc]
    slots = collections.Counter()
    for p in pieces:
        if p.slot is not None:
            slots[p.slot] += p.words
    assert max(slots.values()) == 64
    # any stretch of the schedule holds a source near its share
    half = [p for p in pieces if p.slot is not None and p.slot < max(slots) // 2]
    whole, first = collections.Counter(), collections.Counter()
    for p in pieces:
        whole[p.source] += p.words
    for p in half:
        first[p.source] += p.words
    for s in whole:
        assert abs(first[s] - whole[s] / 2) <= 64 * 6


def brute_slots(rows, got, block, repeats=2):
    """First slot and number of slots of every document, from golden-ratio points in a plain loop."""
    import xxhash

    def long_hash(value, seed):
        return xxhash.xxh64_intdigest((value % (1 << 64)).to_bytes(8, "little"), seed=seed)

    def signed(value):
        return value - (1 << 64) if value >> 63 else value

    sources = sorted({s for _, _, s in rows if s is not None}, key=lambda s: s.encode()) + [None] * any(s is None for _, _, s in rows)
    by_id = {r.doc_id: r for r in got}
    target = {s: next(by_id[i].target for i, _, own in rows if own == s) for s in sources}
    ends, upto = [], 0.0
    for s in sources:
        upto += target[s]
        ends.append(upto)
    slots = collections.defaultdict(list)
    for n in range(math.ceil(sum(target.values()) / block)):
        point = n % (1 << 31) * 1327217885 % (1 << 31) / (1 << 31)
        slots[next(s for s, e in zip(sources, ends) if point < e / ends[-1])].append(n)
    found = {}
    for s in sources:
        own = []
        for i, text, source in rows:
            if source == s and by_id[i]["size"]:
                # a null leaves the seed of a hash as it is
                h = xxhash.xxh64_intdigest((11).to_bytes(4, "little"), seed=42)
                h = long_hash(i, h) if i is not None else h
                h = long_hash(by_id[i]["size"], h)
                h = long_hash(xxhash.xxh64_intdigest(text.encode(), seed=42), h)
                own.append((h >> 50, signed(h), i, by_id[i]["size"]))
        at, total = 0, sum(x[-1] for x in own)
        limit = int(target[s] + 0.5)
        for *_, i, size in sorted(own):
            rounds = set()
            for k in range(repeats):
                low, high = at + k * total, min(at + k * total + size, limit)
                rounds |= set(range(low // block, -(-high // block))) if low < high else set()
            held = [slots[s][r] for r in rounds if r < len(slots[s])]
            found[i] = (min(held, default=None), len(held))
            at += size
    return found


@pytest.mark.parametrize("block", [16, 1024])
def test_slots_are_those_of_the_schedule(spark, monkeypatch, block):
    rows = [(i, t, s) for i, t, s in sample(5) if t is not None]
    got = mixing.mixed_documents(docs(spark, rows), block_words=block).collect()
    expected = brute_slots(rows, got, block)
    assert {r.doc_id: (r.first_slot, r.n_slots) for r in got if r["size"]} == expected
    assert all((r.first_slot, r.n_slots) == (None, 0) for r in got if not r["size"])
    monkeypatch.setattr(mixing, "GOLDEN", 987654321)  # another schedule is seen in the result
    other = mixing.mixed_documents(docs(spark, rows), block_words=block).collect()
    assert {r.doc_id: (r.first_slot, r.n_slots) for r in other if r["size"]} != expected


def test_equal_rows_are_dealt_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 3)
    rows = [(None, "a b c", "x")] * 10 + [(1, "d e", "x"), (1, "f g", "x"), (1, "d e", "x"), (2, None, "x"), (2, None, "x")]
    got = mixing.mixed_documents(docs(spark, rows), block_words=4).collect()
    assert len(got) == 15 and sum(r.taken for r in got) == 54 and all(r.taken <= 2 * r["size"] for r in got)
    again = mixing.mixed_documents(docs(spark, rows).repartition(6), block_words=4).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_repeated_ids_and_empty_tables(spark):
    df = docs(spark, [(1, "a b c", "x"), (1, "a b c", "x"), (None, "d e", "x"), (None, "d", None)])
    got = mixing.mixed_documents(df).collect()
    assert len(got) == 4 and all(r.taken <= 2 * r["size"] for r in got)
    assert mixing.mixed_documents(docs(spark, [])).count() == 0
    assert mixing.mixed_documents(docs(spark, [(1, None, None)])).first().taken == 0


def test_the_schedule_is_planned_apart_from_the_pieces(spark):
    found = mixing.mixed_documents(docs(spark, sample()))
    assert "Window [" not in found._jdf.queryExecution().optimizedPlan().toString()
