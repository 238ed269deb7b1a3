from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from tillscope.llm import simhash
from tillscope.llm.components import connected_components


def brute_print(text, size=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(links, nodes):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


TEXTS = [
    "One two three four five six seven", "one  two three\tfour FIVE six seven", "", None, " \n ",
    "short", "SHORT", "two words", "Ärger über Öl", "ärger über öl", "a b c " * 400,
    "x y z w v", "one two three four five six seven",
]


def test_fingerprints_are_exact(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r.fp for r in simhash.near_duplicates(df).collect()}
    assert {i: v % (1 << 64) for i, v in got.items()} == {i: brute_print(t) for i, t in enumerate(TEXTS)}


def test_groups_of_documents(spark):
    rows = [(5, "a b c d"), (3, "A B c d"), (9, None), (7, ""), (None, "a b c d"), (None, "alone here"), (3, "a b c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (3, 3), (9, 7), (7, 7), (None, 3), (None, None)], key=str)


def test_filter_keeps_one_of_each_group_and_all_columns(spark):
    rows = [(5, "a b c d", 1, "x"), (3, "A B c d", 2, "y"), (3, "a b c d", 3, "z"), (8, "other", 4, "w"), (None, "a b c d", 5, "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int, kept_id string")
    kept = simhash.without_near_duplicates(df)
    assert kept.columns == df.columns
    got = sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect())
    assert got == [-1, 3, 8]


def test_repeated_ids_are_told_apart_by_their_fingerprints(spark):
    """One id in several groups: each group keeps one row, and near copies go whatever their id."""
    rows = [
        (1, "a b c d", "keep"), (1, "A b c d", "copy"), (1, "e f g h", "keep"), (2, "a b c d", "copy"),
        (3, "e f g h", "copy"), (4, "i j k l", "keep"), (5, "i j k l", "copy"), (5, "m n o p", "keep"), (4, "a b c d", "copy"),
        (6, "q r s t", "keep"), (6, "q r s t", "copy"), (0, "u v w x", "keep"), (6, "u v w x", "copy"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept_print string")
    kept = sorted(tuple(r) for r in simhash.without_near_duplicates(df).collect())
    assert sorted((i, t.lower()) for i, t, _ in kept) == sorted((i, t.lower()) for i, t, mark in rows if mark == "keep")
    assert kept == sorted(tuple(r) for r in simhash.without_near_duplicates(df.repartition(7)).collect())


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0
    assert simhash.without_near_duplicates(df).count() == 0


@pytest.mark.parametrize("small, block", [(32, 2048), (2, 7), (1, 3)])
def test_all_links_are_found(spark, small, block):
    rng = random.Random(4)
    values = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(12):
            base ^= sum(1 << rng.randrange(64) for _ in range(rng.choice([1, 1, 2, 3])))
            base %= 1 << 64
            values.add(base)
    hot = rng.getrandbits(64)
    values |= {hot ^ (1 << i) ^ (1 << j) for i in range(0, 12) for j in range(12, 20)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), small=small, block=block)
    found = {(a, b) for a, b in links.collect()}
    brute = {
        (a, b) for i, a in enumerate(signed) for b in signed[i + 1 :]
        if ((a ^ b) % (1 << 64)).bit_count() <= 2
    }
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 2 for a, b in found)
    assert brute_components(found, signed) == brute_components(brute, signed)


def test_components_of_a_chain_a_star_and_repeats(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (3, 2), (201, 200), (200, 201)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in connected_components(df, "a", "b").collect()}
    nodes = {n for l in links for n in l}
    assert got == {n: c for n, c in brute_components(links, nodes).items()}


def test_majority_counts_do_not_overflow():
    hashes = np.full(70_000, 0xFFFF0000FFFF0001, dtype=np.uint64)
    assert simhash._majority_bits(hashes) == 0xFFFF0000FFFF0001
