from __future__ import annotations

import collections
import random
import re

import duckdb
import numpy as np
import pytest

from tests.llm.shapes import DOCS, rows_of
from tillscope.llm import collocations

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, least=10, longest=3, top=2000, inside=50):
    counts, totals = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i : i + n])] += 1
    chosen = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    found = collections.defaultdict(list)
    for (lang, words), a in chosen.items():
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]  # noqa: E741
            cuts.append((10**6 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)  # noqa: E741
        within = any(
            other == lang and len(more) > len(words) and 100 * b >= inside * a
            and any(more[i : i + len(words)] == words for i in range(len(more)))
            for (other, more), b in chosen.items()
        )
        if not within:
            found[lang].append((-score, -a, " ".join(words).encode(), l, r))
    result = []
    for lang, own in found.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(own)[:top], 1):  # noqa: E741
            result.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(result, key=repr)


def sample():
    rng = random.Random(4)
    words = ["la", "mo", "É", "é", "ti", "x'y", "3", "no\u3000gap", "Mo"] + [f"w{i}" for i in range(30)]
    rows = []
    for i in range(260):
        text = " ".join(rng.choice(words[: rng.choice([3, 9, 39])]) + rng.choice(["", "", "", ",", ".", "\n", "\t", " \r "]) for _ in range(rng.choice([0, 1, 8, 60])))
        if i % 4 == 0:
            text += " Once upon a time; kith and kin. new york city"
        if i % 9 == 0:
            text += " new york"
        rows.append((i if i % 50 else None, text, rng.choice(["en", "en", "en", "de", None, "und", ""]), "s", 1, "x"))
    rows += [(500, None, "en", "s", 1, "x"), (501, " \t\n..", "zz", None, None, "x"), (502, "a a a a a a a a a a a a a a", "rep", "s", 1, "x")]
    return rows + rows[:3]


@pytest.mark.parametrize("hot_words", [1000, 20, 3])
def test_matches_brute_force(spark, monkeypatch, hot_words):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 700)
    rows = sample()
    df = spark.createDataFrame(rows, DOCS + ", phrase string")
    got = rows_of(collocations.collocations(df, hot_words=hot_words), *COLUMNS)
    assert got == brute(rows) and any(r[2] == "new york city" for r in got)


def test_other_parameters_match_brute_force(spark):
    rows = sample()
    df = spark.createDataFrame(rows, DOCS + ", phrase string")
    got = rows_of(collocations.collocations(df, least=4, longest=4, top=40, inside=80, hot_words=5), *COLUMNS)
    assert got == brute(rows, least=4, longest=4, top=40, inside=80)


def test_matches_the_sql(spark):
    con = duckdb.connect(config={"memory_limit": "4GB"})
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    names = [d[0] for d in con.execute(collocations.ORACLE).description]
    expected = sorted(
        (tuple(r[names.index(c)] for c in COLUMNS) for r in con.execute(collocations.ORACLE).fetchall()), key=repr
    )
    assert rows_of(collocations.query(spark, "/root/testdata/sf0.001"), *COLUMNS) == expected and expected


def test_suffixes_of_small_and_large_vocabularies():
    rng = np.random.default_rng(7)
    codes = rng.integers(0, 5, 400)
    wide = np.where(codes > 0, codes + (1 << 30), 0)  # too large to be put into one number
    keys, weights = collocations.suffixes(codes, 3)
    same, also = collocations.suffixes(wide, 3)
    assert (np.where(keys > 0, keys + (1 << 30), 0) == same).all() and (weights == also).all()
    assert weights.sum() == (codes > 0).sum() and collocations.suffixes(codes[:0], 3)[0].shape == (3, 0)


def test_quicksort_matches_counting():
    rng = np.random.default_rng(2)
    for n, least in ((0, 1), (1, 1), (1, 5), (300, 3), (4000, 25), (4000, 1)):
        keys = rng.integers(0, 12, (3, n)) * (rng.random((3, n)) < 0.9)
        keys[1:] *= keys[0] > 0
        keys[2] *= keys[1] > 0
        weights = rng.integers(1, 4, n)
        counts = collections.Counter()
        for i in range(n):
            for d in range(1, 4):
                if keys[d - 1, i]:
                    counts[tuple(keys[:d, i].tolist())] += int(weights[i])
        lengths, rows, sums = collocations.frequent_prefixes(keys, weights, least)
        got = {tuple(keys[:d, i].tolist()): int(w) for d, i, w in zip(lengths, rows, sums)}
        assert len(got) == len(lengths) and got == {k: c for k, c in counts.items() if c >= least}


def test_large_counts_stay_exact(spark):
    """Products past 64 bits: the score of counts in the billions, in whole numbers."""
    a, l, r = 3_000_000_019, 7_000_000_001, 9_000_000_011  # noqa: E741
    df = spark.sql(f"select {a}L a, {l}L l, {r}L r")
    score = df.selectExpr(
        "(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast(1000000 as decimal(7,0)))"
        " div (cast(l as decimal(15,0)) * cast(r as decimal(15,0))) as score"
    )
    assert score.first()["score"] == 10**6 * a * a // (l * r) and score.dtypes == [("score", "bigint")]


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "", None, None, None, "x")], DOCS + ", phrase string")
    assert collocations.collocations(df).count() == 0
    assert collocations.collocations(df.limit(0)).count() == 0
