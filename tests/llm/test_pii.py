from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.shapes import docs
from tillscope.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub(r"[^0-9]", "", text)


def luhn(number):
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (1 + k % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


def brute(text):
    found = [(m.start(), m.end(), 0) for m in EMAIL.finditer(text)]
    found += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), m.end(), 2) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


def test_base_finds_match_the_patterns():
    rng = random.Random(2)
    parts = ["a", "Z", "1", "25", "255", "256", ".", "@", "+", "-", " ", "(", ")", "%", "é", "\n", "4111111111111111", "x@y.z"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_stay_linear():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "+1 " + " " * 100_000, "1." * 100_000, "@" * 50_000):
        pii.base_spans(text)


def sample():
    rng = random.Random(8)
    rows = []
    for i in range(150):
        words = ["lorem", "ipsum", "dolor", "sit", "amet"] * 6
        words.insert(rng.randrange(30), f"u{i}.x@mail{i % 9}.example.com")
        words.insert(rng.randrange(30), f"+1 ({200 + i}) 555-{1000 + i}")
        words.insert(rng.randrange(30), ".".join(str(rng.randrange(256)) for _ in range(4)))
        stem = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
        words.insert(rng.randrange(30), next(stem + str(c) for c in range(10) if luhn(stem + str(c))))
        rows.append((i, " ".join(words), "s"))
    return rows


@pytest.fixture(scope="module")
def field():
    return pii.fit([t for _, t, _ in sample()])


def test_field_finds_other_forms_and_leaves_numbers_alone(field):
    found = lambda t: [(pii.KINDS[k], t[a:b]) for a, b, k, _ in pii.find(t.encode(), field)]
    assert ("phone", "(702) 555-0924") in found("call (702) 555-0924 now")
    assert ("card", "4661.8666.7476.1685") in found("card 4661.8666.7476.1685 it is")
    assert ("email", "bob.7 [at] mail4 [dot] example [dot] com") in found("write bob.7 [at] mail4 [dot] example [dot] com today")
    for text in ("on 2024-01-15 at 10:30 we met", "page 12 of 300", "in 1999 and 2005", "at noon", ""):
        assert found(text) == []


def test_segments_do_not_overlap_and_are_the_best(field):
    """The dynamic program against every choice of spans on a short text."""
    text = "tel 702-555-0924 or 63 . 39 . 35 . 251 and 4661 8666"
    for tokens in pii.regions(text):
        arcs = [
            (i, j, field._score(k, f) - pii.MARGIN)
            for j, ends in enumerate(field._candidates(text, tokens)) for i, f in ends for k in range(4)
        ]
        best = [0.0] * (len(tokens) + 1)
        for j in range(1, len(tokens) + 1):
            best[j] = max([best[j - 1]] + [best[i] + s for i, e, s in arcs if e == j])

        def brute_best(at):
            if at == len(tokens):
                return 0.0
            return max([brute_best(at + 1)] + [s + brute_best(e) for i, e, s in arcs if i == at])

        assert brute_best(0) == pytest.approx(best[-1])
    spans = field.decode(text, [])
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_blocked_spans_match_looking_at_each(field):
    """Candidates that overlap any blocked span go, whatever the spans' order and overlaps."""
    rng = random.Random(8)
    for _ in range(40):
        text = " ".join(rng.choice(["call 702 555 0924", "la", "12 34", "1 702 555 0924", "x at y dot com"]) for _ in range(12))
        blocked = []
        for _ in range(rng.randrange(6)):
            a = rng.randrange(len(text))
            blocked.append((a, min(len(text), a + rng.randrange(1, 20)), rng.randrange(4)))
        found = field.decode(text, blocked)
        assert not any(s < b and a < e for a, b, _ in found for s, e, _ in blocked)
        free = [span for span in field.decode(text, []) if not any(s < span[1] and span[0] < e for s, e, _ in blocked)]
        assert len(found) >= len(free) - len(blocked)


def test_many_addresses_stay_linear(field):
    import time

    def seconds(n):
        text = " ".join(f"user{i}@host{i}.example.com at 10.0.{i % 250}.7" for i in range(n))
        blocked = brute(text)
        start = time.perf_counter()
        field.decode(text, blocked)
        return time.perf_counter() - start

    seconds(200)
    assert seconds(4000) < 10 * max(seconds(1000), 0.05)


def test_query_columns(spark, field):
    rows = sample()[:20] + [(500, None, "s"), (501, "", "s"), (None, "a@b.c é x@y.zz", None), (502, "é@b.c a1@b.c", "s")]
    df = docs(spark, rows, extra="found")
    got = pii.personal_data(df, field).select(
        "doc_id", "found", F.sha2(pii._listed(F.filter("found", lambda s: s["base"])).cast("binary"), 256).alias("sha"),
        pii._listed(F.col("found")).alias("spans"),
    ).collect()
    text = {i: t for i, t, _ in rows}
    assert len(got) == len(rows)
    for r in got:
        base = brute(text[r.doc_id] or "")
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base)
        assert r.sha == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) <= set(r.spans.split(",")) | {""}


def test_query_counts_each_kind(spark, tmp_path):
    texts = ["a@b.c d@e.f", "10.0.0.7 in a@b.c", "4111111111111111 4111 1111 1111 1111 or 1.2.3.4", "+1 (702) 555-0924", "", None]
    docs(spark, [(i, t, "s") for i, t in enumerate(texts)]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in pii.query(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        kinds = [k for _, _, k in brute(text or "")]
        assert [got[i][f"n_{name}"] for name in pii.KINDS] == [kinds.count(k) for k in range(4)], text


def test_redaction(spark, field):
    df = docs(spark, [(1, "é a1@b.co, +1 (702) 555-0924!", "s"), (2, None, "s"), (3, "plain", "s")], extra="redacted_text")
    clean = pii.without_personal_data(df, field)
    assert clean.columns == df.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert got == {1: ("é [EMAIL], [PHONE]!", 19), 2: (None, None), 3: ("plain", 5)}
    assert pii.without_personal_data(df.limit(0)).count() == 0
    assert pii.personal_data(df.limit(0)).count() == 0
