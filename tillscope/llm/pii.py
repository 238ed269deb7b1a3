"""Personal data: fixed patterns, and a semi-Markov conditional random field beside them.

The field scores whole candidate spans: runs of a few tokens near a digit, an at
sign or a spelled-out one. A dynamic program over the tokens chooses boundaries
and kinds together, with spans of bounded length, so that it finds what the
patterns miss: numbers without a plus, addresses that are spelled out, parts set
apart. It learns from the patterns' own finds in a bounded sample of the corpus,
and from rewritten forms of them.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import free_name, table

#: Fixed order of the kinds.
KINDS = ("email", "ip", "card", "phone")
#: Documents that the field is fitted on, and characters in each at most.
SAMPLE_DOCS, SAMPLE_CHARS = 600, 20_000
#: Tokens and characters of a span at most.
MAX_TOKENS, MAX_CHARS = 7, 64
EPOCHS, RATE, DECAY = 10, 0.5, 1e-4
#: What a span must be ahead by, in log odds, against leaving its tokens outside.
MARGIN = 0.5

# --- fixed patterns -----------------------------------------------------------------
# As stated by the contract of the base finds. An address is looked for at its at sign
# and a run of digits from its first digit only: other starts find nothing else, and
# long runs stay linear.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGITS = bytes(c for c in range(256) if not 48 <= c <= 57)
#: Spelled-out signs that are worth a look besides digits and at signs.
SPELLED_AT, SPELLED_DOT = ("at", "[at]", "(at)", "{at}"), ("dot", "[dot]", "(dot)", "{dot}")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (found := _DOMAIN.match(text, at)):
            yield start, (end := found.end())
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the fixed patterns, by start, then kind."""
    found = [(s, e, 0) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(int(part.lstrip("0")[:4] or 0) <= 255 for part in m[0].split(".")):
            found.append((*m.span(), 1))
    for m in _CARD.finditer(text):
        if 14 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            found.append((*m.span(), 2))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            found.append((*m.span(), 3))
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


# --- candidate spans and their features ------------------------------------------------

_TOKEN = re.compile(r"\S+")
_STRIP = "\"'<>,;:!?|*_`"
#: Words before a span that tell its kind.
_CUES = ("mail", "e-mail", "email", "ip", "address", "host", "card", "visa", "phone", "tel", "call", "fax", "mobile")
_GROUP = re.compile(r"[0-9]+")


def _tokens(text: str, low: int, high: int) -> list[tuple[int, int, str]]:
    found = []
    for m in _TOKEN.finditer(text, low, high):
        start, end = m.span()
        while start < end and text[start] in _STRIP:
            start += 1
        while end > start and text[end - 1] in _STRIP + ".":
            end -= 1
        if start < end:
            found.append((start, end, text[start:end]))
    return found


def _starts(token: str) -> bool:
    return "@" in token or any("0" <= c <= "9" for c in token)


def _spelled(token: str) -> bool:
    return token.lower() in SPELLED_AT or token.lower() in SPELLED_DOT


def _plausible(tokens: list[tuple[int, int, str]], i: int, j: int) -> bool:
    """Whether tokens i to j (exclusive) may be one span of personal data."""
    first, last, inside = tokens[i][2], tokens[j - 1][2], [t[2] for t in tokens[i:j]]
    if tokens[j - 1][1] - tokens[i][0] > MAX_CHARS:
        return False
    if any(_spelled(t) for t in inside[1:-1]) or any("@" in t for t in inside):
        return not _spelled(first) and not _spelled(last)
    return _starts(first) and _starts(last) and sum(map(len, map(_digits, inside))) >= 4 and all(
        not any(c.isalpha() for c in t) for t in inside
    )


def regions(text: str) -> Iterator[list[tuple[int, int, str]]]:
    """Tokens of the stretches around digits, at signs and spelled-out dots."""
    low, high = None, 0
    # an at sign or a digit, or a spelled-out dot; the word "at" alone is too common to look at
    for m in re.finditer(r"[0-9@]+|(?<![A-Za-z])[(\[{]?(?:dot|DOT|Dot)[)\]}]?(?![A-Za-z])", text):
        if low is not None and m.start() > high:
            yield _tokens(text, low, high)
            low = None
        if low is None:
            low = max(m.start() - 48, high)
            while low > high and not text[low - 1].isspace():
                low -= 1
        high = min(len(text), m.end() + 48)
        while high < len(text) and not text[high].isspace():
            high += 1
    if low is not None:
        yield _tokens(text, low, high)


def _size(n: int) -> str:
    return str(n) if n < 4 else f"{n // 2 * 2}+"


def span_features(text: str, tokens: list[tuple[int, int, str]], i: int, j: int) -> list[str]:
    """Features of the whole span of tokens i to j (exclusive)."""
    start, end = tokens[i][0], tokens[j - 1][1]
    span = text[start:end]
    lower = span.lower()
    digits = _digits(span)
    groups = _GROUP.findall(span)
    signs = "".join(sorted({c for c in span if not c.isalnum()}))
    found = [
        "bias", f"tokens:{min(j - i, 5)}", f"digits:{len(digits)}", f"signs:{signs[:8]}",
        f"groups:{'-'.join(str(min(len(g), 9)) for g in groups[:6])}",
        f"letters:{_size(sum(c.isalpha() for c in span))}", f"first:{span[0] if not span[0].isalnum() else 'x'}",
        f"last:{span[-1] if not span[-1].isalnum() else 'x'}",
    ]
    if 14 <= len(digits) <= 19 and not any(c.isalpha() for c in span):
        found.append(f"luhn:{luhn(digits)}")
    if len(groups) == 4:
        found.append(f"octets:{all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
    ats = span.count("@") + sum(t[2].lower() in SPELLED_AT for t in tokens[i:j])
    dots = sum(t[2].lower() in SPELLED_DOT for t in tokens[i:j])
    found.append(f"ats:{min(ats, 2)}:{min(dots, 2)}")
    if ats == 1:
        host = re.split(r"@|\bat\b", lower)[-1]
        found.append(f"host:{bool(re.search(r'(?:[.]|dot)[)} \]]*[a-z]{2,}$', host))}")
    before = tokens[i - 1][2].lower().rstrip(":.") if i else ""
    if before in _CUES:
        found.append(f"cue:{before}")
    return found


class Field:
    """Weights of (kind, feature); candidates, decoding and fitting."""

    def __init__(self, weights: dict[tuple[int, str], float] | None = None):
        self.weights = dict(weights or {})

    def _candidates(self, text: str, tokens):
        """ends[j]: (i, features) of the candidate spans that end before token j."""
        ends = [[] for _ in range(len(tokens) + 1)]
        for i in range(len(tokens)):
            for j in range(i + 1, min(i + MAX_TOKENS, len(tokens)) + 1):
                if _plausible(tokens, i, j):
                    ends[j].append((i, span_features(text, tokens, i, j)))
        return ends

    def _score(self, kind: int, features: list[str]) -> float:
        get = self.weights.get
        return sum(get((kind, f), 0.0) for f in features)

    def decode(self, text: str, blocked: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """The best set of spans that overlap neither each other nor the ``blocked`` ones."""
        found = []
        # of the blocked spans that start before a place, the one that reaches furthest tells whether any overlaps
        order = sorted(blocked)
        starts, reach = [s for s, _, _ in order], list(accumulate((e for _, e, _ in order), max))
        for tokens in regions(text):
            ends = self._candidates(text, tokens)
            best, back = [0.0] * (len(tokens) + 1), [None] * (len(tokens) + 1)
            for j in range(1, len(tokens) + 1):
                best[j] = best[j - 1]
                for i, features in ends[j]:
                    before = bisect_left(starts, tokens[j - 1][1])
                    if before and reach[before - 1] > tokens[i][0]:
                        continue
                    for kind in range(len(KINDS)):
                        value = best[i] + self._score(kind, features) - MARGIN
                        if value > best[j]:
                            best[j], back[j] = value, (i, kind)
            j = len(tokens)
            while j > 0:
                if back[j]:
                    i, kind = back[j]
                    found.append((tokens[i][0], tokens[j - 1][1], kind))
                    j = i
                else:
                    j -= 1
        return found

    def learn(self, examples: list[tuple[str, list[tuple[int, int, int]]]]) -> None:
        """Stochastic steps up the conditional log-likelihood of the marked spans."""
        lattices = []
        for text, gold in examples:
            for tokens in regions(text):
                ends = self._candidates(text, tokens)
                if any(ends):
                    marked = {(s, e): k for s, e, k in gold}
                    true = [
                        (marked[tokens[i][0], tokens[j - 1][1]], features)
                        for j in range(len(ends)) for i, features in ends[j]
                        if (tokens[i][0], tokens[j - 1][1]) in marked
                    ]
                    lattices.append((ends, true))
        rng = random.Random(5)
        for epoch in range(EPOCHS):
            rng.shuffle(lattices)
            rate = RATE / (1 + epoch)
            for ends, true in lattices:
                self._step(ends, true, rate)

    def _step(self, ends, true, rate: float) -> None:
        n = len(ends) - 1
        arcs = [[(i, k, features, self._score(k, features)) for i, features in ends[j] for k in range(len(KINDS))] for j in range(n + 1)]
        forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            forward[j] = _log_sum([forward[j - 1]] + [forward[i] + s for i, _, _, s in arcs[j]])
        outgoing = [[] for _ in range(n + 1)]
        for j in range(n + 1):
            for i, k, _, s in arcs[j]:
                outgoing[i].append((j, s))
        for i in range(n - 1, -1, -1):
            backward[i] = _log_sum([backward[i + 1]] + [s + backward[j] for j, s in outgoing[i]])
        change: dict[tuple[int, str], float] = defaultdict(float)
        for j in range(n + 1):
            for i, k, features, s in arcs[j]:
                p = math.exp(forward[i] + s + backward[j] - forward[n])
                if p > 1e-4:
                    for f in features:
                        change[k, f] -= p
        for k, features in true:
            for f in features:
                change[k, f] += 1
        for key, value in change.items():
            old = self.weights.get(key, 0.0)
            self.weights[key] = old * (1 - DECAY) + rate * value / 4


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


# --- fitting --------------------------------------------------------------------------

def _rewritten(span: str, kind: int, rng: random.Random) -> tuple[str, bool]:
    """Another form of a find, and whether it still is personal data of its kind."""
    digits = _digits(span)
    if kind == 0:
        local, _, host = span.partition("@")
        at, dot = rng.choice([(" [at] ", " [dot] "), (" (at) ", " (dot) "), (" at ", " dot "), (" @ ", "."), ("@ ", ".")])
        return local + at + host.replace(".", dot), True
    if kind == 1:
        if rng.random() < 0.25:
            return ".".join(str(rng.randrange(300, 999)) for _ in range(4)), False
        return rng.choice([" . ", "[.]", "(.)"]).join(span.split(".")), True
    if kind == 2:
        if rng.random() < 0.4:
            wrong = digits[:-1] + str((int(digits[-1]) + rng.randrange(1, 10)) % 10)
            return rng.choice([wrong, " ".join(wrong[i : i + 4] for i in range(0, len(wrong), 4))]), False
        sep = rng.choice([".", "/", "  ", " - "])
        return sep.join(digits[i : i + 4] for i in range(0, len(digits), 4)), True
    last = digits[-10:]
    form = rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}", "00{} {} {}"])
    return form.format(last[:3], last[3:6], last[6:]), True


_HARMLESS = ("{y}-{m:02d}-{d:02d}", "{d}.{m}.{y}", "{m}:{d:02d}:{d:02d}", "{y}", "{a},{b:03d}", "{d}.{m}.{a}", "page {a} of {y}", "{a} {b} {d}", "{y}-{y}", "{a}.{b}", "{b}{y}{a}", "{y} {y}", "at {a} dot {b}")


def _example(text: str, spans: list[tuple[int, int, int]], rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with some finds rewritten and harmless numbers strewn in, and what is marked."""
    out, marked, at, length = [], [], 0, 0

    def put(piece: str) -> None:
        nonlocal length
        out.append(piece)
        length += len(piece)

    for start, end, kind in spans:
        if start < at:
            continue
        put(text[at:start])
        put("")
        piece, is_data = (_rewritten(text[start:end], kind, rng) if rng.random() < 0.5 else (text[start:end], True))
        if is_data:
            marked.append((length, length + len(piece), kind))
        put(piece)
        if rng.random() < 0.7:
            y, m, d, a, b = rng.randrange(1900, 2100), rng.randrange(1, 13), rng.randrange(1, 29), rng.randrange(1, 99), rng.randrange(1, 999)
            put(" and " + rng.choice(_HARMLESS).format(y=y, m=m, d=d, a=a, b=b) + " ")
        at = end
    put(text[at:])
    return "".join(out), marked


def fit(texts: list[str]) -> Field:
    rng = random.Random(3)
    field = Field()
    field.learn([_example(t, base_spans(t), rng) for t in texts])
    return field


def fitted(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field:
    """Fits on at most ``sample_docs`` texts with a digit or an at sign, the first by hash.

    The hashes are ranked without their texts, so the driver gets eight bytes for each
    of them from every task, and then the texts of the chosen hashes only, copies once.
    """
    text, hashed = F.col("text"), F.xxhash64("text")
    usable = docs.select("text").filter(text.rlike("[0-9@]") & (F.length(text) <= SAMPLE_CHARS))
    first = usable.select(hashed.alias("hash")).orderBy("hash").limit(sample_docs)
    last = first.agg(F.max("hash")).first()[0]
    if last is None:
        return fit([])
    chosen = usable.filter(hashed <= last).distinct().orderBy(hashed, "text").limit(sample_docs).collect()
    return fit([r.text for r in chosen])


# --- texts ------------------------------------------------------------------------------

def _worth_a_look(raw: bytes) -> bool:
    return b"@" in raw or bool(raw.translate(None, _NOT_DIGITS)) or b"dot" in raw or b"DOT" in raw or b"Dot" in raw


def find(text: bytes | None, field: Field) -> list[tuple[int, int, int, bool]]:
    """(start, end, kind number, whether a fixed pattern found it), by start, then kind."""
    if not text or not _worth_a_look(text):
        return []
    whole = text.decode("utf-8", "replace")
    base = base_spans(whole)
    more = field.decode(whole, base)
    spans = [(*s, True) for s in base] + [(*s, False) for s in more]
    return sorted(spans, key=lambda s: (s[0], s[2], s[1]))


def redacted(text: bytes | None, field: Field) -> str | None:
    """The text with each find, or run of overlapping finds, replaced by its first kind in brackets."""
    if text is None:
        return None
    whole, out, at, reached = text.decode("utf-8", "replace"), [], 0, 0
    for start, end, kind, _ in find(text, field):
        if start >= reached:
            out += [whole[at:start], f"[{KINDS[kind].upper()}]"]
        at = reached = max(reached, end)
    return "".join([*out, whole[at:]])


SPANS = "array<struct<start:int,end:int,kind:int,base:boolean>>"


def personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, found: the spans of every whole text (code points, end exclusive), as an array.

    Every find of the fixed patterns is there, marked ``base``; other spans overlap
    none of them. Null and empty texts have none. Null and repeated doc_ids are
    passed on row by row, other columns aren't looked at, an empty table gives an
    empty result.
    """
    known = docs.sparkSession.sparkContext.broadcast(field or fitted(docs))  # weights of one small field

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([
            [dict(zip(("start", "end", "kind", "base"), s)) for s in find(t, known.value)] for t in texts
        ])

    return docs.select("doc_id", spans(F.col("text").cast("binary")).alias("found"))


def without_personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``docs`` with every find in ``text`` replaced by its kind, and ``n_chars`` (if there) as it then is."""
    known = docs.sparkSession.sparkContext.broadcast(field or fitted(docs))

    @F.pandas_udf("string")
    def redact(texts: pd.Series) -> pd.Series:
        return pd.Series([redacted(t, known.value) for t in texts], dtype=object)

    name = free_name(docs, "redacted_text")
    clean = docs.withColumn(name, redact(F.col("text").cast("binary")))
    columns = [F.col(name).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    if "n_chars" in docs.columns:
        size = F.coalesce(F.length(name).cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
        columns[docs.columns.index("n_chars")] = size.alias("n_chars")
    return clean.select(*columns)


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def _count(spans: Column, kind: int) -> Column:
    # the condition takes the span alone: a second argument would be given its place
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def query(spark, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["base"])
    counts = [_count(base, k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    digest = F.sha2(_listed(base).cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), _listed(F.col("found")).alias("spans"))
