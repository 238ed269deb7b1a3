"""Phrase collocations by a multikey three-way quicksort of suffix pointers.

Texts are read once into blocks of one language: the words of the block, and a code
for each occurrence. A suffix starts at every word and ends with its piece. Equal
suffixes of a block, cut at the longest phrase, become one pointer with a weight, and
pointers are dealt over the cluster by their leading two words, so that all that begin
alike meet in one task. There they are sorted from the first word to the last: each
round parts every segment into what is less than, equal to and greater than its pivot.
The weight of an equal part is the count of a phrase and goes on to the next word;
parts lighter than the least count are abandoned, as nothing in them can be frequent.

Pairs of two very frequent words (at most ``HOT_WORDS`` squared) could fill a task. Their pointers are dealt
by all words instead, and the pair itself is counted by pointers that end behind it.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillscope.llm.common import table, written

LEAST = 10
LONGEST = 3
TOP = 2000
#: Percent of a phrase's occurrences that lie in a longer candidate, from which it is dropped.
INSIDE = 50
SCALE = 1_000_000
#: Bytes of text at which a block is closed; one document is never parted.
BLOCK_BYTES = 4_000_000
#: Pointers that meet in one task on average, at most, and the least number of ranges.
RANGE_POINTERS, RANGES = 2_000_000, 64
#: A word is hot with more than one in so many of all occurrences; there are fewer of these.
HOT_WORDS = 1000
#: Parts in which a language's collocations are ordered before they meet.
SHARES = 8

#: What ends a piece: . , ; : ! ? and line feed, vertical tab, form feed, carriage return.
_PIECES = bytes.maketrans(b".,;:!?\n\v\f\r", b"\n" * 10)

BLOCKS = "lang string, n long, words array<string>, counts array<long>, codes binary"
SENT = "lang string, range int, packed binary"
COUNTED = "lang string, phrase string, size int, a long"


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of one length as their bytes, plane by plane, compressed."""
    planes = [np.ascontiguousarray(c.astype(np.int64)).view(np.uint8).reshape(-1, 8).T for c in columns]
    raw = np.concatenate(planes).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(packed: bytes, columns: int) -> list[np.ndarray]:
    raw = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(c.T).view(np.int64).reshape(-1) for c in planes]


# --- texts ----------------------------------------------------------------------------

def pieces(text: bytes) -> list[list[bytes]]:
    """Words in lower-case ASCII by piece; neither pieces nor words are empty."""
    parts = (p.split() for p in text.lower().translate(_PIECES).split(b"\n"))  # space and tab are left
    return [p for p in parts if p]


class _Block:
    def __init__(self):
        self.vocabulary, self.codes, self.size = {}, [], 0

    def add(self, text: bytes) -> None:
        known, codes = self.vocabulary, []
        for words in pieces(text):
            codes += [known.setdefault(w, len(known) + 1) for w in words]
            codes.append(0)  # the end of the piece
        self.codes.append(np.array(codes, dtype=np.int32))
        self.size += len(text)

    def row(self, lang: str) -> pa.RecordBatch:
        codes = np.concatenate(self.codes)
        counts = np.bincount(codes, minlength=len(self.vocabulary) + 1)[1:]
        # frequent words get small codes, which compress better
        order = np.argsort(-counts, kind="stable")
        place = np.zeros(len(counts) + 1, dtype=np.int64)
        place[order + 1] = np.arange(1, len(counts) + 1)
        words = list(self.vocabulary)
        flat = pa.array([words[i] for i in order], pa.binary()).cast(pa.string())
        ends = pa.array([0, len(words)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang]), pa.array([int(counts.sum())], pa.int64()), pa.ListArray.from_arrays(ends, flat),
                pa.ListArray.from_arrays(ends, pa.array(counts[order], pa.int64())),
                pa.array([_packed(place[codes])], pa.binary()),
            ],
            names=[c.split()[0] for c in BLOCKS.split(", ")],
        )


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_ = defaultdict(_Block)
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            block = open_[lang]
            block.add(text)
            if block.size >= BLOCK_BYTES:
                yield open_.pop(lang).row(lang)
    for lang, block in open_.items():
        yield block.row(lang)


def encoded(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text).mapInArrow(_encode, BLOCKS)


# --- pointers -------------------------------------------------------------------------

def _hash(words: list[str]) -> np.ndarray:
    own = b"".join(hashlib.blake2b(w.encode(), digest_size=8).digest() for w in words)
    return np.frombuffer(own, np.uint64)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def suffixes(codes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys by depth, weights) of the distinct suffixes, cut at ``longest`` words and at piece ends."""
    padded = np.concatenate((codes, np.zeros(longest, dtype=codes.dtype)))
    starts = np.flatnonzero(codes)
    keys = np.empty((longest, len(starts)), dtype=np.int64)
    alive = np.ones(len(starts), dtype=bool)
    for k in range(longest):
        keys[k] = np.where(alive, padded[starts + k], 0)
        alive &= keys[k] > 0
    bits = int(codes.max(initial=0)).bit_length()
    if bits * longest < 64:  # all words of a suffix in one number, which sorts faster
        joined = keys[0]
        for k in range(1, longest):
            joined = (joined << bits) | keys[k]
        joined, weights = np.unique(joined, return_counts=True)
        parts = [(joined >> (bits * (longest - 1 - k))) & ((1 << bits) - 1) for k in range(longest)]
        return np.stack(parts), weights
    order = np.lexsort(keys[::-1])
    keys = keys[:, order]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    at = np.flatnonzero(new)
    return keys[:, at], np.diff(at, append=len(starts))


def _dealt(batches: Iterator[pa.RecordBatch], ranges: int, hot: set[tuple[str, str]], longest: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            lang = batch.column("lang")[row].as_py()
            words = batch.column("words")[row].as_py()
            if not words:
                continue
            keys, weights = suffixes(_unpacked(batch.column("codes")[row].as_py(), 1)[0], longest)
            # a suffix of one word is in no phrase
            keep = keys[1] > 0
            keys, weights = keys[:, keep], weights[keep]
            is_hot = np.array([False] + [(lang, w) in hot for w in words])
            hashes = np.concatenate((np.zeros(1, np.uint64), _hash(words)))
            pair = _mixed(hashes[keys[0]], hashes[keys[1]])
            split = is_hot[keys[0]] & is_hot[keys[1]]
            # a hot pair: one pointer that ends behind it, and the others by all their words
            ends = np.zeros_like(keys[:, split])
            ends[:2] = keys[:2, split]
            if ends.shape[1]:
                first = np.flatnonzero(np.r_[True, (ends[:2, 1:] != ends[:2, :-1]).any(axis=0)])
                ends, sums = ends[:, first], np.add.reduceat(weights[split], first)
                end_pair = pair[split][first]
            else:
                sums, end_pair = np.empty(0, np.int64), np.empty(0, np.uint64)
            deep = split & (keys[2] > 0) if longest > 2 else np.zeros_like(split)
            apart = pair[deep]
            for k in range(2, longest):
                apart = _mixed(apart, hashes[keys[k, deep]])
            every = np.concatenate((keys[:, ~split], ends, keys[:, deep]), axis=1)
            amounts = np.concatenate((weights[~split], sums, weights[deep]))
            whole = np.concatenate((np.ones(int((~split).sum()) + len(sums), bool), np.zeros(int(deep.sum()), bool)))
            place = (np.concatenate((pair[~split], end_pair, apart)) % np.uint64(ranges)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            cuts = np.flatnonzero(np.diff(place[order], prepend=-1, append=-1))
            for a, b in zip(cuts, cuts[1:]):
                own = order[a:b]
                used, local = np.unique(every[:, own], return_inverse=True)
                local = local.reshape(longest, -1)
                if used[0] != 0:
                    used, local = np.concatenate(([0], used)), local + 1
                named = "\t".join(words[i - 1] for i in used[1:]).encode()  # no word holds a tab
                body = _packed(*local, amounts[own], whole[own])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang]), pa.array([int(place[own[0]])], pa.int32()),
                        pa.array([len(named).to_bytes(8, "little") + len(body).to_bytes(8, "little") + body + _text(named)], pa.binary()),
                    ],
                    names=["lang", "range", "packed"],
                )


def _text(named: bytes) -> bytes:
    return pa.compress(named, codec="zstd", asbytes=True)


def _opened(packed: bytes, longest: int) -> tuple[list[str], list[np.ndarray]]:
    size, body = int.from_bytes(packed[:8], "little"), int.from_bytes(packed[8:16], "little")
    columns = _unpacked(packed[16 : 16 + body], longest + 2)
    named = pa.decompress(packed[16 + body :], size, codec="zstd", asbytes=True) if size else b""
    return named.decode().split("\t"), columns


def frequent_prefixes(keys: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length, row, weight) of every prefix of weight ``least`` or more; ``row`` has the prefix.

    ``keys`` are by depth, 0 behind the end. All segments go through a round of the
    quicksort side by side; a segment's depth is the number of words it has in common.
    """
    depth, n = keys.shape
    p = np.arange(n)
    starts, level = np.zeros(min(n, 1), dtype=np.int64), np.zeros(min(n, 1), dtype=np.int64)
    lengths, rows, sums = [], [], []
    while len(starts):
        sizes = np.diff(starts, append=len(p))
        segment = np.repeat(np.arange(len(starts)), sizes)
        pivot = p[starts + sizes // 2]
        least_key = keys[level, pivot]
        own, other = keys[level[segment], p], least_key[segment]
        group = segment * 3 + (own >= other) + (own > other)
        total = np.bincount(group, weights[p], minlength=3 * len(starts)).reshape(-1, 3)
        word = least_key > 0
        found = word & (total[:, 1] >= least)
        lengths.append(level[found] + 1)
        rows.append(pivot[found])
        sums.append(total[found, 1].astype(np.int64))
        keep = total >= least
        keep[:, 1] &= word & (level + 1 < depth)
        keep = keep.reshape(-1)
        alive = keep[group]
        p, group = p[alive], group[alive]
        counts = np.bincount(group, minlength=len(keep))
        offsets = np.cumsum(counts) - counts
        # places by counting: every element goes behind those of its part that stand before it
        part, ahead = group % 3, np.empty(len(p), dtype=np.int64)
        for c in range(3):
            mine = np.flatnonzero(part == c)
            ahead[mine] = np.arange(len(mine))
        earlier = np.zeros(len(counts), dtype=np.int64)  # of the same kind, in segments before
        for c in range(3):
            earlier[c::3] = np.cumsum(counts[c::3]) - counts[c::3]
        moved = np.empty_like(p)
        moved[offsets[group] + ahead - earlier[group]] = p
        p = moved
        there = np.flatnonzero(counts)
        starts = offsets[there]
        level = level[there // 3] + (there % 3 == 1)
    if not lengths:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(lengths), np.concatenate(rows), np.concatenate(sums)


def _counted(rows: pa.Table, least: int, longest: int) -> pa.Table:
    opened = [_opened(b, longest) for b in rows.column("packed").to_pylist()]
    names = pa.chunked_array([pa.array(words, pa.string()) for words, _ in opened])
    whole = names.combine_chunks().dictionary_encode()
    named, numbers = whole.dictionary.to_pylist(), whole.indices.to_numpy() + 1
    keys, at = [], 0
    for words, columns in opened:
        local = np.concatenate(([0], numbers[at : at + len(words)]))
        at += len(words)
        keys.append(local[np.stack(columns[:longest])])
    keys = np.concatenate(keys, axis=1)
    weights, plain = (np.concatenate([c[longest + k] for _, c in opened]) for k in (0, 1))
    phrases, sizes, sums = [], [], []
    for own, shortest in ((plain == 1, 2), (plain == 0, 3)):
        part = keys[:, own]
        lengths, at_rows, totals = frequent_prefixes(part, weights[own], least)
        for n in range(shortest, longest + 1):
            mine = lengths == n
            phrases += [" ".join([named[k - 1] for k in column]) for column in part[:n, at_rows[mine]].T]
            sizes += [n] * int(mine.sum())
            sums.append(totals[mine])
    lang = rows.column("lang")[0].as_py()
    return pa.table(
        [
            pa.array([lang] * len(phrases), pa.string()), pa.array(phrases, pa.string()), pa.array(sizes, pa.int32()),
            pa.array(np.concatenate(sums) if sums else [], pa.int64()),
        ],
        names=[c.split()[0] for c in COUNTED.split(", ")],
    )


def phrase_counts(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, hot_words: int = HOT_WORDS
) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, a), (lang, n)): counts of all phrases of 1 to ``longest`` words that
    occur ``least`` times, and all occurrences of words. Words are joined by a space."""
    blocks = written(encoded(docs), "phrase-blocks")
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    tokens = int(blocks.agg(F.sum("n")).first()[0] or 0)
    words = blocks.select("lang", F.inline(F.arrays_zip("words", "counts")))
    words = words.groupBy("lang", F.col("words").alias("phrase")).agg(F.sum("counts").alias("a"))
    words = written(words.filter(F.col("a") >= least), "phrase-words")
    # fewer than hot_words rows: each has more than that part of all occurrences
    hot = {(r["lang"], r["phrase"]) for r in words.filter(F.col("a") * hot_words > tokens).collect()}
    ranges = max(RANGES, -(-tokens // RANGE_POINTERS))
    sent = blocks.mapInArrow(partial(_dealt, ranges=ranges, hot=hot, longest=longest), SENT)

    def counted(rows: pa.Table) -> pa.Table:
        return _counted(rows, least, longest)

    longer = sent.groupBy("lang", "range").applyInArrow(counted, COUNTED)
    single = words.select("lang", "phrase", F.lit(1).alias("size"), "a")
    return written(single.unionAll(longer), "phrase-counts"), totals


# --- collocations ---------------------------------------------------------------------

def _inner_parts() -> Column:
    """(first word, number of words) of every contiguous part of two words or more of a phrase, but itself."""
    return F.expr(
        "filter(flatten(transform(sequence(1, size), i -> transform(sequence(i, size), "
        "j -> struct(i as first, j - i + 1 as words)))), p -> p.words > 1 and p.words < size)"
    )


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    inside: int = INSIDE,
    hot_words: int = HOT_WORDS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` collocations of every language.

    A phrase of 2 to ``longest`` words with ``least`` occurrences is a candidate. Its cut
    with the lowest floor(1000000 * a * a / (l * r)) gives l, r and the score, of cuts
    with the same score the first. Candidates with ``inside`` percent of their
    occurrences or more inside a longer candidate go. Counts are whole numbers and the
    score is found in decimals of 38 digits, so nothing is rounded.

    Null texts are empty, a null language is ``und``; empty and blank texts have no
    words. Repeated rows count each. Equal scores and counts go by phrase, in byte
    order. An empty table gives an empty result; other columns aren't looked at.
    """
    counts, totals = phrase_counts(docs, least, longest, hot_words)
    candidates = counts.filter("size > 1")
    spelt = candidates.withColumn("words", F.split("phrase", " "))
    cut = spelt.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.select(
        "lang", "phrase", "a", "size", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    cut = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    score = F.expr(
        f"(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast({SCALE} as decimal(7,0)))"
        " div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))"
    )
    scored = cut.withColumn("score", score).groupBy("lang", "phrase", "a", "size").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best")
    )
    part = F.explode(_inner_parts()).alias("p")
    inner = spelt.filter("size > 2").select("lang", "a", "words", part).select(
        "lang", F.array_join(F.slice("words", F.col("p.first"), F.col("p.words")), " ").alias("phrase"), "a"
    )
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a"))
    )
    by_score = F.desc("best.score"), F.desc("a"), F.asc("phrase")
    # the first of every share of a language, so that one task orders no more than SHARES * top of them
    share = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    first = share.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*by_score)))
    first = first.filter(F.col("rank") <= top).drop("rank")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by_score)))
    ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a",
        F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                             'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
),
split as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces),
placed as (select lang, words, unnest(range(1, len(words) + 1)) as i from split),
suffixes as materialized (select lang, words[i] as w1, words[i + 1] as w2, words[i + 2] as w3 from placed),
one as materialized (select lang, w1 as phrase, count(*) as a from suffixes group by all),
two as materialized (select lang, w1, w2, count(*) as a from suffixes where w2 is not null group by all having a >= 10),
three as materialized (select lang, w1, w2, w3, count(*) as a from suffixes where w3 is not null group by all having a >= 10),
totals as (select lang, sum(a)::bigint as n from one group by lang),
cuts as (
  select c.lang, c.w1 || ' ' || c.w2 as phrase, c.a, 1 as k, x.a as l, y.a as r
  from two c join one x on x.lang = c.lang and x.phrase = c.w1 join one y on y.lang = c.lang and y.phrase = c.w2
  union all
  select c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.a, 1, x.a, y.a
  from three c join one x on x.lang = c.lang and x.phrase = c.w1
       join two y on y.lang = c.lang and y.w1 = c.w2 and y.w2 = c.w3
  union all
  select c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.a, 2, x.a, y.a
  from three c join two x on x.lang = c.lang and x.w1 = c.w1 and x.w2 = c.w2
       join one y on y.lang = c.lang and y.phrase = c.w3
),
scored as (select *, (1000000::hugeint * a * a // (l::hugeint * r))::bigint as score from cuts),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
longer as (
  select lang, phrase, max(a) as most
  from (select lang, w1 || ' ' || w2 as phrase, a from three union all select lang, w2 || ' ' || w3, a from three)
  group by all
),
ranked as (
  select b.*, row_number() over (partition by b.lang order by score desc, a desc, b.phrase) as rank
  from best b left join longer o on o.lang = b.lang and o.phrase = b.phrase
  where o.most is null or 100 * o.most < 50 * b.a
)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""
