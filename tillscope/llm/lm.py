"""Language-model scores by a weighted backoff automaton.

Every text is read once into blocks: a small vocabulary of its own and a number
per token. Each block sends the n-grams it holds, one order after the other, as
sorted 64-bit keys in ranges of the key space, and gets their corpus counts back,
so that no task needs the n-grams of the corpus and no text is shuffled. From them
each block builds the part of the automaton that its own documents can reach:
n-grams are states and arcs; what is missing at a state goes over its failure arc,
at the weight of the mass that smoothing leaves in the whole corpus. Scoring moves
through all documents of a block side by side, from left to right, with one state
for each.

Every n-gram that occurs ``MIN_COUNT`` times is kept, at every size of the corpus;
nothing is collected or broadcast. N-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import remainder, shuffles_let_go, table, written

ORDER = 3
#: Bytes of text in a block at which it is closed; one document is never parted.
BLOCK_BYTES = 4_000_000
#: Least number of occurrences of an n-gram, the same at every size.
MIN_COUNT = 1
#: Least shares of the training tokens for pruned models: an n-gram needs the greater one. None by default.
WORD_SHARE, NGRAM_SHARE = 0.0, 0.0
#: N-grams of an order that meet in one task on average, at most, and least number of ranges.
RANGE_KEYS, RANGES = 4_000_000, 64
#: Tokens of a document that are walked one after the other; pieces go side by side.
PIECE_TOKENS = 128
DISCOUNT = 0.5
PRIOR = 0.5
HELD_OUT_MODULUS, HELD_OUT = 5, 1
#: The token behind the last word. No word is empty.
END = b""

ENCODED = "block long, doc_ids array<long>, held array<boolean>, lengths array<long>, codes binary, hashes array<long>, n_train long"
SENT = "range long, block long, packed binary"
ANSWERED = "block long, n int, range long, types long, packed binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _one(values, kind: pa.DataType) -> pa.ListArray:
    """A list array of one row."""
    flat = values if isinstance(values, pa.Array) else pa.array(values, type=kind)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def _row(columns: dict[str, tuple]) -> pa.RecordBatch:
    """None stands for a long, bytes for one binary value, other kinds for a list."""
    single = {None: pa.int64(), bytes: pa.binary()}
    arrays = [pa.array([v], single[k]) if k in single else _one(v, k) for v, k in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def _list(batch: pa.Table | pa.RecordBatch, name: str, row: int) -> pa.Array:
    return batch.column(name)[row].values


def _used(bits: int) -> list[int]:
    return [k for k in range(8) if bits >> k & 1]


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of 8-byte values of one length, byte by byte without the bytes that are zero in all
    rows. Each byte is compressed alone: random ones next to it would spoil its code."""
    masks, packed = bytearray(), []
    for column in columns:
        values = np.ascontiguousarray(column).view(np.uint64)
        any_set = int(np.bitwise_or.reduce(values)).to_bytes(8, "little")
        masks.append(sum(1 << k for k in range(8) if any_set[k]))
        for k in _used(masks[-1]):
            plane = pa.compress(np.ascontiguousarray(values.view(np.uint8)[k::8]), codec="zstd", asbytes=True)
            packed += [len(plane).to_bytes(8, "little"), plane]
    return b"".join([len(values).to_bytes(8, "little"), masks, *packed])


def _unpack(packed: bytes, columns: int) -> list[np.ndarray]:
    """The columns as int64."""
    size, masks, at = int.from_bytes(packed[:8], "little"), packed[8 : 8 + columns], 8 + columns
    found = []
    for mask in masks:
        values = np.zeros(size, np.int64)
        for k in _used(mask):
            at, end = at + 8, at + 8 + int.from_bytes(packed[at : at + 8], "little")
            plane = pa.decompress(packed[at:end], size, codec="zstd", asbytes=True)
            values.view(np.uint8)[k::8], at = np.frombuffer(plane, np.uint8), end
        found.append(values)
    return found


def _hash(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def _joined(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of n-grams from the hashes of their prefixes and last words."""
    x = prefix.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + word.view(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Numbers of all tokens, tokens of each text, and the token of each number; ``END`` has 0."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))  # byte by byte, ASCII only
    coded = pc.dictionary_encode(pa.concat_arrays([pa.array([END.decode()]), split.flatten()]))
    numbers = coded.indices.to_numpy()[1:]
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    words = numbers > 0  # white space at either end of a text leaves an empty piece there
    counts = np.bincount(text[words], minlength=len(texts))
    return np.insert(numbers[words], np.cumsum(counts), 0), counts + 1, coded.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, made = TaskContext.get().partitionId(), 0
    ids, held, texts, size = [], [], [], 0

    def block() -> pa.RecordBatch:
        numbers, lengths, vocab = _tokens(pa.concat_arrays(texts))
        out = np.concatenate(held)
        # frequent words get small numbers, which compress better
        order = np.argsort(-np.bincount(numbers, minlength=len(vocab)), kind="stable")
        place = np.empty(len(vocab), dtype=np.int64)
        place[order] = np.arange(len(vocab))
        named = _hash(vocab)[order]
        return _row({
            "block": ((part << 32) + made, None), "doc_ids": (pa.concat_arrays(ids), pa.int64()), "held": (out, pa.bool_()),
            "lengths": (lengths, pa.int64()), "codes": (_pack(place[numbers]), bytes),
            "hashes": (named, pa.int64()), "n_train": (int(lengths[~out].sum()), None),
        })

    for batch in batches:
        doc_ids, out = batch.column("doc_id"), np.asarray(batch.column("held").to_pylist(), dtype=bool)
        text = batch.column("text").cast(pa.binary()).fill_null(b"")
        ends, at = np.cumsum(pc.binary_length(text).to_numpy().astype(np.int64) + 1), 0
        while at < len(text):
            before = int(ends[at - 1]) if at else 0
            to = min(int(np.searchsorted(ends, before + BLOCK_BYTES - size)) + 1, len(text))
            ids.append(doc_ids[at:to])
            held.append(out[at:to])
            texts.append(text[at:to])
            size += int(ends[to - 1]) - before
            at = to
            if size >= BLOCK_BYTES:
                yield block()
                made += 1
                ids, held, texts, size = [], [], [], 0
    if ids:
        yield block()


def encoded(docs: DataFrame) -> DataFrame:
    out = F.coalesce(remainder(F.col("doc_id"), HELD_OUT_MODULUS) == HELD_OUT, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), out.alias("held"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_encode, ENCODED)


# --- the counts of the n-grams of a block ----------------------------------------------

@dataclass
class Grams:
    """Distinct n-grams of one order in a block, numbered from 1, and ``order``, which sorts them by ``hashes``.

    Words keep their numbers, longer n-grams have them by hash. ``train`` counts training
    documents. For every n-gram ``keys`` holds (number of the prefix << 32 | number of
    the word) and ``suffix`` the number without the first word, one order down, if that
    order was asked for; ``ending`` has the number of the n-gram that ends at each token, or 0.
    """

    hashes: np.ndarray
    train: np.ndarray
    order: np.ndarray | slice
    ending: np.ndarray
    keys: np.ndarray | None = None
    suffix: np.ndarray | None = None


def _grams(block: pa.Table | pa.RecordBatch, row: int, first: int, last: int) -> list[Grams]:
    """The n-grams of a block from order ``first`` to ``last``."""
    lengths = _list(block, "lengths", row).to_numpy()
    held = np.asarray(_list(block, "held", row).to_pylist(), dtype=bool)
    words = _unpack(block.column("codes")[row].as_py(), 1)[0] + 1
    named = _list(block, "hashes", row).to_numpy()
    train = np.repeat(~held, lengths)
    inner = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    found = []
    if first == 1:
        counts = np.bincount(words[train] - 1, minlength=len(named))
        found.append(Grams(named, counts, np.argsort(named.view(np.uint64)), words))
    word_hashes = hashes = named[words - 1]  # of the n-gram that ends at each token
    for n in range(2, last + 1):
        ends = np.flatnonzero(inner >= n - 1)
        ending, hashes = hashes, np.zeros(len(words), dtype=np.int64)
        hashes[ends] = _joined(ending[ends - 1], word_hashes[ends])
        if n < first:
            continue
        distinct, inverse = np.unique(hashes[ends].view(np.uint64), return_inverse=True)
        counts, number = np.bincount(inverse[train[ends]], minlength=len(distinct)), np.zeros(len(words), dtype=np.int64)
        number[ends] = inverse + 1
        own = Grams(distinct.view(np.int64), counts, slice(None), number)
        if found:
            own.keys, own.suffix = np.empty((2, len(distinct)), dtype=np.int64)
            own.keys[inverse] = (found[-1].ending[ends - 1] << 32) | words[ends]
            own.suffix[inverse] = found[-1].ending[ends]  # the shorter n-gram that ends at the same token
        found.append(own)
    return found


def _answers(rows: pa.Table, n: int, grams: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Corpus counts, leaves and first flags of a block's n-grams, in the order of their numbers."""
    own = rows.filter(pc.equal(rows.column("n"), n)).sort_by("range")
    parts = [_unpack(p, 3) for p in own.column("packed").to_pylist()]
    columns = []
    for k in range(3):
        column = np.empty(len(grams.hashes), dtype=np.int64)
        column[grams.order] = np.concatenate([p[k] for p in parts]) if parts else []
        columns.append(column)
    counts, leaves, first = columns
    return counts, leaves.view(np.float64), first == 1


def _sent(blocks: DataFrame, answers: DataFrame | None, n: int, bits: int, least: float) -> DataFrame:
    """A row for each block and range of keys that it has n-grams of: sorted keys, training
    counts and leaves.

    Leaves are what the kept arcs of a state have above the discount. Each arc is added
    in the first block that holds it, so that the sum over blocks counts it once.
    """

    def rows(block, row: int, own: Grams, leaves: np.ndarray) -> Iterator[pa.RecordBatch]:
        hashes = own.hashes[own.order].view(np.uint64)
        columns = hashes.view(np.int64), own.train[own.order].astype(np.int64), leaves[own.order].view(np.int64)
        ranges = (hashes >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(ranges, prepend=-1, append=-1))
        place = block.column("block")[row].as_py()
        packed = [
            _pack(np.diff(columns[0][a:b], prepend=np.int64(0)), *(c[a:b] for c in columns[1:]))
            for a, b in zip(cuts, cuts[1:])
        ]
        names = pa.array(ranges[cuts[:-1]], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [names, pa.array([place] * len(packed), pa.int64()), pa.array(packed, pa.binary())],
            names=["range", "block", "packed"],
        )

    if answers is None:
        def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    own = _grams(batch, row, n, n)[0]
                    yield from rows(batch, row, own, np.zeros(len(own.hashes)))

        return blocks.mapInArrow(longest, SENT)

    def shorter(block: pa.Table, answered: pa.Table) -> pa.Table:
        own, longer = _grams(block, 0, n, n + 1)
        counts, _, first = _answers(answered, n + 1, longer)
        new = first & (counts >= least)
        leaves = np.bincount((longer.keys[new] >> 32) - 1, counts[new] - DISCOUNT, minlength=len(own.hashes))
        return pa.Table.from_batches(rows(block, 0, own, leaves.astype(np.float64)))

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(shorter, SENT)


def _answered(sent: DataFrame, n: int) -> DataFrame:
    """Gives every block the corpus counts and leaves of the n-grams it sent, and whether it is
    the first block with each in training documents."""

    def count(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        parts = [_unpack(p, 3) for p in rows.column("packed").to_pylist()]
        ends = np.cumsum([len(p[0]) for p in parts])
        keys, inverse = np.unique(np.concatenate([np.cumsum(p[0]) for p in parts]), return_inverse=True)
        train = np.concatenate([p[1] for p in parts])
        counts = np.bincount(inverse, train, minlength=len(keys)).astype(np.int64)
        leaves = np.bincount(inverse, np.concatenate([p[2] for p in parts]).view(np.float64), minlength=len(keys))
        at = np.flatnonzero(train)[::-1]
        first = np.full(len(keys), -1)
        first[inverse[at]] = at  # the smallest place comes last and stays
        first = (first[inverse] == np.arange(len(inverse))).astype(np.int64)
        counts, leaves = counts[inverse], leaves[inverse].view(np.int64)
        slices = [slice(b - len(p[0]), b) for p, b in zip(parts, ends)]
        return pa.table([
            rows.column("block"), pa.array([n] * len(parts), pa.int32()), rows.column("range"),
            pa.array([int(first[s].sum()) for s in slices], pa.int64()),
            pa.array([_pack(counts[s], leaves[s], first[s]) for s in slices], pa.binary()),
        ], names=[c.split()[0] for c in ANSWERED.split(", ")])

    return sent.groupBy("range").applyInArrow(count, ANSWERED)


# --- the automaton ------------------------------------------------------------------

@dataclass
class Automaton:
    """States: 0 the root, 1 to words the frequent words, above them longer n-grams.

    ``offsets`` has the last state of each length. Arcs are numbered like the n-grams they
    spell, from the shortest on: ``keys`` are (state << 32 | word), with ``logs`` and ``to``;
    ``back`` is the log weight of a state's failure arc and ``fail`` where it leads.
    """

    keys: np.ndarray
    logs: np.ndarray
    to: np.ndarray
    back: np.ndarray
    fail: np.ndarray
    end: int
    order: int
    offsets: np.ndarray

    @cached_property
    def by_key(self) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(self.keys)
        return order, self.keys[order]

    def find(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Number of the arc with each word at each state, or -1."""
        order, keys = self.by_key
        wanted = (states << 32) | words
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[place] == wanted, order[place], -1)


@dataclass
class Level:
    """Kept n-grams of one order: sorted keys (number of the prefix << 32 | word) and counts."""

    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    #: number of the suffix one order down, 0 where it isn't kept; looked up where it isn't given
    suffix: np.ndarray | None = None

    def number(self, keys: np.ndarray) -> np.ndarray:
        """Number from 1 of each key, 0 where it isn't kept."""
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at + 1, 0)


def automaton(
    word_counts: np.ndarray, levels: list[Level], tokens: int, types: int, end: int, leaves: np.ndarray | None = None
) -> Automaton:
    """Interpolated absolute discounting over the kept n-grams.

    word_counts[g] is the count of frequent word g, word_counts[0] unused. An arc's
    probability is (count - discount) / count of its state plus the failure weight
    times the probability one state down; a failure weight is what the arcs' own
    parts leave of one. So the words of every state share exactly one. ``leaves`` gives
    the sum of (count - discount) of all arcs of each state where ``levels`` holds but
    some of them.
    """
    words = len(word_counts) - 1
    offsets = [0]  # state of the n-gram with number i of order n is offsets[n - 1] + i
    for size in [words] + [len(v.keys) for v in levels]:
        offsets.append(offsets[-1] + size)
    states = offsets[-1] + 1
    counts = np.ones(states)
    counts[1 : words + 1] = np.maximum(word_counts[1:], 1)
    fail = np.zeros(states, dtype=np.int64)
    unigram = (word_counts + PRIOR) / (tokens + PRIOR * (types + 1))
    tails = np.arange(words + 1)  # number of the longest proper suffix, one order down, of each n-gram
    last = np.arange(words + 1)  # last word of each n-gram
    own_leaves = np.zeros(states)
    arcs: list[tuple] = []
    for n, level in enumerate(levels, 2):
        prefix, word = level.keys >> 32, level.keys & 0xFFFFFFFF
        source = offsets[n - 2] + prefix
        own = (level.counts - DISCOUNT) / counts[source]
        if leaves is None:
            own_leaves += np.bincount(source, weights=own, minlength=states)
        state = offsets[n - 1] + 1 + np.arange(len(level.keys))
        counts[state] = level.counts
        if n == 2:
            suffix = word
        elif level.suffix is not None:
            suffix = level.suffix
        else:  # the suffix of (prefix, word) is (suffix of prefix, word), kept one order down
            suffix = levels[n - 3].number((tails[prefix] << 32) | word)
        fail[state] = np.where(suffix > 0, offsets[n - 2] + suffix, word)
        arcs.append((source, word, own, state, suffix))
        tails, last = np.concatenate(([0], suffix)), np.concatenate(([0], word))
    leaves = own_leaves if leaves is None else leaves / counts
    weight = np.clip(1 - leaves, 1e-12, 1.0)
    has_arcs = leaves > 0
    # probabilities from short to long: one state down the arc's word is an arc as well, or a word at the root
    below = None
    keys, logs, to = [np.empty(0, np.int64)], [np.empty(0)], [np.empty(0, np.int64)]
    for n, (source, word, own, state, suffix) in enumerate(arcs, 2):
        down = unigram[word] if n == 2 else np.where(suffix > 0, below[np.maximum(suffix - 1, 0)], unigram[word])
        whole = own + weight[source] * down
        keys.append((source << 32) | word)
        logs.append(np.log10(whole))
        # failure arcs pass states without arcs by; those of shorter states do already
        fail[state] = np.where(has_arcs[fail[state]], fail[state], fail[fail[state]])
        ahead = np.where(has_arcs[state], state, fail[state])  # the longest suffix that has arcs of its own
        to.append(np.where(word == end, 0, ahead))
        below = whole
    # a word without arcs of its own leads to the root
    back = np.zeros(states)
    back[has_arcs] = np.log10(weight[has_arcs])
    fail[~has_arcs] = 0
    return Automaton(
        np.concatenate(keys), np.concatenate(logs), np.concatenate(to), back, fail, end, len(levels) + 1, np.array(offsets)
    )


def _pieces(lengths: np.ndarray, order: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, tokens, run-in) of the pieces that documents are walked in.

    A state depends on no more than the order - 1 tokens before it, so a piece that
    begins that many tokens early comes into the state of the whole walk.
    """
    counts = -(-lengths // size)
    document = np.repeat(np.arange(len(lengths)), counts)
    number = np.arange(len(document)) - np.repeat(np.cumsum(counts) - counts, counts)
    run_in = np.minimum(number * size, order - 1)
    first = (np.cumsum(lengths) - lengths)[document] + number * size
    tokens = np.minimum(lengths[document] - number * size, size)
    return document, first - run_in, tokens + run_in, run_in


def traverse(
    model: Automaton, words: np.ndarray, unigrams: np.ndarray, lengths: np.ndarray, size: int = PIECE_TOKENS,
    arcs: np.ndarray | None = None,
) -> np.ndarray:
    """Log probability of each document: pieces of all move one token at a time, each in its state.

    ``words`` and ``unigrams`` hold the frequent word's number (or 0) and the log
    probability at the root of every token, documents one behind the other. ``arcs`` has a
    row for each length of a state, and in it the arc that a state of that length, reached
    over the tokens before, takes with each token, or -1; without it arcs are looked up.
    """
    document, starts, sizes, run_in = _pieces(lengths, model.order, size)
    order = np.argsort(-sizes, kind="stable")
    document, starts, sizes, run_in = document[order], starts[order], sizes[order], run_in[order]
    total, state = np.zeros(len(sizes)), np.zeros(len(sizes), dtype=np.int64)
    longest = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(longest), side="left")  # pieces longer than t
    for t in range(longest):
        k = alive[t]
        at = starts[:k] + t
        word, now = words[at], state[:k].copy()
        gained, ahead = np.zeros(k), np.zeros(k, dtype=np.int64)
        open_ = np.arange(k)
        for _ in range(model.order if len(model.keys) else 0):
            open_ = open_[now[open_] > 0]
            if not len(open_):
                break
            if arcs is None:
                place = model.find(now[open_], word[open_])
            else:
                place = arcs[np.searchsorted(model.offsets, now[open_]) - 1, at[open_]]
            hit = place >= 0
            taken = open_[hit]
            gained[taken] += model.logs[place[hit]]
            ahead[taken] = model.to[place[hit]]
            now[taken] = -1  # settled by an arc
            open_ = open_[~hit]
            gained[open_] += model.back[now[open_]]
            now[open_] = model.fail[now[open_]]
        rooted = now >= 0
        gained[rooted] += unigrams[at[rooted]]
        ahead[rooted] = np.where(word[rooted] == model.end, 0, word[rooted])
        total[:k] += np.where(run_in[:k] <= t, gained, 0.0)
        state[:k] = ahead
    return np.bincount(document, total, minlength=len(lengths))


def _scored(blocks: DataFrame, answers: DataFrame, order: int, tokens: int, types: int, least: float) -> DataFrame:
    def walk(block: pa.Table, answered: pa.Table) -> pa.Table:
        grams = _grams(block, 0, 1, order)
        levels, leaves, number = [], [np.zeros(1)], None
        arcs, before = np.empty((order - 1, len(grams[0].ending)), dtype=np.int64), 0
        for n, own in enumerate(grams, 1):
            counts, left, _ = _answers(answered, n, own)
            kept = counts >= least
            leaves.append(left[kept])
            # a kept n-gram has kept prefixes and words, and numbers keep their order
            if n == 1:
                words, word_counts = np.concatenate(([0], np.where(kept, np.cumsum(kept), 0))), counts
                number = words
            else:
                keys = own.keys[kept]
                shorter = number[own.suffix[kept]]
                levels.append(Level((number[keys >> 32] << 32) | words[keys & 0xFFFFFFFF], counts[kept], shorter))
                number = np.concatenate(([0], np.where(kept, np.cumsum(kept), 0)))
                arcs[n - 2] = np.where(number > 0, number + (before - 1), -1)[own.ending]
                before += len(keys)
        end = words[1:][grams[0].hashes == _hash([END])[0]]
        frequent = np.concatenate(([0], word_counts[words[1:] > 0])).astype(np.float64)
        model = automaton(frequent, levels, tokens, types, int(end[0]) or -1, np.concatenate(leaves))
        codes, lengths = _unpack(block.column("codes")[0].as_py(), 1)[0], _list(block, "lengths", 0).to_numpy()
        logs = np.log10((word_counts + PRIOR) / (tokens + PRIOR * (types + 1)))[codes]
        starts = np.cumsum(lengths) - lengths
        return pa.table([
            _list(block, "doc_ids", 0), _list(block, "held", 0), pa.array(lengths, pa.int64()),
            pa.array(np.add.reduceat((word_counts > 0)[codes].astype(np.int64), starts), pa.int64()),
            pa.array(np.add.reduceat(logs, starts)),
            pa.array(traverse(model, words[codes + 1].astype(np.int64), logs, lengths, arcs=arcs)),
        ], names=[c.split()[0] for c in SCORED.split(", ")])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(walk, SCORED)


def language_model_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, others): doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    Null, empty and blank texts are one end token. A null doc_id is not held out.
    Repeated rows are counted and scored each. An empty table gives an empty result;
    without training documents every token is unknown. Other columns aren't looked at.
    """
    blocks = written(encoded(docs), "lm-blocks")
    lengths = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)
    tokens, every = (int(v or 0) for v in blocks.agg(F.sum("n_train"), F.sum(lengths)).first())
    bits = max(RANGES, -(-every // RANGE_KEYS) - 1).bit_length() if every > RANGES * RANGE_KEYS else RANGES.bit_length() - 1
    least = max(MIN_COUNT, WORD_SHARE * tokens, NGRAM_SHARE * tokens)
    answers, parts = None, []
    for n in range(order, 0, -1):
        step = _answered(_sent(blocks, answers, n, bits, least), n)
        with shuffles_let_go(docs.sparkSession):  # they hold as much as the input, at each order
            answers = written(step, f"lm-counts-{n}")
        parts.append(answers)
    types = int(answers.agg(F.sum("types")).first()[0] or 0)
    scored = _scored(blocks, reduce(DataFrame.unionAll, parts), order, tokens, types, least)
    return scored.withColumn("train_tokens", F.lit(tokens).cast("long"))


def query(spark, sf_dir: str) -> DataFrame:
    scores = language_model_scores(table(spark, sf_dir, "documents"))
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
