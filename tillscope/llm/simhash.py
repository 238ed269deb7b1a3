"""SimHash near-duplicates with a pigeonring filter.

The 64 bits are cut into a ring of five segments. If two fingerprints differ in
at most r bits, then on some start every chain of consecutive segments holds at
most its share of the budget, r * length / 5 differing bits. For r = 2 a chain of
one or two segments has no difference at all, so candidates meet on the value of
two neighbouring segments, and longer chains prune them before all bits count.
"""

from __future__ import annotations

from functools import reduce
from itertools import repeat
from operator import or_

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import free_name, table, written
from tillscope.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
SEGMENTS = 5
#: Members of a bucket that are compared in one task; larger buckets go in pairs of such blocks.
BLOCK = 2048
#: Buckets up to this size are joined with themselves.
SMALL = 32


# --- fingerprints -----------------------------------------------------------------

def _shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every shingle; of the whole sequence where it is shorter."""
    if len(words) <= size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(HASH_SEED)), dtype=np.uint64)


def _majority_bits(hashes: np.ndarray) -> int:
    """The bits that are set in more than half of the hashes.

    Ones are counted per bit position with eight counters of one byte to a word,
    which are emptied before they can overflow.
    """
    counts = np.zeros(64, dtype=np.int64)
    lanes = np.uint64(0x0101010101010101)
    for bit in range(8):
        ones = (hashes >> np.uint64(bit)) & lanes  # bit j * 8 + bit of the hash in octet j
        for at in range(0, len(ones), 255):
            part = ones[at : at + 255].sum(dtype=np.uint64)
            counts[bit::8] += np.frombuffer(part.tobytes(), dtype=np.uint8)
    return sum(1 << int(i) for i in np.flatnonzero(2 * counts > len(hashes)))


def _fingerprint(text: bytes | None, size: int) -> int:
    found = (text or b"").lower().split()  # both act on ASCII only
    return _majority_bits(_shingle_hashes(found, size)) if found else 0


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """SimHash of a text as a signed long; zero for null, empty and blank texts."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        values = np.array([_fingerprint(t, shingle_words) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return simhash(text.cast("binary"))


# --- pairs within the radius --------------------------------------------------------

def segment_edges(segments: int = SEGMENTS) -> list[int]:
    """Bit positions that part 64 bits into segments as equal as can be."""
    return [64 * i // segments for i in range(segments + 1)]


def _ring_masks(segments: int) -> list[list[int]]:
    """masks[start][length - 1]: the bits of that many segments from start on, round the ring."""
    edges = segment_edges(segments)
    own = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(segments)]
    return [
        [reduce(or_, (own[(start + k) % segments] for k in range(length))) for length in range(1, segments + 1)]
        for start in range(segments)
    ]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _key_length(segments: int, max_bits: int) -> int:
    """Segments of a chain whose budget allows no difference."""
    return max(n for n in range(1, segments + 1) if n * max_bits < segments)


def _chain_holds(difference: Column, start: int, segments: int, max_bits: int) -> Column:
    masks = _ring_masks(segments)[start]
    fits = [
        F.bit_count(difference.bitwiseAND(F.lit(_signed(mask)))) <= length * max_bits // segments
        for length, mask in enumerate(masks, 1)
    ]
    return reduce(lambda a, b: a & b, fits)


def _linked_in_blocks(left: np.ndarray, right: np.ndarray, same: bool, masks: list[int], max_bits: int):
    """Links of a spanning forest between the fingerprints of two blocks of a bucket."""
    links = []
    budgets = [length * max_bits // len(masks) for length in range(1, len(masks) + 1)]
    labels = np.arange(len(right)) if same else np.arange(len(left) + len(right))
    at = 0 if same else len(left)  # where the labels of the right block begin
    for i, one in enumerate(left):
        first = i + 1 if same else 0
        difference = right[first:] ^ one
        alive = np.ones(len(difference), dtype=bool)
        for mask, budget in zip(masks, budgets):
            alive &= np.bitwise_count(difference & np.uint64(mask)) <= budget
        near = np.flatnonzero(alive) + first
        foreign = labels[at + near] != labels[i]
        while foreign.any():
            other = near[foreign.argmax()]
            links.append((int(one), int(right[other])))
            labels[labels == labels[at + other]] = labels[i]
            foreign = labels[at + near] != labels[i]
    return links


def fingerprint_links(
    distinct: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, block: int = BLOCK, small: int = SMALL
) -> DataFrame:
    """(a, b): links that join every two of the ``distinct`` fingerprints (column fp) in
    the radius, at least by way of others that are also linked.

    Each fingerprint goes into one bucket per start on the ring. Small buckets are
    joined with themselves. Larger ones are cut into blocks, each pair of blocks is
    one group of bounded size, and it returns a spanning forest, so that neither a
    task nor the output grows with the square of a bucket.
    """
    length = _key_length(segments, max_bits)
    masks = _ring_masks(segments)
    keys = F.array(*(F.col("fp").bitwiseAND(F.lit(_signed(masks[s][length - 1]))) for s in range(segments)))
    placed = distinct.select("fp", F.posexplode(keys).alias("start", "key"))
    counts = placed.groupBy("start", "key").agg(F.count("*").alias("members")).filter("members > 1")
    shared = written(placed.join(counts, ["start", "key"]), "simhash-buckets")

    few = shared.filter(F.col("members") <= small)
    one = few.select("start", "key", F.col("fp").alias("a"))
    other = few.select("start", "key", F.col("fp").alias("b"))
    difference = F.col("a").bitwiseXOR(F.col("b"))
    holds = [(F.col("start") == s) & _chain_holds(difference, s, segments, max_bits) for s in range(segments)]
    links = one.join(other, ["start", "key"]).filter(F.col("a") < F.col("b")).filter(reduce(or_, holds))

    # hash order deals members to blocks evenly, whatever the bucket
    many = shared.filter(F.col("members") > small)
    blocks = F.ceil(F.col("members") / block)
    many = many.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda i: F.struct(F.least(i, F.col("mine")).alias("i"), F.greatest(i, F.col("mine")).alias("j")),
    )
    grouped = many.withColumn("pair", F.explode(pairs)).select("start", "key", "pair.*", "mine", "fp")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        start, i, j = (int(group[c].iat[0]) for c in ("start", "i", "j"))
        values = group["fp"].to_numpy(np.int64).view(np.uint64)
        left, right = values[group["mine"] == i], values[group["mine"] == j]
        found = _linked_in_blocks(left, right, i == j, masks[start], max_bits)
        pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    forest = grouped.groupBy("start", "key", "i", "j").applyInPandas(compare, "a long, b long")
    return links.select("a", "b").unionAll(forest).distinct()


# --- documents ----------------------------------------------------------------------

def _grouped(docs: DataFrame, shingle_words: int, max_bits: int, options: dict) -> tuple[DataFrame, DataFrame]:
    """((doc_id, fp), (fp, first_id, component, component_id)): the rows, and their classes by fingerprint.

    ``first_id`` is the smallest doc_id of a class, ``component`` the smallest
    fingerprint that is reached from it and ``component_id`` the smallest doc_id.
    """
    prints = written(docs.select("doc_id", fingerprint(F.col("text"), shingle_words).alias("fp")), "simhash")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    classes = written(classes, "simhash-classes")
    links = fingerprint_links(classes.select("fp"), max_bits, **options)
    reached = written(connected_components(links, "a", "b"), "simhash-components")
    linked = classes.join(reached, classes.fp == reached.node)
    least = linked.groupBy("component").agg(F.min("first_id").alias("least_id"))
    joined = reached.join(least, "component").select(F.col("node").alias("fp"), "component", "least_id")
    return prints, classes.join(joined, "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"),
        F.coalesce("least_id", "first_id").alias("component_id"),
    )


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, **options
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and any other columns): doc_id, fp, component_id.

    ``fp`` is the fingerprint as a signed long and ``component_id`` the smallest
    doc_id that is reached over fingerprints at most ``max_bits`` apart. Null, empty
    and blank texts have fingerprint zero, which is linked like any other. Repeated
    rows share a component. A null doc_id names no document: it has a fingerprint
    and component of its text but is never the smallest; a component of such rows
    alone has none. An empty table gives an empty result.
    """
    prints, classes = _grouped(docs, shingle_words, max_bits, options)
    return prints.join(classes.select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def without_near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, **options
) -> DataFrame:
    """The rows of ``docs`` but for all documents of a group except its smallest doc_id.

    All columns stay as they are. Of several rows of a group that have this id one stays:
    the one with the smallest fingerprint, of these the one with the smallest hash of
    its text, then of its other columns. Rows that repeat an id in other groups are
    judged there. Rows without doc_id name no document and stay.
    """
    prints, classes = _grouped(docs, shingle_words, max_bits, options)
    own = classes.filter(F.col("first_id") == F.col("component_id"))
    kept = own.groupBy("component").agg(F.min(F.struct("fp", "first_id")).alias("kept"))
    rows = prints.groupBy("doc_id").agg(F.count("*").alias("rows"))
    kept = kept.select(F.col("kept.first_id").alias("doc_id"), "kept.fp").join(rows, "doc_id")
    kept = written(kept, "simhash-kept")
    id_, print_ = free_name(docs, "kept_id"), free_name(docs, "kept_print")
    single = kept.filter("rows = 1").select(F.col("doc_id").alias(id_))
    unnamed = docs.filter(F.col("doc_id").isNull())
    # merged at every size: the kept ids grow with the documents and are not to be broadcast
    result = docs.join(single.hint("merge"), docs.doc_id == F.col(id_), "left_semi")
    repeated = kept.filter("rows > 1")
    if not repeated.isEmpty():  # fingerprints tell the rows of an id apart; made anew for these alone
        again = docs.join(repeated.select(F.col("doc_id").alias(id_)).hint("merge"), docs.doc_id == F.col(id_), "left_semi")
        again = again.withColumn(print_, fingerprint(F.col("text"), shingle_words))
        pairs = repeated.select(F.col("doc_id").alias(id_), F.col("fp").alias(print_ + "_"))
        same = (F.col("doc_id") == F.col(id_)) & (F.col(print_) == F.col(print_ + "_"))
        again = again.join(pairs.hint("merge"), same, "left_semi")
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        order = F.struct(F.xxhash64("text"), F.xxhash64(F.to_json(whole)))
        one = again.groupBy("doc_id", print_).agg(F.min_by(whole, order).alias("row"))
        result = result.unionAll(one.select("row.*"))
    return result.unionAll(unnamed)


def query(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
