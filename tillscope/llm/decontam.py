"""Benchmark decontamination: item-sized windows, SimHash blocks, exact similarity.

DataFrame expressions only. A window of a document is similar to an item only if
enough of its shingles are the item's: t / (1 + t) of the shingles of both, for a
similarity of t. Documents are met by the rarest shingles of the items, of which any
such window has one. There, windows as long as an item are laid at every start, one by
one, from which that many shared shingles are in reach, wherever the item has them.
Windows are runs of shingle hashes; no text is copied for them.
Fingerprints of windows and of items of that length meet in multi-index Hamming
blocks: with more blocks than differing bits at least one block is equal, so every
pair within the radius becomes a candidate. Candidates are then verified by exact
weighted-shingle similarity.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import ascii_lower, free_name, table, written

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Bits in which the fingerprints of a window and an item may differ.
RADIUS = 24
#: Shingles of all items that are sent to every executor at most; 8 bytes each and their item.
BROADCAST_SHINGLES = 1_000_000
#: Documents with windows whose ids are sent to every executor at most.
BROADCAST_DOCS = 500_000
_BLANKS = " \t\n\v\f\r"


def normal_words(text: Column) -> Column:
    """Words between white space in lower-case ASCII; an empty array for null and blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANKS))
    return F.split(ascii_lower(trimmed), r"[\x20\x09-\x0D]+")


def shingle_hashes(words: Column, size: int) -> Column:
    """Hash of every run of ``size`` words; of the whole sequence where it is shorter."""
    count = F.when(F.get(words, F.lit(0)) == "", 0).otherwise(F.size(words))
    long = F.transform(
        F.sequence(F.lit(0), count - size), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(size)))
    )
    return F.when(count >= size, long).when(count > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(
        F.array().cast("array<long>")
    )


def _simhash(weighted: DataFrame, keys: list[str]) -> DataFrame:
    """keys, fingerprint: a bit is set where the shingles (hash, weight) that have it weigh over half.

    A sum counts bit b in its lower and bit b + 32 in its upper half: what shares a key is
    one text's, and weighs less than 2**31. Half the sums and one fold over them instead of
    a term for each bit keep the plan, and the driver's memory for it, small.
    """
    total = F.sum("weight").alias("total")
    halves = F.lit((1 << 32) | 1)
    pairs = [
        F.sum(F.col("weight") * F.shiftrightunsigned("hash", b).bitwiseAND(halves)).alias(f"b{b}") for b in range(32)
    ]
    sums = weighted.groupBy(*keys).agg(total, *pairs)

    def over_half(count: Column) -> Column:
        return F.shiftrightunsigned(F.col("total") - 2 * count, 63)  # the sign

    def with_next(bits: Column, pair: Column) -> Column:
        low, high = over_half(pair.bitwiseAND(F.lit((1 << 32) - 1))), over_half(F.shiftrightunsigned(pair, 32))
        return F.shiftleft(bits, 1).bitwiseOR(low).bitwiseOR(F.shiftleft(high, 32))

    from_top = F.array(*(f"b{b}" for b in reversed(range(32))))
    return sums.select(*keys, F.aggregate(from_top, F.lit(0).cast("long"), with_next).alias("fingerprint"))


def _edges(radius: int) -> list[int]:
    """Bit positions that part 64 bits into radius + 1 blocks."""
    count = min(radius + 1, 64)
    return [64 * i // count for i in range(count + 1)]


def _masks(radius: int) -> list[int]:
    """The bits of each of radius + 1 blocks, as signed longs."""
    edges = _edges(radius)
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in masks]


def _in_blocks(prints: DataFrame, radius: int) -> DataFrame:
    """A row for each of radius + 1 blocks of ``fingerprint``: its number and its own bits."""
    masks = F.array(*map(F.lit, _masks(radius)))
    placed = prints.select("*", F.posexplode(masks).alias("block", "mask"))
    return placed.withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask"))).drop("mask")


def benchmark_items(benchmark: DataFrame, shingle_words: int) -> DataFrame:
    """item_id, words (count), offset, hash of every shingle of every item with words.

    Items with the same text are one: the smallest item_id stands for it, and so do
    repeated rows.
    """
    words = benchmark.select("item_id", normal_words(F.col("text")).alias("tokens")).filter(F.col("tokens")[0] != "")
    words = words.groupBy("tokens").agg(F.min("item_id").alias("item_id"))
    # different texts under one id stay different items
    words = words.select("item_id", F.xxhash64("tokens").alias("item"), "tokens")
    hashes = shingle_hashes(F.col("tokens"), shingle_words)
    return words.select(
        "item_id", "item", F.size("tokens").alias("words"), F.posexplode(hashes).alias("offset", "hash")
    )


def contaminated_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    broadcast_shingles: int = BROADCAST_SHINGLES,
) -> DataFrame:
    """doc_id, item_id, start, similarity: windows of ``docs`` that repeat an item.

    ``start`` counts words from 0; a window has as many words as its item, or all of
    a shorter text. Similarity is the sum of the smaller over the sum of the greater
    number of times that window and item have each shingle. Per document and item the
    first of the most similar windows is returned.

    Null, empty and blank texts, in either table, match nothing. Items of fewer words
    than a shingle match the same run of words. A null doc_id is an id like any other,
    and rows that repeat an id are documents of their own, reported under it. Empty
    tables give an empty result; other columns aren't looked at.
    """
    hits = _hits(docs, benchmark, shingle_words, similarity, radius, broadcast_shingles)
    best = hits.groupBy("doc_id", "item_id").agg(
        F.min(F.struct((-F.col("similarity")).alias("less"), "start")).alias("best")
    )
    return best.select("doc_id", "item_id", F.col("best.start").alias("start"), (-F.col("best.less")).alias("similarity"))


def _hits(
    docs: DataFrame, benchmark: DataFrame, shingle_words: int, similarity: float, radius: int, broadcast_shingles: int
) -> DataFrame:
    """doc_id, text_hash, item_id, start, similarity of every window that repeats an item."""
    items = written(benchmark_items(benchmark, shingle_words), "benchmark-shingles")
    lengths = items.select("item", "item_id", "words").distinct()
    # a row is told by its id and text, so that repeated ids do not mix their windows
    texts = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), normal_words(F.col("text")).alias("tokens")
    )
    short = _short_hits(texts, items, shingle_words, broadcast_shingles)
    long = items.filter(F.col("words") >= shingle_words)
    windows = _windows(texts, long, shingle_words, similarity, broadcast_shingles)
    placed = written(windows, "benchmark-windows")
    shingles = placed.dropDuplicates(["window_id"]).select("window_id", F.explode("window").alias("hash"))
    shingles = written(shingles.groupBy("window_id", "hash").agg(F.count("*").alias("weight")), "benchmark-weights")
    own = long.groupBy("item", "hash").agg(F.count("*").alias("weight"))
    laid = placed.select("window_id", "words").distinct().join(_simhash(shingles, ["window_id"]), "window_id")
    laid = written(laid, "benchmark-prints")
    item_prints = _simhash(own, ["item"]).join(lengths.select("item", "words"), "item")
    candidates = _candidates(laid, written(item_prints, "benchmark-item-prints"), radius)
    similar = written(_verified(candidates, shingles, own).filter(F.col("similarity") >= similarity), "benchmark-similar")

    similar = similar.join(lengths, "item").select("window_id", "words", "item_id", "similarity")
    hits = placed.select("doc_id", "text_hash", "words", "start", "window_id").join(similar, ["window_id", "words"])
    hits = hits.select("doc_id", "text_hash", "item_id", "start", "similarity")
    return hits if short is None else hits.unionByName(short)


def _short_hits(
    texts: DataFrame, items: DataFrame, shingle_words: int, broadcast_shingles: int
) -> DataFrame | None:
    """Items of fewer words than a shingle, found where the same run of words is; None without such items."""
    found = None
    counts = items.filter(F.col("words") < shingle_words).groupBy("words").count().collect()
    for n, count in sorted((r["words"], r["count"]) for r in counts):  # at most shingle_words - 1 lengths
        keys = items.filter(F.col("words") == n).select("item_id", F.col("hash").alias("item_hash"))
        keys = F.broadcast(keys) if count <= broadcast_shingles else keys
        runs = texts.select("doc_id", "text_hash", F.posexplode(_runs(F.col("tokens"), n)).alias("start", "hash"))
        met = runs.join(keys, F.col("hash") == F.col("item_hash"))
        met = met.select("doc_id", "text_hash", "item_id", "start", F.lit(1.0).alias("similarity"))
        found = met if found is None else found.unionAll(met)
    return found


def prefix_shingles(items: DataFrame, similarity: float) -> DataFrame:
    """item, words, item_size, hash: the rarest shingles of each item.

    A window of that similarity shares at least ``similarity`` of the item's shingles,
    so it has one of them among any more than the rest. They are taken from the fewest
    items up, which keeps shingles that many items have out of the first join.
    """
    own = items.groupBy("item", "words", "hash").agg(F.count("*").alias("weight"))
    rarity = own.groupBy("hash").agg(F.count("*").alias("holders"))
    mine = Window.partitionBy("item")
    ranked = own.join(rarity, "hash").withColumn("item_size", F.sum("weight").over(mine))
    before = mine.orderBy("holders", "hash").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # a little less, against rounding
    spare = F.col("item_size") - F.ceil(similarity * F.col("item_size") - 1e-6)
    return ranked.filter(F.col("before") <= spare).select("item", "words", F.col("item_size").cast("int"), "hash")


def _windows(
    texts: DataFrame, items: DataFrame, shingle_words: int, similarity: float, broadcast_shingles: int
) -> DataFrame:
    """doc_id, text_hash, words, start, window_id, window (hashes of its shingles): the windows to compare.

    Documents are met by the rarest shingles of the items alone. Around those places, in
    cells as long as the item, all shared shingles are looked up, and windows are laid at
    every start that has enough of them in reach.
    """
    prefixes = written(prefix_shingles(items, similarity), "benchmark-prefixes")
    keys = prefixes.withColumnRenamed("hash", "item_hash")
    if prefixes.count() <= broadcast_shingles:
        keys = F.broadcast(keys)
    size = F.greatest(F.lit(1), F.size("tokens") - (shingle_words - 1)).alias("doc_size")
    hashes = shingle_hashes(F.col("tokens"), shingle_words)
    runs = texts.select("doc_id", "text_hash", size, F.posexplode(hashes).alias("at", "hash"))
    met = runs.join(keys, F.col("hash") == F.col("item_hash"))
    cell = F.floor(F.col("at") / F.col("item_size")).cast("int")
    cells = F.sequence(
        F.greatest(F.lit(0), cell - 1),
        F.least(cell + 1, F.floor((F.col("doc_size") - 1) / F.col("item_size")).cast("int")),
    )
    near = met.select("doc_id", "text_hash", F.explode(cells).alias("cell"), "item", "words", "item_size")
    near = near.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("item", "words", "item_size", "cell")).alias("cells")
    )
    near = written(near, "benchmark-places")

    own = _with_marks(texts, near, "cells").select(
        "doc_id", "text_hash", "cells", shingle_hashes(F.col("tokens"), shingle_words).alias("hashes")
    )
    own = written(own.dropDuplicates(["doc_id", "text_hash"]), "benchmark-documents")
    spread = own.select("doc_id", "text_hash", F.size("hashes").alias("doc_size"), "hashes", F.explode("cells").alias("c"))
    first = F.col("c.cell") * F.col("c.item_size")
    spread = spread.select(
        "doc_id", "text_hash", "doc_size", "c.item", "c.words", "c.item_size", first.alias("first"),
        F.posexplode(F.slice("hashes", first + 1, F.col("c.item_size"))).alias("place", "hash"),
    )
    shared = spread.join(items.select("item", "hash").distinct(), ["item", "hash"])
    shared = shared.groupBy("doc_id", "text_hash", "item", "words", "item_size", "doc_size").agg(
        F.sort_array(F.collect_set(F.col("first") + F.col("place"))).alias("at")
    )
    starts = shared.select(
        "doc_id", "text_hash", "words", F.least("item_size", "doc_size").alias("size"),
        F.explode(_starts(similarity)).alias("start"),
    )
    starts = starts.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("words", "size", "start")).alias("windows"))
    laid = _with_marks(own.drop("cells"), written(starts, "benchmark-starts"), "windows")
    laid = laid.select("doc_id", "text_hash", "hashes", F.explode("windows").alias("w")).select(
        "doc_id", "text_hash", "w.words", "w.start",
        F.slice("hashes", F.col("w.start") + 1, F.col("w.size")).alias("window"),
    )
    # equal windows are fingerprinted and compared once
    return laid.withColumn("window_id", F.xxhash64("window"))


def _with_marks(rows: DataFrame, marks: DataFrame, column: str) -> DataFrame:
    """The rows of marked documents with their marks; a row is told by doc_id and text_hash."""
    marks = marks.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), column)
    marks = F.broadcast(marks) if _sent_whole(marks, column) else marks.hint("merge")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    return rows.join(marks, same).drop("d", "h")


def _sent_whole(marks: DataFrame, column: str) -> bool:
    found = marks.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size(column)), F.lit(0)).alias("marks")).first()
    return found["rows"] + found["marks"] <= BROADCAST_DOCS


def _starts(similarity: float) -> Column:
    """Every start whose window holds as many shared shingles as the similarity needs.

    ``at`` has the sorted places of shared shingles in the document. A window of n places
    with the i-th as its first shared one holds ``need`` if the one need - 1 further on is
    less than n from its start, and starts behind the one before.
    """
    size = F.least("item_size", "doc_size")
    share = similarity / (1 + similarity)
    # a little less, against rounding
    need = F.greatest(F.lit(1), F.ceil(share * (F.col("item_size") + size) - 1e-6).cast("int"))
    last = F.col("doc_size") - size

    def spans(i: Column) -> Column:
        before = F.when(i > 0, F.get("at", i - 1) + 1).otherwise(F.lit(0))
        low = F.greatest(F.lit(0), before, F.get("at", i + need - 1) - size + 1)
        high = F.least(F.get("at", i), last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    there = F.size("at") - need
    return F.when(there >= 0, F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(there, F.lit(0))), spans)))


def _runs(words: Column, size: int) -> Column:
    """Hash of every run of ``size`` words as one shingle, as a short item has it."""
    joined = F.transform(
        F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(F.array_join(F.slice(words, i + 1, size), " "))
    )
    return F.when(F.size(words) >= size, joined).otherwise(F.array().cast("array<long>"))


def _candidates(windows: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """window_id, item: windows and items of their length at most ``radius`` bits apart.

    A pair comes from the first of the blocks that it shares, and so but once.
    """
    left = _in_blocks(windows, radius).withColumnRenamed("fingerprint", "print")
    right = _in_blocks(items, radius).withColumnRenamed("fingerprint", "item_print")
    differing = F.col("print").bitwiseXOR(F.col("item_print"))
    masks = F.array(*map(F.lit, _masks(radius)))
    shared = F.array_position(F.transform(masks, lambda mask: differing.bitwiseAND(mask)), F.lit(0).cast("long")) - 1
    # bits are counted first: few pairs are left to look for their first block
    near = (F.bit_count(differing) <= radius) & (shared == F.col("block"))
    return left.join(right, ["words", "block", "value"]).filter(near).select("window_id", "item")


def _verified(candidates: DataFrame, shingles: DataFrame, items: DataFrame) -> DataFrame:
    """Adds the weighted Jaccard similarity of the shingles of each pair."""
    sizes = shingles.groupBy("window_id").agg(F.sum("weight").alias("window_weight"))
    item_sizes = items.groupBy("item").agg(F.sum("weight").alias("item_weight"))
    mine = candidates.join(shingles, "window_id").withColumnRenamed("weight", "mine")
    shared = mine.join(items, ["item", "hash"]).groupBy("window_id", "item").agg(
        F.sum(F.least("mine", "weight")).alias("shared")
    )
    every = shared.join(sizes, "window_id").join(item_sizes, "item")
    whole = reduce(add, [F.col("window_weight"), F.col("item_weight"), -F.col("shared")])
    return every.select("window_id", "item", (F.col("shared") / whole).alias("similarity"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, by_text: bool = False, **options) -> DataFrame:
    """The rows of ``docs`` whose doc_id has no contaminated window, all columns as they are.

    Rows with a null doc_id go if any such row is contaminated. ``by_text`` tells rows
    apart by their text as well: clean rows stay whatever their id, null or repeated.
    """
    if by_text:
        defaults = {
            "shingle_words": SHINGLE_WORDS, "similarity": SIMILARITY, "radius": RADIUS,
            "broadcast_shingles": BROADCAST_SHINGLES,
        }
        found = _hits(docs, benchmark, **(defaults | options)).select("doc_id", "text_hash").distinct()
    else:
        found = contaminated_windows(docs, benchmark, **options).select("doc_id").distinct()
    found = written(found, "contaminated")
    name, text = free_name(docs, "contaminated_id"), free_name(docs, "contaminated_text")
    same = docs.doc_id.eqNullSafe(F.col(name))
    marks = found.withColumnRenamed("doc_id", name)
    if by_text:
        marks = marks.withColumnRenamed("text_hash", text)
        same = same & (F.xxhash64(docs.text) == F.col(text))
    found = F.broadcast(marks) if found.count() <= BROADCAST_DOCS else marks.hint("merge")
    return docs.join(found, same, "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return contaminated_windows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
