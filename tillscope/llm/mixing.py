"""Mixing sources to target weights by a low-discrepancy schedule.

A golden-ratio sequence of points in [0, 1) runs through the cumulative shares of
the sources, so that every stretch of the schedule holds each source in its
share. The r-th slot of a source takes the r-th block of its word stream: its
documents in a shuffled order, one behind the other, round and round up to the
source's target, cut into blocks of equally many words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import WORD, partitions, table, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
BLOCK_WORDS = 1024
SEED = 11
#: 2**31 / golden ratio, odd: its multiples modulo 2**31 run through all points before one returns.
GOLDEN, POINTS = 1327217885, 1 << 31
#: The shuffled order of a source is summed up in FAN * FAN runs.
FAN = 128
#: Equal rows that are dealt out together.
COPIES = 65_536


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """One row per source: rank in code point order (null last), size, weight, target.

    The sources share ``share`` times all words by weight. No target exceeds
    ``repeats`` times its source; what is cut off goes to the others by weight.
    With the sources ordered by size per weight, those cut off come first, so the
    common level is found from running sums over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("rank", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("double"))
    ranked = ranked.withColumn("limit", F.col("source_size") * F.lit(float(repeats)))
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) * share - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ) / F.sum("weight").over(rest)
    ranked = ranked.withColumn("level", level)
    # the first source in this order that stays under its limit fixes the level of the rest
    under = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))
    ranked = ranked.withColumn("common", F.first(under, ignorenulls=True).over(
        by_level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ))
    target = F.coalesce(F.least(F.col("common") * F.col("weight"), F.col("limit")), F.col("limit"))
    return ranked.select("source", "rank", "source_size", "weight", target.alias("target"))


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(rank, round, slot): the slots of every source, numbered from 0 per source.

    Slot n lies at n / golden ratio, modulo 1, and belongs to the source whose
    stretch of the cumulative shares holds that point. Points meet stretches in an
    equality join on cells of the unit interval, whatever the number of sources.
    """
    spark = targets.sparkSession
    row = targets.agg(F.sum("target").alias("all"), F.count("*").alias("n")).first()
    slots = int(-(-(row["all"] or 0) // block_words))
    cells = 1 << max(10, (row.n or 1).bit_length() + 2)
    upto = F.sum("target").over(Window.orderBy("rank")) / F.lit(float(row["all"] or 1))
    spans = targets.select("rank", upto.alias("upto"))
    spans = spans.withColumn("from", F.lag("upto", 1, 0.0).over(Window.orderBy("rank")))
    spans = spans.filter(F.col("from") < F.col("upto")).withColumn(
        "cell",
        F.explode(F.sequence(
            F.floor(F.col("from") * cells), F.least(F.floor(F.col("upto") * cells), F.lit(cells - 1))
        )),
    )
    point = F.col("id") % POINTS * GOLDEN % POINTS / F.lit(float(POINTS))
    mixed = spark.range(slots).select(F.col("id").alias("slot"), point.alias("point"))
    mixed = mixed.withColumn("cell", F.floor(F.col("point") * cells))
    held = mixed.join(spans, "cell").filter("point >= from and point < upto")
    return _numbered(held.select("rank", "slot"), slots)


def _numbered(held: DataFrame, slots: int) -> DataFrame:
    """Numbers the slots of each source: per stretch of the schedule, then within it."""
    width = max(FAN, -(-slots // (FAN * FAN)))
    held = held.withColumn("stretch", F.floor(F.col("slot") / width))
    within = Window.partitionBy("rank", "stretch")
    held = held.withColumn("place", F.row_number().over(within.orderBy("slot")) - 1)
    counts = held.groupBy("rank", "stretch").agg(F.count("*").alias("count"))
    counts = _offsets(counts, ["rank"], "stretch", "count", width_of=FAN)
    return held.join(counts, ["rank", "stretch"]).select(
        "rank", (F.col("place") + F.col("offset")).alias("round"), "slot"
    )


def _offsets(sums: DataFrame, keys: list[str], run: str, value: str, width_of: int) -> DataFrame:
    """Adds ``offset``, the sum of ``value`` over the earlier runs of the same keys.

    In two levels, so that no window holds more than ``width_of`` rows while runs
    stay below its square.
    """
    top = F.floor(F.col(run) / width_of)
    sums = sums.withColumn("top", top)
    before = Window.partitionBy(*keys, "top").orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("near", F.coalesce(F.sum(value).over(before), F.lit(0)))
    tops = sums.groupBy(*keys, "top").agg(F.sum(value).alias("top_sum"))
    before = Window.partitionBy(*keys).orderBy("top").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.withColumn("far", F.coalesce(F.sum("top_sum").over(before), F.lit(0)))
    joined = sums.join(tops.select(*keys, "top", "far"), [*keys, "top"])
    return joined.select(*keys, run, (F.col("near") + F.col("far")).alias("offset"))


def _placed(units: DataFrame, seed: int) -> DataFrame:
    """Adds ``start``: where the copies of a document begin in its source's shuffled word stream."""
    order = F.xxhash64(F.lit(seed), "doc_id", "size", "text_hash")
    docs = units.filter("size > 0").withColumn("order", order).withColumn("words", F.col("size") * F.col("copies"))
    docs = docs.withColumn("run", F.shiftrightunsigned("order", 64 - 14))
    own = Window.partitionBy("rank", "run").orderBy("order", "doc_id", "size", "text_hash")
    docs = docs.withColumn(
        "near_start", F.coalesce(F.sum("words").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    runs = docs.groupBy("rank", "run").agg(F.sum("words").alias("words"))
    runs = _offsets(runs, ["rank"], "run", "words", width_of=FAN)
    return docs.drop("words").join(runs, ["rank", "run"]).withColumn("start", F.col("near_start") + F.col("offset"))


def _copies(units: DataFrame) -> DataFrame:
    """A row per copy, each with its own start. Many copies go to tasks in runs of ``COPIES``."""
    last = F.col("copies") - 1
    runs = units.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(COPIES).cast("long"))))
    runs = runs.repartition(partitions(units.sparkSession))
    copy = F.explode(F.sequence("from", F.least(F.col("from") + (COPIES - 1), last)))
    rows = runs.withColumn("copy", copy)
    return rows.select(
        "doc_id", "source", "rank", "size", "source_size", "target",
        (F.col("start") + F.col("copy") * F.col("size")).alias("start"),
    )


def _mix(
    docs: DataFrame, weights, share: float, repeats: int, block_words: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """(rows, pieces): every row of ``docs`` with its start, null without words, and its pieces with their slots."""
    units = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash")
    )
    # equal rows are one until they are dealt, so that however many there are they share no window
    units = units.groupBy("doc_id", "source", "size", "text_hash").agg(F.count("*").alias("copies"))
    units = written(units, "mix-sizes")
    sizes = units.select("source", (F.col("size") * F.col("copies")).alias("size"))
    targets = written(source_targets(sizes, weights, share, repeats), "mix-targets")
    known = targets.withColumnRenamed("source", "name")
    sized = units.join(known, F.col("source").eqNullSafe(F.col("name"))).drop("name", "weight")
    empty = sized.filter("size = 0").withColumn("start", F.lit(None).cast("long"))
    columns = [*sized.columns, "start"]
    rows = written(_copies(_placed(sized, seed).select(*columns).unionAll(empty.select(*columns))), "mix-rows")

    # the stream of a source ends at its target; a document is met once per pass
    taken = F.round("target").cast("long")
    passes = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    met = rows.filter("size > 0").withColumn("pass", passes)
    met = met.withColumn("at", F.col("start") + F.col("pass") * F.col("source_size"))
    met = met.withColumn("end", F.least(F.col("at") + F.col("size"), taken)).filter("at < end")
    block = F.lit(block_words)
    met = met.withColumn(
        "round", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("end") - 1) / block)))
    )
    first = F.greatest(F.col("at"), F.col("round") * block)
    last = F.least(F.col("end"), (F.col("round") + 1) * block)
    pieces = met.withColumns({"from_word": first - F.col("at"), "words": last - first})
    # planned on its own: in one plan with the pieces it would take much of the driver's memory;
    # merged at every size: its files are much smaller than its rows, which are not to be broadcast
    slots = written(schedule(targets, block_words), "mix-schedule").hint("merge")
    pieces = pieces.join(slots, ["rank", "round"], "left")
    return rows, pieces.select(*rows.columns, "slot", "pass", "from_word", "words")


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """(pieces, sizes) of a mix of ``docs`` (doc_id, text, source and any other columns).

    ``pieces``: one row for each stretch of a document in a block of the mix:
    doc_id, source, slot (place in the schedule), pass (0 for the first reading of
    the document), from_word and words. A source gives its target rounded to whole
    words. Blocks beyond the last slot of their source (the schedule may give it a
    few too few) follow behind the schedule, slot null; slots beyond its last
    block stay unused. ``sizes``: doc_id, source, size, source_size, target of every row.

    Null or empty texts have size 0 and no piece; a null source is a source, last in
    order; a null doc_id is an id like any other; repeated rows are documents of
    their own. An empty table gives empty results. Other columns are not looked at.
    """
    rows, pieces = _mix(docs, weights, share, repeats, block_words, seed)
    return (
        pieces.select("doc_id", "source", "slot", "pass", "from_word", "words"),
        rows.select("doc_id", "source", "size", "source_size", "target"),
    )


def mixed_documents(
    docs: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_slot, n_slots of every row of ``docs``.

    ``taken`` are the words that the mix takes of the document, ``n_slots`` the slots of
    the schedule that hold them and ``first_slot`` the first of these in the mix, null if
    none does. Rules for odd rows are those of ``mix``.
    """
    rows, pieces = _mix(docs, weights, share, repeats, block_words, seed)
    own = ["doc_id", "source", "rank", "size", "source_size", "target", "start"]  # a start is no other row's
    none = rows.filter("size > 0").select(*own, F.lit(None).cast("long").alias("slot"), F.lit(0).cast("long").alias("words"))
    met = pieces.select(*own, "slot", F.col("words").cast("long").alias("words")).unionAll(none)
    found = met.groupBy(*own).agg(
        F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.count_distinct("slot").alias("n_slots")
    )
    columns = ["doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots"]
    zero = F.lit(0).cast("long")
    empty = rows.filter("size = 0").withColumns({"taken": zero, "first_slot": F.lit(None).cast("long"), "n_slots": zero})
    return found.select(*columns).unionAll(empty.select(*columns))


def query(spark, sf_dir: str) -> DataFrame:
    return mixed_documents(table(spark, sf_dir, "documents"))
