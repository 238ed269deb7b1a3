"""Exact quantiles of any number of columns without sorting them in one place.

Spark's exact ``percentile`` keeps every distinct value of a column in a single
aggregation buffer. Here equal values are counted first. A range of values that
holds a wanted position is split, at rough quantiles of its own, until it has few
enough distinct values for one task to put in order. Rough bounds make parts
uneven, never wrong, and the number of rounds is the logarithm of the values.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.functions.columns import named
from tillscope.session import stored

# A range is split into FAN * FAN parts, found in two steps of FAN comparisons.
FAN = 16
# Distinct values that one task puts in order. Only how the work is parted depends on it.
SORTED_VALUES = 100_000

EXACT = T.DecimalType(28, 8)


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, exact, n) of all present values, equal values already merged.

    ``exact`` is the value as a decimal, null in columns of doubles and floats.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    floating = (T.DoubleType, T.FloatType)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                named(c).cast("double").alias("value"),
                (F.lit(None) if isinstance(kinds[c], floating) else named(c)).try_cast(EXACT).alias("exact"),
            )
            for c in columns
        ]
    )
    present = df.select(F.inline(cells)).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return present.groupBy("column", "value", "exact").agg(F.count("*").alias("n"))


@dataclass
class _Range:
    """Values in (low, high] of a column, open ends as None, that hold wanted positions."""

    column: str
    low: float | None
    high: float | None
    before: int
    distinct: int
    positions: list[int]
    least: float
    greatest: float


def _inside(counts: DataFrame, ranges: list[_Range]) -> DataFrame:
    """The counts in any of the ranges, with its number; a few ranges per profiled column."""
    rows = [(i, r.column, r.low, r.high) for i, r in enumerate(ranges)]
    table = counts.sparkSession.createDataFrame(rows, "range int, of string, low double, high double")
    held = (F.col("low").isNull() | (F.col("value") > F.col("low"))) & (
        F.col("high").isNull() | (F.col("value") <= F.col("high"))
    )
    return counts.join(F.broadcast(table), (F.col("column") == F.col("of")) & held).select("range", "value", "n")


def _split(counts: DataFrame, ranges: list[_Range], fan: int) -> list[_Range]:
    """The parts of the ranges that hold their positions; FAN * FAN rows per range reach the driver."""
    parts = fan * fan
    inside = _inside(counts, ranges)
    steps = F.expr("array(" + ", ".join(f"{i / parts!r}D" for i in range(1, parts)) + ")")
    bounds = inside.groupBy("range").agg(F.percentile_approx("value", steps, 10 * parts).alias("bounds"))
    every = F.transform(
        F.sequence(F.lit(fan), F.lit(fan * (fan - 1)), F.lit(fan)), lambda i: F.element_at("bounds", i)
    )
    bounds = stored(bounds.withColumn("coarse", every), "quantile-bounds")

    def below(candidates: Column) -> Column:
        return F.size(F.filter(candidates, lambda b: b < F.col("value")))

    placed = inside.join(F.broadcast(bounds), "range").withColumn("group", below(F.col("coarse")))
    part = F.col("group") * fan + below(F.slice("bounds", F.col("group") * fan + 1, fan))
    sizes = placed.groupBy("range", part.alias("part")).agg(
        F.sum("n").alias("rows"), F.count("*").alias("distinct"),
        F.min("value").alias("least"), F.max("value").alias("greatest"),
    )
    limits = {r["range"]: r["bounds"] for r in bounds.select("range", "bounds").collect()}
    found = []
    at = {i: r.before for i, r in enumerate(ranges)}
    for row in sorted(sizes.collect(), key=lambda r: (r["range"], r["part"])):
        old, edges, part = ranges[row["range"]], limits[row["range"]], row["part"]
        start = at[row["range"]]
        at[row["range"]] += row["rows"]
        wanted = [p for p in old.positions if start <= p < start + row["rows"]]
        if wanted:
            low = edges[part - 1] if part else old.low
            high = edges[part] if part < len(edges) else old.high
            found.append(
                _Range(old.column, low, high, start, row["distinct"], wanted, row["least"], row["greatest"])
            )
    return found


def _at_positions(counts: DataFrame, ranges: list[_Range]) -> dict[tuple[str, int], float]:
    """The values at the wanted positions, each range put in order by one task."""
    rows = [(i, p, r.before) for i, r in enumerate(ranges) for p in r.positions]
    wanted = counts.sparkSession.createDataFrame(rows, "range int, position bigint, before bigint")
    in_order = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = _inside(counts, ranges).withColumn("upto", F.sum("n").over(in_order))
    place = F.col("position") - F.col("before")
    hits = upto.join(F.broadcast(wanted), "range").where((place < F.col("upto")) & (place >= F.col("upto") - F.col("n")))
    return {(ranges[r["range"]].column, r["position"]): r["value"] for r in hits.select("range", "position", "value").collect()}


def quantiles_of(
    counts: DataFrame, probabilities: list[float], fan: int = FAN, sorted_values: int = SORTED_VALUES
) -> DataFrame:
    """(column, probability, value) from value counts that can be read again and again."""
    totals = counts.groupBy("column").agg(
        F.sum("n").alias("rows"), F.count("*").alias("distinct"),
        F.min("value").alias("least"), F.max("value").alias("greatest"),
    ).collect()
    spots, ranges = [], []
    for row in totals:
        positions = set()
        for p in probabilities:
            # exact: doubles lose units beyond 2^53
            position = (row["rows"] - 1) * Fraction(str(p))
            low = position.numerator // position.denominator
            spots.append((row["column"], p, low, float(position - low)))
            positions |= {low, low + (position != low)}
        ranges.append(
            _Range(row["column"], None, None, 0, row["distinct"], sorted(positions), row["least"], row["greatest"])
        )
    values, small = {}, []
    while ranges:
        # numbers that are one double are not told apart: such a range is settled
        for r in ranges:
            if r.least == r.greatest:
                values |= {(r.column, p): r.least for p in r.positions}
        ranges = [r for r in ranges if r.least != r.greatest]
        small += [r for r in ranges if r.distinct <= sorted_values]
        large = [r for r in ranges if r.distinct > sorted_values]
        ranges = _split(counts, large, fan) if large else []
    if small:
        values |= _at_positions(counts, small)
    result = []
    for column, p, low, part in spots:
        first = values[column, low]
        second = values[column, low + 1] if part else first
        result.append((column, p, first + (second - first) * part))
    return counts.sparkSession.createDataFrame(result, "column string, probability double, value double")


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    fan: int = FAN,
    sorted_values: int = SORTED_VALUES,
) -> DataFrame:
    """(column, probability, value), interpolated linearly between neighbours.

    ``df`` is read once; its value counts are a written table for the rounds to come.
    """
    return quantiles_of(stored(value_counts(df, columns), "value-counts"), probabilities, fan, sorted_values)
