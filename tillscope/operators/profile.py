"""Profiling of raw rows before and after cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.functions.cancellations import by_invoice_prefix
from tillscope.functions.columns import named
from tillscope.functions.dates import epoch_seconds, from_epoch_seconds
from tillscope.operators.quantiles import quantiles_of, value_counts
from tillscope.session import stored
from tillscope.sources.files import PLACE, first_rows


PRINT, REPEATED = "_fingerprint", "_repeated"
PLACE_BIT, BUCKET, BITMAP = "_fingerprint_bit", "_fingerprint_bucket", "_fingerprint_bitmap"
#: Fingerprints that are sent to every executor at most, 8 bytes each.
FEW_FINGERPRINTS = 500_000
#: Bits for each of more fingerprints than that, and bits at most: 32 MB.
PRINT_BITS, MOST_BITS = 16, 1 << 28


def dtypes(df: DataFrame) -> DataFrame:
    """Column names and types, in file order."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) from one pass over the rows."""
    counted = df.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.count_if(named(c).isNull()).alias("nulls"))
                for c in df.columns
            ]
        ).alias("cells")
    )
    return counted.select(F.inline("cells"))


def row_copies(df: DataFrame, name: str = "copies") -> DataFrame:
    """Each distinct row with its number of copies; null equals null.

    Copies merge before the shuffle, so a row repeated a billion times moves once
    per task.
    """
    return df.groupBy(*[named(c) for c in df.columns]).agg(F.count("*").alias(name))


def fingerprint(df: DataFrame) -> Column:
    """64 bits of a row: its cells, and which of them are null."""
    cells = [named(c) for c in df.columns]
    return F.xxhash64(*cells, *[c.isNull() for c in cells])


def _bits_for(prints: int) -> int:
    """A power of two of bits, whole bitmaps of Spark (32,768 bits), at least ``PRINT_BITS`` a fingerprint."""
    return min(max(1 << (prints * PRINT_BITS - 1).bit_length(), 1 << 15), MOST_BITS)


def _maybe_repeated(marked: DataFrame, repeated: DataFrame, prints: int) -> DataFrame:
    """Rows whose fingerprint has its bit set by the ``repeated`` ones: all rows of these, and few others."""
    bits = _bits_for(prints)
    bit = lambda value: F.pmod(F.xxhash64(value), F.lit(bits))
    found = repeated.select(bit(F.col(REPEATED)).alias(PLACE_BIT))
    maps = found.groupBy(F.bitmap_bucket_number(PLACE_BIT).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(PLACE_BIT)).alias(BITMAP)
    )
    place = F.bitmap_bit_position(PLACE_BIT)
    byte = F.conv(F.hex(F.substring(BITMAP, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    placed = marked.withColumn(PLACE_BIT, bit(F.col(PRINT)))
    # at most 8,192 maps of 4 kB, whatever the number of fingerprints
    met = placed.join(F.broadcast(maps), F.bitmap_bucket_number(PLACE_BIT) == F.col(BUCKET))
    return met.where(F.getbit(byte, (place % 8).cast("int")) == 1).drop(PLACE_BIT, BUCKET, BITMAP)


def duplicate_count(df: DataFrame, few: int = FEW_FINGERPRINTS) -> DataFrame:
    """Rows that repeat an earlier row.

    Rows move as fingerprints, whatever their width. Only rows whose fingerprint
    occurs twice are compared cell by cell, and equal ones merge before they move.
    They are picked by the list of these fingerprints, or, with more than ``few`` of
    them, by bitmaps of the list, which let some other rows through. ``df`` is read
    twice: store it first if it is dear to make.
    """
    marked = df.withColumn(PRINT, fingerprint(df))
    counts = marked.groupBy(PRINT).agg(F.count("*").alias("rows")).where("rows > 1")
    repeated = stored(counts.select(F.col(PRINT).alias(REPEATED)), "fingerprints")
    prints = repeated.count()
    if prints <= few:
        picked = marked.join(F.broadcast(repeated), F.col(PRINT) == F.col(REPEATED), "left_semi")
    else:
        picked = _maybe_repeated(marked, repeated, prints)
    extra = row_copies(picked.drop(PRINT), "_copies").agg(F.sum(F.col("_copies") - 1).alias("duplicates"))
    return extra.select(F.coalesce("duplicates", F.lit(0)).cast("bigint").alias("duplicates"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column; exact quartiles.

    The rows are read once: everything comes from their value counts. The mean of
    integers and decimals is exact, so it does not depend on the order of rows.
    """
    columns = columns or numeric_columns(df)
    counts = stored(value_counts(df, columns), "value-counts")
    rows = F.sum("n")
    exact = F.try_sum(F.col("exact") * F.col("n")).cast("double") / rows
    moments = counts.groupBy("column").agg(
        rows.alias("count"),
        F.coalesce(exact, F.sum(F.col("value") * F.col("n")) / rows).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    moments = stored(moments, "moments")
    # both sides have one row per profiled column
    means = F.broadcast(moments.select("column", "count", "mean"))
    off = F.col("value") - F.col("mean")
    spread = counts.join(means, "column").groupBy("column").agg(
        F.sqrt(F.try_divide(F.sum(off * off * F.col("n")), F.max("count") - 1)).alias("std")
    )
    quartiles = (
        quantiles_of(counts, [0.25, 0.5, 0.75])
        .groupBy("column")
        .agg(
            *[
                F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
                for p, name in [(0.25, "q25"), (0.5, "q50"), (0.75, "q75")]
            ]
        )
    )
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    for part in (moments, spread, quartiles):
        every = every.join(F.broadcast(part), "column", "left")
    return every.select(
        "column", F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def describe_times(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same for zone-free timestamps, which have no standard deviation."""
    seconds = df.select(*[epoch_seconds(named(c)).alias(c) for c in columns])
    points = ["mean", "min", "q25", "q50", "q75", "max"]
    return describe(seconds, columns).select(
        "column", "count", *[from_epoch_seconds(F.col(p)).alias(p) for p in points]
    )


def flag_counts(flags: DataFrame, flag: str) -> DataFrame:
    """How often each value of a flag occurs, most frequent first, without nulls."""
    return (
        flags.where(named(flag).isNotNull())
        .groupBy(named(flag).alias(flag))
        .agg(F.count("*").alias("rows"))
        .orderBy(F.desc("rows"), F.asc(flag))
    )


def cancellation_flags(raw: DataFrame) -> DataFrame:
    return flag_counts(raw.select(by_invoice_prefix(named("InvoiceNo")).alias("is_cancellation")), "is_cancellation")


def cancelled_rows(raw: DataFrame) -> DataFrame:
    return raw.where(by_invoice_prefix(named("InvoiceNo")))


def cancellation_sample(raw: DataFrame, rows: int = 5) -> DataFrame:
    """The first cancelled rows; in the order of the file where rows have their place."""
    return first_rows(cancelled_rows(raw), rows)


def price_sign_counts(raw: DataFrame) -> DataFrame:
    price = named("UnitPrice")
    return raw.agg(
        F.count_if(price < 0).alias("negative_prices"),
        F.count_if(price == 0).alias("zero_prices"),
        F.count_if(price > 0).alias("positive_prices"),
    )


def negative_price_rows(raw: DataFrame) -> DataFrame:
    return raw.where(named("UnitPrice") < 0)


def zero_price_rows(raw: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows without a price, in the order of their cells."""
    order = [named(c).asc_nulls_last() for c in raw.columns]
    return raw.where(named("UnitPrice") == 0).orderBy(*order).limit(rows)


def extreme_revenue(priced: DataFrame, threshold: int = 10000, rows: int = 10) -> DataFrame:
    """Rows of the largest revenue by amount, in a fixed order."""
    columns = ["InvoiceNo", "StockCode", "Quantity", "UnitPrice", "Revenue"]
    return (
        priced.where(F.abs("Revenue") > threshold)
        .select(*columns)
        .orderBy(F.abs("Revenue").desc(), *[F.asc_nulls_last(c) for c in columns])
        .limit(rows)
    )


def _counts(df: DataFrame, flag: Column, prices: list[tuple[str, Column]]) -> DataFrame:
    """One row with every count of a profile: rows, nulls, flags and price signs, from one pass."""
    price = named("UnitPrice")
    signs = {"negative_prices": price < 0, "zero_prices": price == 0, "positive_prices": price > 0}
    nulls = [F.struct(F.lit(c).alias("column"), F.count_if(named(c).isNull()).alias("nulls")) for c in df.columns]
    flags = [F.struct(F.lit(v).alias("flag"), F.count_if(flag == v).alias("rows")) for v in (False, True)]
    kept = [
        F.struct(F.count_if(among).alias("rows"), *[F.count_if(among & sign).alias(n) for n, sign in signs.items()]).alias(name)
        for name, among in prices
    ]
    return stored(df.agg(F.count("*").alias("rows"), F.array(*nulls).alias("nulls"), F.array(*flags).alias("flags"), *kept), "profile")


def _flags(counts: DataFrame, name: str) -> DataFrame:
    shown = counts.select(F.inline("flags")).where(F.col("rows") > 0)
    return shown.select(F.col("flag").alias(name), "rows").orderBy(F.desc("rows"), F.asc(name))


def profile_raw(raw: DataFrame, head: int = 5) -> dict[str, DataFrame]:
    """Every part of the raw-data profile. Counts and value counts are taken at once and stored.

    Heads are the first rows of the file if ``raw`` was read with its place.
    """
    placed, raw = raw, raw.drop(PLACE)
    cancelled = cancelled_rows(raw)
    times = [f.name for f in raw.schema if isinstance(f.dataType, T.TimestampNTZType)]
    counts = _counts(raw, by_invoice_prefix(named("InvoiceNo")), [])
    described = describe(cancelled, ["Quantity", "UnitPrice"])
    parts = {
        "head": first_rows(placed, head),
        "shape": counts.select("rows", F.lit(len(raw.columns)).alias("columns")),
        "dtypes": dtypes(raw),
        "nulls": counts.select(F.inline("nulls")),
        "duplicates": duplicate_count(raw),
        "describe": describe(raw),
        "cancellation_flags": _flags(counts, "is_cancellation"),
        "cancellation_sample": cancellation_sample(placed),
        "cancelled_quantity": described.where(F.col("column") == "Quantity"),
        "cancelled_price": described.where(F.col("column") == "UnitPrice"),
    }
    if times:
        parts["describe_times"] = describe_times(raw, times)
    return parts


def profile_cleaning(priced: DataFrame) -> dict[str, DataFrame]:
    """Diagnostics of a cleaning run, from before and after the price filter.

    The priced rows are deduplicated and stored once; all counts come from one pass
    over them.
    """
    head = first_rows(priced, 5)
    priced = stored(priced.drop(PLACE), "priced")
    every, sellable = F.lit(True), named("UnitPrice") > 0
    counts = _counts(priced, named("IsCancellation"), [("before", every), ("after", F.coalesce(sellable, F.lit(False)))])
    signs = ("negative_prices", "zero_prices", "positive_prices")
    columns = F.lit(len(priced.columns)).alias("columns")
    return {
        "head": head,
        "shape": counts.select("rows", columns),
        "dtypes": dtypes(priced),
        "nulls": counts.select(F.inline("nulls")),
        "price_signs": counts.select(*[f"before.{s}" for s in signs]),
        "cancellation_flags": _flags(counts, "IsCancellation"),
        "revenue": describe(priced, ["Revenue"]),
        "negative_prices": negative_price_rows(priced),
        "zero_prices": zero_price_rows(priced),
        "extreme_revenue": extreme_revenue(priced),
        "rows_remaining": counts.select("after.rows", columns),
        "price_signs_after": counts.select(*[f"after.{s}" for s in signs]),
    }
