"""CSV records with line breaks inside quotes, read in splits.

A line alone doesn't tell whether it begins inside quotes, but it tells where it would
end if it did and if it didn't. Each line is thus one of four maps of "inside quotes":
it opens or closes them whatever came before, keeps them, or turns them over. A scan
over the lines of a split and one over the splits of a file, of which each is one row,
give the state that every line begins in. Lines that begin outside begin a record;
records of one line stay where they are, only the lines of longer ones are put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Lines in one record at most; more mean a quote that is never closed.
MOST_LINES = 100_000
#: A whole quoted cell at the start of a cell, and the rest of one that is open.
_QUOTED = r'(?<![^,])"[^"]*+(?:""[^"]*+)*+"'
_CLOSED = r'^[^"]*+(?:""[^"]*+)*+"'


def _opens(line: Column) -> Column:
    """Whether a line that begins a cell ends inside quotes."""
    return F.regexp_replace(line, _QUOTED, "x").rlike(r'(?<![^,])"')


def _stays(line: Column) -> Column:
    """Whether a line that begins inside quotes ends inside quotes."""
    return ~line.rlike(_CLOSED) | _opens(F.regexp_replace(line, _CLOSED, "x"))


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, row, line: the lines of text files with their place, which orders them."""
    lines = spark.read.option("lineSep", "\n").text(path)
    value = F.col("value")
    marked = value.contains("\r") | value.startswith("\ufeff")  # few lines need the pattern
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.when(marked, F.regexp_replace(value, r"^\ufeff|\r$", "")).otherwise(value).alias("line"),
    )


def _scanned(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds ``fixed`` (the state before a row, where the rows before settle it) and ``odd`` (whether
    they turn it over since) to rows with the maps ``opens`` and ``stays``."""
    own = Window.partitionBy(*keys).orderBy(order)
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.when(F.col("opens") & ~F.col("stays"), 1).otherwise(0)
    rows = rows.withColumn("turns", F.coalesce(F.sum(turns).over(before), F.lit(0)))
    settled = F.when(F.col("opens") == F.col("stays"), F.struct("opens", "turns"))
    rows = rows.withColumn("last", F.last(settled, ignorenulls=True).over(before))
    since = F.col("turns") - F.coalesce(F.col("last.turns"), F.lit(0))
    return rows.withColumns({"fixed": F.col("last.opens"), "odd": since % 2 == 1}).drop("turns", "last")


def _inside(start: Column) -> Column:
    """The state before a row, for a scan that begins with ``start``."""
    return F.coalesce(F.col("fixed"), start) != F.col("odd")


def _after(inside: Column) -> Column:
    return F.when(inside, F.col("stays")).otherwise(F.col("opens"))


def csv_records(spark: SparkSession, path: str, most_lines: int = MOST_LINES) -> DataFrame:
    """file, block, row, record: the records of CSV files, place by place, without blank ones.

    A record has its lines joined by line feeds and the place of its first line. The
    first record of a file is its header and stays in. No task reads more than its
    splits; a record of more than ``most_lines`` lines fails.
    """
    lines = placed_lines(spark, path)
    lines = lines.withColumns({"opens": _opens(F.col("line")), "stays": _stays(F.col("line"))})
    scanned = _scanned(lines, ["file", "block"], "row")

    # one row per split: where it ends and where its last record begins, for both states it may begin in
    both = scanned.select(
        "file", "block", "row", *(
            c for name, start in (("outside", False), ("within", True))
            for c in (
                _inside(F.lit(start)).alias(f"{name}_inside"),
                _after(_inside(F.lit(start))).alias(f"{name}_after"),
            )
        ),
    )
    splits = both.groupBy("file", "block").agg(
        F.max_by("outside_after", "row").alias("opens"),
        F.max_by("within_after", "row").alias("stays"),
        F.max(F.when(~F.col("outside_inside"), F.col("row"))).alias("outside_row"),
        F.max(F.when(~F.col("within_inside"), F.col("row"))).alias("within_row"),
    )
    splits = _scanned(splits, ["file"], "block").withColumn("start", _inside(F.lit(False)))
    begun = F.when(F.col("start"), F.col("within_row")).otherwise(F.col("outside_row"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    open_record = F.last(F.when(begun.isNotNull(), F.struct(F.col("block"), begun.alias("row"))), ignorenulls=True).over(earlier)
    splits = splits.select(F.col("file").alias("f"), F.col("block").alias("b"), "start", open_record.alias("open_record"))

    same = (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))
    met = scanned.join(splits, same).withColumn("inside", _inside(F.col("start"))).withColumn("after", _after(F.col("inside")))
    single = met.where(~F.col("inside") & ~F.col("after")).select("file", "block", "row", F.col("line").alias("record"))
    own = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.last(F.when(~F.col("inside"), F.struct("block", "row")), ignorenulls=True).over(own)
    parts = met.withColumn("first", F.coalesce(first, F.col("open_record"))).where(F.col("inside") | F.col("after"))
    joined = parts.groupBy("file", "first").agg(
        F.count("*").alias("lines"), F.sort_array(F.collect_list(F.struct("block", "row", "line"))).alias("parts")
    )
    too_many = F.raise_error(F.lit(f"The CSV could not be parsed: a record has more than {most_lines} lines"))
    text = F.array_join(F.transform("parts", lambda p: p["line"]), "\n")
    longer = joined.select(
        "file", "first.block", "first.row", F.when(F.col("lines") <= most_lines, text).otherwise(too_many.cast("string")).alias("record")
    )
    return single.unionAll(longer).where(F.col("record") != "")


def without_headers(records: DataFrame) -> DataFrame:
    """The records but for the first of every file."""
    first = records.groupBy(F.col("file").alias("f")).agg(F.min(F.struct("block", "row")).alias("first"))
    head = (F.col("file") == F.col("f")) & (F.struct("block", "row") == F.col("first"))
    return records.join(first, head, "left_anti")
