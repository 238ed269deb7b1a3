"""File sources: the raw retail sheet and uploaded CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.functions.columns import na_to_null, named, stripped
from tillscope.functions.dates import infer_date_format, parse_timestamp
from tillscope.schemas import MESSAGES, NA_TOKENS, RAW_RETAIL
from tillscope.sources.records import csv_records, without_headers

RECORD = "_record"
PLACE = "_place"
PREVIEW_ROWS = 300


def read_raw_retail(
    spark: SparkSession, path: str, file_format: str = "csv", date_format: str | None = None, place: bool = False
) -> DataFrame:
    """The raw sheet, exported from its workbook to CSV or Parquet.

    ``place`` keeps the place of CSV rows in their file for the heads of a profile.

    CSV columns are found by name, in any order; a missing one is an error. Without a
    ``date_format`` the one that fits most dates is taken. Cells that do not parse are
    null; ``unparsed_cells`` counts them.
    """
    if file_format == "parquet":
        return spark.read.parquet(path)
    return typed_raw(read_csv_text(spark, path, place=place), date_format)


def _raw_values(text: DataFrame, date_format: str | None) -> dict[str, Column]:
    absent = [f.name for f in RAW_RETAIL if f.name not in text.columns]
    if absent:
        raise ValueError("The sheet lacks columns: " + ", ".join(absent))
    values = {}
    for field in RAW_RETAIL:
        cell = na_to_null(named(field.name), NA_TOKENS)
        if isinstance(field.dataType, T.TimestampNTZType):
            date_format = date_format or infer_date_format(text, field.name)
            values[field.name] = parse_timestamp(cell, date_format)
        elif isinstance(field.dataType, T.StringType):
            values[field.name] = cell
        elif isinstance(field.dataType, T.LongType):
            exact = stripped(cell).try_cast("decimal(38,10)")
            values[field.name] = F.when(exact == F.floor(exact), exact.try_cast("bigint"))
        else:
            values[field.name] = stripped(cell).try_cast(field.dataType)
    return values


def typed_raw(text: DataFrame, date_format: str | None = None) -> DataFrame:
    """Text cells of the raw sheet in its types; what does not parse is null."""
    kept = [c for c in text.columns if c == PLACE]
    return text.select(*[value.alias(name) for name, value in _raw_values(text, date_format).items()], *kept)


def unparsed_cells(text: DataFrame, date_format: str | None = None) -> DataFrame:
    """(column, cells): how many present cells of the raw sheet do not parse, in one pass."""
    counts = [
        F.struct(
            F.lit(name).alias("column"),
            F.count_if(na_to_null(named(name), NA_TOKENS).isNotNull() & value.isNull()).alias("cells"),
        )
        for name, value in _raw_values(text, date_format).items()
    ]
    return text.agg(F.array(*counts).alias("cells")).select(F.inline("cells"))


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line; the only part of a file read ahead."""
    if not path.lower().endswith(".csv"):
        raise ValueError(MESSAGES["not_csv"])
    columns = spark.read.option("header", True).option("escape", '"').csv(path).columns
    if not columns:
        raise ValueError(MESSAGES["no_header"])
    return columns


def _check_headers(spark: SparkSession, path: str) -> None:
    """Fails unless all files of a glob begin with the same line; reads one split of each."""
    lines = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"),
        F.regexp_replace("value", r"^\ufeff|\r$", "").alias("line"),
    )
    first = lines.where(F.trim("line") != "").groupBy("file").agg(F.min_by("line", "row").alias("header"))
    if len(first.select("header").distinct().limit(2).collect()) > 1:
        raise ValueError("The files have different headers")


def read_csv_text(spark: SparkSession, path: str, multi_line: bool = False, place: bool = False) -> DataFrame:
    """All cells as text. Short rows are padded with null, over-long rows fail.

    ``path`` is one file or a glob of files, which must share one header. Files are
    read in splits, also with ``multi_line``, which allows line breaks inside quotes
    (but not in the header). ``place`` adds the row's place in its file (``PLACE``), by
    which ``first_rows`` finds the first rows whatever the splits.
    """
    columns = csv_header(spark, path)
    if any(c in path for c in "*?[{"):
        _check_headers(spark, path)
    # The parser keeps the whole text of a row with fewer or more cells than the schema
    # in this column. It can only tell while it reads all columns.
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, RECORD]])
    options = {"escape": '"', "columnNameOfCorruptRecord": RECORD}
    if multi_line:
        records = without_headers(csv_records(spark, path))
        cells = F.from_csv("record", schema.toDDL(), options)
        rows = records.select(F.struct("file", "block", "row").alias(PLACE), cells.alias("cells"))
        rows = rows.select("cells.*", PLACE)
    else:
        rows = spark.read.schema(schema).options(**options).option("header", True).option("columnPruning", False).csv(path)
        rows = rows.withColumn(
            PLACE,
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ),
        )
    if not place:
        rows = rows.drop(PLACE)
    # A filter, unlike a checked column, cannot be pruned away. The length is always
    # enough; it is there because a query may not ask for that column alone.
    read = F.coalesce(F.length(named(columns[0])), F.lit(0)) >= 0
    too_long = F.raise_error(F.lit("The CSV could not be parsed: a row has more cells than the header"))
    fits = F.when(read & ~_longer(named(RECORD), len(columns)), F.lit(True))
    return rows.where(fits.otherwise(too_long.cast("boolean"))).drop(RECORD)


def first_rows(rows: DataFrame, count: int) -> DataFrame:
    """The first rows in the order of their files, without their place.

    Every task keeps that many of its own, so no file is sorted. Rows without a place
    have no order to go by.
    """
    if PLACE not in rows.columns:
        return rows.limit(count)
    return rows.orderBy(f"{PLACE}.file", f"{PLACE}.block", f"{PLACE}.row").limit(count).drop(PLACE)


def _longer(record: Column, width: int) -> Column:
    """Whether the text of a row has anything but blank cells behind its first ``width`` cells."""
    plain = F.regexp_replace(record, r'"[^"]*+(?:""[^"]*+)*+"', "x")
    return F.coalesce(plain.rlike(rf"(?s)^(?:[^,]*,){{{width}}}.*[^,\s]"), F.lit(False))


def read_upload(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """An uploaded CSV: text cells, with the usual spellings of a missing value as null."""
    return nulls_from_text(read_csv_text(spark, path, multi_line))


def nulls_from_text(rows: DataFrame) -> DataFrame:
    return rows.select(*[na_to_null(named(c), NA_TOKENS).alias(c) for c in rows.columns])


def preview_cell(column: Column) -> Column:
    return F.regexp_replace(stripped(F.coalesce(column, F.lit(""))), '^"|"$', "")


def preview_text(rows: DataFrame) -> DataFrame:
    """Cells as previewed: trimmed, without outer quotes, blank when missing."""
    return rows.select(*[preview_cell(named(c)).alias(c.strip()) for c in rows.columns])


def read_preview(spark: SparkSession, path: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of a CSV as previewed text."""
    return preview_text(first_rows(read_csv_text(spark, path, place=True), rows))
