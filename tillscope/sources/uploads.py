"""Many uploaded CSV files, each with a header of its own, in one job.

The first lines of all files are read once. Headers are few, however many files there
are: each distinct one is matched to the known fields, which gives a small table of
places of cells. Rows meet it by their file, cells are taken by place, and all figures
are grouped by file.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.functions.cancellations import by_negative_quantity
from tillscope.functions.columns import any_of, count_where, na_to_null, stripped
from tillscope.functions.dates import DATE_FORMATS, parse_stripped
from tillscope.functions.headers import detect_columns, field_coverage
from tillscope.functions.numbers import quality_score, stripped_number
from tillscope.operators.quality import missing_upload_columns
from tillscope.schemas import NA_TOKENS, UPLOAD_ALIASES
from tillscope.session import stored
from tillscope.sources.files import RECORD, _longer
from tillscope.sources.records import csv_records, placed_lines

#: Different headers of one folder at most: each is matched by the driver.
MOST_HEADERS = 10_000

_LAYOUT = (
    "header string, width int, mapped int, missing array<string>, complete boolean, "
    + ", ".join(f"{field} int" for field in UPLOAD_ALIASES)
)


def header_names(header: str) -> list[str]:
    """Column names of a header line; nameless ones are named by their place."""
    names = next(csv.reader([header]))
    return [n or f"_c{i}" for i, n in enumerate(names)]


def layout(header: str) -> tuple:
    """What a header says: its width, its known fields, and the place of each upload field or None."""
    names = header_names(header)
    found = detect_columns(names)
    coverage = field_coverage(names)
    places = [len(names) - 1 - names[::-1].index(found[f]) if f in found else None for f in UPLOAD_ALIASES]
    lacking = [label for label, c in coverage.items() if c is None]
    complete = not missing_upload_columns(names, need_customer=False)
    return (header, len(names), len(coverage) - len(lacking), lacking, complete, *places)


def file_layouts(spark: SparkSession, lines: DataFrame) -> tuple[DataFrame, int]:
    """((file, first, layout columns), greatest width) from the first record of every CSV file."""
    # numbers only until the places are known: aggregates of texts would sort all lines
    splits = lines.groupBy("file", "block").agg(F.min("row").alias("row"))
    splits = splits.where(F.lower("file").endswith(".csv"))
    first = stored(splits.groupBy("file").agg(F.min(F.struct("block", "row")).alias("first")), "first-places")
    place = first.select("first", F.col("file").alias("f"), F.col("first.block").alias("b"), F.col("first.row").alias("r"))
    met = lines.join(place, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")) & (F.col("row") == F.col("r")))
    heads = stored(met.select("file", "first", F.col("record").alias("header")), "headers")
    known = [r["header"] for r in heads.select("header").distinct().limit(MOST_HEADERS + 1).collect()]
    if len(known) > MOST_HEADERS:
        raise ValueError(f"More than {MOST_HEADERS} different headers")
    layouts = [layout(h) for h in known]
    table = spark.createDataFrame(layouts, _LAYOUT)
    return stored(heads.join(table, "header"), "layouts"), max((row[1] for row in layouts), default=1)


def _plain(file: Column) -> Column:
    """One spelling of a path: listings and rows differ in the slashes behind the scheme."""
    return F.regexp_replace(file, "^([a-z0-9]+):/+", "$1:/")


def upload_reports(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A quality report per file of ``path`` (a glob or folder), whatever their headers.

    file, status, and the figures of ``csv_quality``. A file that can't be used has a
    status and no figures, and doesn't stop the others: ``not_csv`` by its name,
    ``empty`` without a header, ``too_long`` with a row of more cells than its header.
    Every file has its own date format, the one that fits most of its dates.
    """
    # the listing that the driver makes of any path it reads; it names empty files too
    listed = spark.createDataFrame([(f,) for f in spark.read.text(path).inputFiles()], "file string")
    listed = listed.select(_plain(F.col("file")).alias("file"))
    if multi_line:
        lines = stored(csv_records(spark, path), "records")
    else:
        lines = placed_lines(spark, path).withColumnRenamed("line", "record").where(F.trim("record") != "")
    # lines keep the spelling that they come with; only files are spelled anew
    named = F.lower("file").endswith(".csv")
    layouts, width = file_layouts(spark, lines)
    columns = [f"c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, RECORD]])
    # what the parser keeps of a row that doesn't have as many cells as the widest header
    parsed = F.from_csv("record", schema.toDDL(), {"escape": '"', "columnNameOfCorruptRecord": RECORD})
    rows = lines.join(layouts, "file").where(F.struct("block", "row") != F.col("first")).withColumn("parsed", parsed)
    cells = F.array(*[na_to_null(F.col(f"parsed.{c}"), NA_TOKENS) for c in columns])
    beyond = F.slice(F.array(*[f"parsed.{c}" for c in columns]), F.col("width") + 1, F.lit(width))
    too_long = F.exists(beyond, lambda c: F.coalesce(F.trim(c), F.lit("")) != "") | _longer(F.col(f"parsed.{RECORD}"), width)
    own = ["file", "width", "mapped", "missing", "complete", *UPLOAD_ALIASES]
    # equal rows of a file merge before they move; a file with most rows is met in parts
    copies = rows.groupBy("file", cells.alias("cells")).agg(F.count("*").alias("copies"), F.max(F.coalesce(too_long, F.lit(False))).alias("long"))
    flat = copies.join(layouts.select(*own), "file")
    values = {field: F.get("cells", F.col(field)) for field in UPLOAD_ALIASES}
    # one look at each row: which date formats fit it (a bit each), and its other faults; rows of a file that
    # agree in them are one row from here on, whatever format the file turns out to have
    cut = flat.select(
        "file", "copies", "long", "complete",
        any_of([values[f].isNull() for f in ("order_id", "product")]).alias("no_name"),
        *[stripped(values[f]).alias(f) for f in ("date", "quantity", "unit_price")],
    )
    numbers = cut.select(
        "file", "copies", "long", "complete", "no_name", "date",
        *[stripped_number(F.col(f)).alias(f) for f in ("quantity", "unit_price")],
    )
    fitting = reduce(
        Column.bitwiseOR,
        [F.when(parse_stripped(F.col("date"), f).isNotNull(), 1 << i).otherwise(0) for i, f in enumerate(DATE_FORMATS)],
    )
    seen = numbers.select(
        "file", "copies", "long", "complete", "no_name",
        F.when(F.col("complete") & F.col("date").isNotNull(), fitting).otherwise(0).alias("fitting"),
        (F.col("quantity").isNull() | F.col("unit_price").isNull()).alias("bad_number"),
        by_negative_quantity(F.col("quantity")).alias("cancelled"),
    )
    kinds = ("complete", "fitting", "no_name", "bad_number", "cancelled")
    amount = F.col("copies")
    kinds_of_rows = stored(
        seen.groupBy("file", *kinds).agg(
            F.sum("copies").alias("copies"), F.sum(amount - 1).alias("again"), F.max("long").alias("long")
        ),
        "upload-kinds",
    )

    fits = [F.sum(F.when(F.getbit("fitting", F.lit(i)) == 1, amount).otherwise(0)) for i in range(len(DATE_FORMATS))]
    counted = kinds_of_rows.where("complete").groupBy("file").agg(F.array(*fits).alias("fits"))
    best = counted.select("file", (F.array_position("fits", F.array_max("fits")) - 1).cast("int").alias("format"))
    typed = kinds_of_rows.join(best, "file", "left").withColumn(
        "bad_date", F.coalesce(F.getbit("fitting", F.col("format")) == 0, F.lit(True))
    )
    checked = {
        "incomplete": any_of([F.col("no_name"), F.col("bad_date"), F.col("bad_number")]),
        "invalidDates": F.col("bad_date"),
        "invalidNumbers": F.col("bad_number"),
        "cancellations": F.col("cancelled"),
    }
    figures = typed.groupBy("file").agg(
        F.sum("copies").alias("rows"),
        F.sum("again").alias("duplicateRows"),
        F.max("long").alias("long"),
        *[count_where(F.col("complete") & c, amount).alias(n) for n, c in checked.items()],
    )
    plain = _plain(F.col("file")).alias("file")
    heads = layouts.select(plain, "width", "mapped", "missing", "complete")
    figures = figures.select(plain, *[c for c in figures.columns if c != "file"])
    report = listed.join(heads, "file", "left").join(figures, "file", "left")
    status = (
        F.when(~named, "not_csv").when(F.col("width").isNull(), "empty")
        .when(F.coalesce("long", F.lit(False)), "too_long").otherwise("ok")
    )
    usable = F.col("status") == "ok"
    zero = F.lit(0).cast("long")
    number = {n: F.coalesce(F.col(n), zero) for n in ("rows", "incomplete", "duplicateRows", "invalidDates", "invalidNumbers", "cancellations")}
    score = F.when(F.col("complete"), quality_score(number["rows"], number["incomplete"]))
    return report.withColumn("status", status).select(
        "file",
        "status",
        F.when(usable, number["rows"]).alias("rows"),
        F.when(usable, F.col("width")).alias("columns"),
        F.when(usable, F.col("mapped")).alias("mapped"),
        F.when(usable, F.col("missing")).alias("missing"),
        *[F.when(usable, number[n]).alias(n) for n in ("incomplete", "duplicateRows", "invalidDates", "invalidNumbers", "cancellations")],
        F.when(usable, score).alias("quality"),
    )
