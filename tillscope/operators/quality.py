"""Data-quality reports. The three reports call different rows incomplete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.functions.cancellations import by_negative_quantity, by_status_text
from tillscope.functions.columns import any_of, blank, count_where, named
from tillscope.functions.dates import infer_date_format, looks_like_date, parse_timestamp
from tillscope.functions.headers import detect_columns, field_coverage, preview_fields
from tillscope.functions.numbers import is_finite, quality_score, rounded_percent, to_number
from tillscope.operators.profile import row_copies
from tillscope.schemas import (
    MONEY,
    PASSING_SCORE,
    PREVIEW_REQUIRED,
    PRICE,
    QUANTITY,
    REQUIRED_COLUMNS,
    UPLOAD_ALIASES,
    VALIDATION_MESSAGES,
)
from tillscope.sources.tables import PUBLIC_TABLE, tenant_rows

COPIES = "_copies"


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def missing_upload_columns(columns: list[str], need_customer: bool = True) -> list[str]:
    """Canonical fields no header was detected for, in their fixed order."""
    detected = detect_columns(columns)
    return [
        f for f in UPLOAD_ALIASES if f not in detected and (need_customer or f != "customer_id")
    ]


def validation_report(standardized: DataFrame, allow_returns: bool = False) -> DataFrame:
    """(position, rule, message, rows) for the upload rules, from one pass.

    Infinity counts as missing. Numbers are also held against the decimal columns they
    will be stored in, their product included. ``allow_returns`` lets negative
    quantities through.
    """
    quantity, price = F.col("quantity"), F.col("unit_price")
    both = is_finite(quantity) & is_finite(price)
    too_large = (
        (is_finite(quantity) & quantity.try_cast(QUANTITY).isNull())
        | (is_finite(price) & price.try_cast(PRICE).isNull())
        | (both & F.col("revenue").try_cast(MONEY).isNull())
    )
    broken = {
        "order_id_missing": F.col("order_id").isNull(),
        "date_missing": F.col("date").isNull(),
        "quantity_missing": ~is_finite(quantity),
        "price_missing": ~is_finite(price),
        "quantity_not_positive": quantity == 0 if allow_returns else quantity <= 0,
        "price_not_positive": price <= 0,
        "number_not_stored": too_large,
    }
    counted = standardized.agg(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(rule).alias("rule"),
                    F.lit(message).alias("message"),
                    F.count_if(broken[rule]).alias("rows"),
                )
                for i, (rule, message) in enumerate(VALIDATION_MESSAGES.items())
            ]
        ).alias("cells")
    )
    return counted.select(F.inline("cells"))


def validation_errors(standardized: DataFrame, allow_returns: bool = False) -> list[str]:
    """Messages of the rules that any row breaks, in order; a row per rule reaches the driver."""
    report = validation_report(standardized, allow_returns)
    return [r["message"] for r in report.orderBy("position").collect() if r["rows"] > 0]


def csv_quality(raw: DataFrame, date_format: str | None = None) -> DataFrame:
    """One-row report on an uploaded frame.

    Equal rows are merged once, which gives the duplicates; every other figure is
    a property of the row and is weighted by its copies, so one pass serves all.
    """
    detected = detect_columns(raw.columns)
    coverage = field_coverage(raw.columns)
    complete_header = not missing_upload_columns(raw.columns, need_customer=False)
    copies = F.col(COPIES)
    none = F.lit(False)
    bad_date = bad_number = cancelled = incomplete = none
    if complete_header:
        date_format = date_format or infer_date_format(raw, detected["date"])
        date = parse_timestamp(named(detected["date"]), date_format)
        quantity = to_number(named(detected["quantity"]))
        price = to_number(named(detected["unit_price"]))
        bad_date = date.isNull()
        bad_number = quantity.isNull() | price.isNull()
        cancelled = by_negative_quantity(quantity)
        incomplete = any_of(
            [named(detected["order_id"]).isNull(), named(detected["product"]).isNull(), bad_date, bad_number]
        )
    # Flags are settled per distinct row before anything is summed, so that each
    # cell is parsed once.
    flagged = row_copies(raw, COPIES).select(
        COPIES,
        incomplete.alias("incomplete"),
        bad_date.alias("bad_date"),
        bad_number.alias("bad_number"),
        cancelled.alias("cancelled"),
    )
    counted = flagged.agg(
        count_where(F.lit(True), copies).alias("rows"),
        count_where(F.col("incomplete"), copies).alias("incomplete"),
        count_where(F.lit(True), copies - 1).alias("duplicateRows"),
        count_where(F.col("bad_date"), copies).alias("invalidDates"),
        count_where(F.col("bad_number"), copies).alias("invalidNumbers"),
        count_where(F.col("cancelled"), copies).alias("cancellations"),
    )
    score = quality_score(F.col("rows"), F.col("incomplete"))
    return counted.select(
        "rows",
        F.lit(len(raw.columns)).alias("columns"),
        F.lit(sum(c is not None for c in coverage.values())).alias("mapped"),
        _texts([label for label, c in coverage.items() if c is None]).alias("missing"),
        "incomplete",
        "duplicateRows",
        "invalidDates",
        "invalidNumbers",
        "cancellations",
        (score if complete_header else F.lit(None).cast("double")).alias("quality"),
    )


def preview_scan(rows: DataFrame) -> DataFrame:
    """One-row report on previewed rows, all cells being trimmed text or blank."""
    fields = preview_fields(rows.columns)
    copies = F.col(COPIES)
    every, none = F.lit(True), F.lit(False)

    def is_blank(label: str) -> Column:
        return blank(named(fields[label])) if fields[label] else every

    def filled(column: Column) -> Column:
        return F.coalesce(column != "", none)

    incomplete = any_of([is_blank(label) for label in PREVIEW_REQUIRED])
    bad_date = every
    if fields["Order date"]:
        date = named(fields["Order date"])
        bad_date = filled(date) & ~looks_like_date(date)
    numbers = [named(fields[label]) for label in ("Quantity", "Revenue") if fields[label]]
    bad_number = any_of([none] + [filled(c) & ~blank(c) & ~is_finite(to_number(c)) for c in numbers])
    flag = fields["Cancellation flag"]
    cancelled = by_status_text(named(flag)) if flag else none

    flagged = row_copies(rows, COPIES).select(
        COPIES,
        incomplete.alias("incomplete"),
        bad_date.alias("bad_date"),
        bad_number.alias("bad_number"),
        cancelled.alias("cancelled"),
    )
    counted = flagged.agg(
        count_where(every, copies).alias("rows"),
        count_where(F.col("incomplete"), copies).alias("incomplete"),
        count_where(every, copies - 1).alias("duplicateRows"),
        count_where(F.col("bad_date"), copies).alias("invalidDates"),
        count_where(F.col("bad_number"), copies).alias("invalidNumbers"),
        count_where(F.col("cancelled"), copies).alias("cancellations"),
    )
    good = F.col("rows") - F.col("incomplete") - F.col("invalidDates") - F.col("invalidNumbers")
    return counted.select(
        "rows",
        F.lit(len(rows.columns)).alias("columns"),
        F.lit(sum(c is not None for c in fields.values())).alias("mapped"),
        _texts([label for label, c in fields.items() if c is None]).alias("missing"),
        "incomplete",
        "duplicateRows",
        "invalidDates",
        "invalidNumbers",
        "cancellations",
        rounded_percent(good, F.col("rows")).alias("quality"),
    )


def table_health(rows: DataFrame, source_table: str = "transactions") -> DataFrame:
    """One-row health report on a fact table that exists."""
    missing = sorted(set(REQUIRED_COLUMNS) - set(rows.columns))
    if missing:
        return _unread_health(rows.sparkSession, "schema_incomplete", source_table, missing)
    lacking = any_of([F.col(c).isNull() for c in ("description", "invoice_date", "revenue")])
    counted = rows.agg(
        F.count("*").alias("rows_analyzed"),
        F.count_if(F.col("is_cancellation")).alias("cancellations"),
        F.count_if(lacking).alias("incomplete_rows"),
    )
    analyzed = F.col("rows_analyzed")
    return counted.select(
        F.when(analyzed > 0, "connected").otherwise("dataset_empty").alias("status"),
        F.lit(source_table).alias("source_table"),
        "rows_analyzed",
        F.lit(len(REQUIRED_COLUMNS)).alias("columns_mapped"),
        F.lit(len(REQUIRED_COLUMNS)).alias("columns_expected"),
        _texts([]).alias("missing_columns"),
        quality_score(analyzed, F.col("incomplete_rows")).alias("quality_score"),
        "cancellations",
        "incomplete_rows",
    )


def _unread_health(spark: SparkSession, status: str, source_table: str, missing: list[str]) -> DataFrame:
    row = (
        status, source_table, 0, len(REQUIRED_COLUMNS) - len(missing), len(REQUIRED_COLUMNS),
        missing, None, 0, 0,
    )
    return spark.createDataFrame(
        [row],
        "status string, source_table string, rows_analyzed bigint, columns_mapped int, "
        "columns_expected int, missing_columns array<string>, quality_score double, "
        "cancellations bigint, incomplete_rows bigint",
    )


def catalog_health(
    spark: SparkSession, table: str = PUBLIC_TABLE, owner_id: int | None = None
) -> DataFrame:
    """The health report by table name; a table that is not there is reported too."""
    if not spark.catalog.tableExists(table):
        return _unread_health(spark, "dataset_missing", table, sorted(REQUIRED_COLUMNS))
    rows = spark.table(table)
    return table_health(rows if owner_id is None else tenant_rows(rows, owner_id), table)


def owners_health(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """A health report per row of ``owners`` (owner_id), those without any row included.

    One aggregation that merges before it moves, so an owner with most rows is one row
    per task; the table of owners meets results of its own size.
    """
    lacking = any_of([F.col(c).isNull() for c in ("description", "invoice_date", "revenue")])
    counted = rows.groupBy(F.col("owner_id").alias("_owner")).agg(
        F.count("*").alias("rows_analyzed"),
        F.count_if(F.col("is_cancellation")).alias("cancellations"),
        F.count_if(lacking).alias("incomplete_rows"),
    )
    met = owners.select("owner_id").distinct().join(counted, F.col("owner_id").eqNullSafe(F.col("_owner")), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("rows_analyzed", "cancellations", "incomplete_rows")]
    met = met.select("owner_id", *counts)
    analyzed = F.col("rows_analyzed")
    return met.select(
        "owner_id",
        F.when(analyzed > 0, "connected").otherwise("dataset_empty").alias("status"),
        "rows_analyzed",
        quality_score(analyzed, F.col("incomplete_rows")).alias("quality_score"),
        "cancellations",
        "incomplete_rows",
    )


def _state(*cases: tuple[Column, str], otherwise: str) -> Column:
    state = F
    for condition, name in cases:
        state = state.when(condition, name)
    return state.otherwise(otherwise)


def _verdicts(
    report: DataFrame, checks: list[tuple[str, Column | None, Column | None, Column]], beside: list[Column] = ()
) -> DataFrame:
    """One row per check, with the columns ``beside``; the report itself is one row."""
    unknown = F.lit(None)
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(code).alias("check_code"),
            (unknown if failing is None else failing).cast("bigint").alias("failing"),
            (unknown if total is None else total).cast("bigint").alias("total"),
            state.alias("state"),
        )
        for i, (code, failing, total, state) in enumerate(checks)
    ]
    return report.select(F.inline(F.array(*cells)), *beside)


#: The figures of a report that each check of a scan rests on, by its position.
SCAN_FIGURES = {
    "columns": 0, "quality": 0, "missing": 1, "incomplete": 2, "duplicateRows": 2, "invalidDates": 2, "invalidNumbers": 2,
}


def scan_findings(report: DataFrame) -> DataFrame:
    """``scan_verdicts``, and beside each check the single figures it rests on; null at other checks."""
    figures = {n: F.array_join(n, ", ") if n == "missing" else F.col(n) for n in SCAN_FIGURES}
    verdicts = _verdicts(report, _scan_checks(), [c.alias(n) for n, c in figures.items()])
    shown = {n: F.when(F.col("position") == at, F.col(n)) for n, at in SCAN_FIGURES.items()}
    return verdicts.withColumns(shown)


def scan_verdicts(report: DataFrame) -> DataFrame:
    """(position, check_code, failing, total, state) for a csv_quality or preview_scan report.

    ``failing`` of ``total`` rows, or fields for the mapping, fail the check.
    """
    return _verdicts(report, _scan_checks())


def _scan_checks() -> list[tuple[str, Column | None, Column | None, Column]]:
    rows, missing, quality = F.col("rows"), F.size("missing"), F.col("quality")
    counts = [F.col(c) for c in ("incomplete", "duplicateRows", "invalidDates", "invalidNumbers")]
    passing = _state((quality >= PASSING_SCORE, "pass"), otherwise="warn")
    return [
        ("scan_completeness", counts[0], rows, passing),
        ("scan_mapping", missing, F.col("mapped") + missing, _state((missing > 0, "warn"), otherwise="pass")),
        ("scan_faults", sum(counts[1:], counts[0]), rows, _state((any_of([c > 0 for c in counts]), "warn"), otherwise="pass")),
        ("scan_returns", F.col("cancellations"), rows, F.lit("info")),
    ]


def health_verdicts(report: DataFrame) -> DataFrame:
    """(position, check_code, failing, total, state) for a table_health report; what was not read is null."""
    status, score = F.col("status"), F.col("quality_score")
    connected, absent, empty = (status == s for s in ("connected", "dataset_missing", "dataset_empty"))
    lacking = F.size("missing_columns")
    incomplete, cancelled = F.col("incomplete_rows"), F.col("cancellations")
    rows = F.when(~absent, F.col("rows_analyzed"))
    scored = score.isNotNull()
    return _verdicts(
        report,
        [
            ("table_present", None, None, _state((absent, "fail"), (empty, "warn"), otherwise="pass")),
            (
                "table_mapping", F.when(~absent, lacking), F.col("columns_expected"),
                _state((absent, "info"), (lacking > 0, "fail"), otherwise="pass"),
            ),
            ("table_rows", None, rows, _state((~absent & (rows > 0), "pass"), otherwise="info")),
            (
                "table_completeness", F.when(connected, incomplete), rows,
                _state((~connected, "info"), (score >= PASSING_SCORE, "pass"), otherwise="warn"),
            ),
            (
                "table_values", F.when(scored, incomplete), rows,
                _state((~scored, "info"), (incomplete > 0, "warn"), otherwise="pass"),
            ),
            (
                "table_faults", F.when(connected, incomplete), rows,
                _state((connected & (incomplete > 0), "warn"), otherwise="info"),
            ),
            ("table_returns", F.when(~absent, cancelled), rows, F.lit("info")),
        ],
    )
