"""Writers: cleaned rows, one owner's rows, tables made on first use, uploads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.functions.headers import detect_columns
from tillscope.operators.quality import missing_upload_columns, validation_errors
from tillscope.operators.standardize import standardize, upload_records
from tillscope.schemas import DEFAULTS, MESSAGES, TENANT_TRANSACTIONS
from tillscope.sinks.versions import replace_partition
from tillscope.sources.demo import demo_transactions
from tillscope.sources.files import read_upload
from tillscope.sources.tables import PUBLIC_TABLE, TENANT_TABLE, ensure_tenant_table


def with_defaults(rows: DataFrame, defaults: dict[str, object] = DEFAULTS) -> DataFrame:
    """Fill nulls of the columns that have a stored default."""
    return rows.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in rows.columns}
    )


def write_cleaned(cleaned: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Replace the cleaned data set; Parquet, or CSV with a header."""
    writer = cleaned.write.mode("overwrite")
    if file_format == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(file_format).save(path)


def replace_owner(records: DataFrame, owner_id: int, table: str = TENANT_TABLE) -> int:
    """Replace all of the owner's rows in the tenants' table; other owners' files stay.

    Returns the number of rows. New rows are written beside the old ones and become the
    owner's partition in one catalog command, so a reader has all old or all new rows
    and a writer that dies before changes nothing. An empty frame leaves the owner
    without rows.
    """
    ensure_tenant_table(records.sparkSession, table)
    columns = [f.name for f in TENANT_TRANSACTIONS if f.name != "owner_id"]
    return replace_partition(records.select(*columns), table, "owner_id", owner_id)


def create_if_absent(
    spark: SparkSession, table: str, build: Callable[[SparkSession], DataFrame]
) -> bool:
    """Create ``table`` from ``build`` unless it exists; tells whether it did."""
    if spark.catalog.tableExists(table):
        return False
    build(spark).write.saveAsTable(table)
    return True


def ensure_demo_table(spark: SparkSession) -> bool:
    return create_if_absent(spark, PUBLIC_TABLE, demo_transactions)


def ingest_upload(
    spark: SparkSession,
    csv_path: str,
    owner_id: int,
    table: str = TENANT_TABLE,
    date_format: str | None = None,
    strict: bool = True,
    allow_returns: bool = False,
) -> dict[str, object]:
    """Validate a CSV and make it the owner's data; refused as a whole or stored as a whole.

    It goes into the tenants' table, which all reports of the owner read.

    An upload without rows is refused. The file is read twice, once to validate and
    once to write, rather than kept in memory in between.
    """
    raw = read_upload(spark, csv_path)
    column_map = detect_columns(raw.columns, strict=strict)
    missing = missing_upload_columns(raw.columns) if strict else [
        f for f in missing_upload_columns(raw.columns) if f not in column_map
    ]
    if missing:
        raise ValueError(MESSAGES["undetected"] + ", ".join(missing))
    rows = standardize(raw, column_map, date_format)
    errors = validation_errors(rows, allow_returns)
    if errors:
        raise ValueError("; ".join(errors))
    if rows.isEmpty():
        raise ValueError("Refusing to replace an owner's rows by an empty dataset")
    stored = replace_owner(with_defaults(upload_records(rows, owner_id)), owner_id, table)
    return upload_receipt(rows, stored, csv_path)


def upload_receipt(rows: DataFrame, stored: int, filename: str, preview: int = 5) -> dict[str, object]:
    """Row count, columns and a short preview; only the preview reaches the driver."""
    return {
        "filename": filename.rsplit("/", 1)[-1],
        "rows": stored,
        "columns": rows.columns,
        "preview": [r.asDict() for r in rows.limit(preview).collect()],
        "message": MESSAGES["uploaded"],
    }
