"""From an uploaded all-string frame to canonical, typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions.cancellations import by_negative_quantity
from tillscope.functions.columns import named
from tillscope.functions.dates import infer_date_format, parse_timestamp
from tillscope.functions.headers import detect_columns
from tillscope.functions.numbers import to_number
from tillscope.schemas import MESSAGES, MONEY, PRICE, QUANTITY, UPLOAD_ALIASES


def rename_detected(df: DataFrame, column_map: dict[str, str]) -> DataFrame:
    """Give detected headers their canonical names and keep the other columns.

    A column that already has a canonical name but lost the detection would
    collide with the winner and is dropped.
    """
    renames = {header: field for field, header in column_map.items()}
    taken = {field.lower() for field in column_map}
    kept = [c for c in df.columns if c in renames or c.lower() not in taken]
    return df.select(*[named(c).alias(renames.get(c, c)) for c in kept])


def standardize(
    df: DataFrame, column_map: dict[str, str] | None = None, date_format: str | None = None
) -> DataFrame:
    """Canonical names, numbers and dates; texts that do not parse become null.

    Without a ``date_format`` the one that fits most dates is taken. ``revenue`` is
    quantity times price and replaces an uploaded column of that name.
    """
    column_map = detect_columns(df.columns) if column_map is None else column_map
    absent = [f for f in UPLOAD_ALIASES if f not in column_map and f != "customer_id"]
    if absent:
        raise ValueError(MESSAGES["undetected"] + ", ".join(absent))
    date_format = date_format or infer_date_format(df, column_map["date"])
    named_rows = rename_detected(df, column_map)
    if "customer_id" not in column_map:
        named_rows = named_rows.withColumn("customer_id", F.lit(None).cast("string"))
    typed = named_rows.withColumns(
        {
            "quantity": to_number(F.col("quantity")),
            "unit_price": to_number(F.col("unit_price")),
            "date": parse_timestamp(F.col("date"), date_format),
        }
    )
    return typed.withColumn("revenue", F.col("quantity") * F.col("unit_price"))


def _country(df: DataFrame) -> Column:
    # Only this exact header counts; other spellings are not looked for.
    return F.col("country") if "country" in df.columns else F.lit("Unknown")


def upload_records(standardized: DataFrame, owner_id: int) -> DataFrame:
    """The stored columns of a standardised upload, marked with their owner."""
    return standardized.select(
        F.col("order_id").cast("string").alias("invoice_no"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("product").cast("string").alias("description"),
        F.col("quantity").try_cast(QUANTITY).alias("quantity"),
        F.col("date").alias("invoice_date"),
        F.col("unit_price").try_cast(PRICE).alias("unit_price"),
        _country(standardized).alias("country"),
        F.col("revenue").try_cast(MONEY).alias("revenue"),
        by_negative_quantity(F.col("quantity")).alias("is_cancellation"),
        F.lit(owner_id).cast("int").alias("owner_id"),
    )
