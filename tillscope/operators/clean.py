"""Cleaning of the raw retail sheet into the canonical fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions.cancellations import by_invoice_prefix
from tillscope.schemas import MONEY, PRICE, QUANTITY, TRANSACTIONS
from tillscope.sources.files import PLACE


def _whole_number(number: Column) -> Column:
    """The number as an integer; null unless it is a whole number that one can hold."""
    exact = number.try_cast("decimal(38,10)")
    return F.when(exact == F.floor(exact), exact.try_cast("bigint"))


def _distinct(raw: DataFrame) -> DataFrame:
    if PLACE not in raw.columns:
        return raw.dropDuplicates()
    return raw.groupBy(*[c for c in raw.columns if c != PLACE]).agg(F.min(PLACE).alias(PLACE))


def price_lines(raw: DataFrame) -> DataFrame:
    """Distinct described rows with customer number, revenue and cancellation flag.

    Rows that have their place in a file keep the first of it.

    Whole-row duplicates go first. The description filter depends on the row
    alone, so Spark moves it below the deduplication and down to the scan.
    """
    return (
        _distinct(raw)
        .where(F.col("Description").isNotNull())
        .withColumn("CustomerID", _whole_number(F.col("CustomerID")))
        .withColumn("Revenue", (F.col("Quantity") * F.col("UnitPrice")).cast(MONEY))
        .withColumn("IsCancellation", by_invoice_prefix(F.col("InvoiceNo")))
    )


def sellable(priced: DataFrame) -> DataFrame:
    return priced.where(F.col("UnitPrice") > 0)


def clean(raw: DataFrame) -> DataFrame:
    """Cleaned rows under the raw headers plus Revenue and IsCancellation."""
    return sellable(price_lines(raw))


def to_transactions(cleaned: DataFrame) -> DataFrame:
    """The same rows under the canonical names and types."""
    return cleaned.select(
        F.col("InvoiceNo").cast("string").alias("invoice_no"),
        F.col("StockCode").cast("string").alias("stock_code"),
        F.col("Description").alias("description"),
        F.col("Quantity").cast(QUANTITY).alias("quantity"),
        F.col("InvoiceDate").alias("invoice_date"),
        F.col("UnitPrice").cast(PRICE).alias("unit_price"),
        F.col("CustomerID").cast("string").alias("customer_id"),
        F.col("Country").alias("country"),
        F.col("Revenue").cast(MONEY).alias("revenue"),
        F.col("IsCancellation").alias("is_cancellation"),
    ).select(*TRANSACTIONS.fieldNames())
