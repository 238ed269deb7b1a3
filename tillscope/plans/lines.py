"""Row selections shared by the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def uncancelled(transactions: DataFrame) -> DataFrame:
    return transactions.where(~F.col("is_cancellation"))


def known_customers(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.col("customer_id").isNotNull())


def purchases(transactions: DataFrame) -> DataFrame:
    """Uncancelled lines of known customers."""
    return known_customers(uncancelled(transactions))
