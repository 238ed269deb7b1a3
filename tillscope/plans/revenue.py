"""Monthly revenue and order values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions.dates import month_start
from tillscope.plans.lines import uncancelled


def _by_month(lines: DataFrame, name: str) -> DataFrame:
    return (
        lines.groupBy(month_start(F.col("invoice_date")).alias("month"))
        .agg(F.sum("revenue").alias(name))
        .orderBy(F.asc_nulls_last("month"))
    )


def monthly_net_revenue(transactions: DataFrame) -> DataFrame:
    """All lines; cancelled ones carry negative revenue."""
    return _by_month(transactions, "net_revenue")


def monthly_gross_revenue(transactions: DataFrame) -> DataFrame:
    return _by_month(uncancelled(transactions), "gross_revenue")


def order_values(lines: DataFrame) -> DataFrame:
    """(invoice_no, revenue); lines without an invoice number form one order."""
    return lines.groupBy("invoice_no").agg(F.sum("revenue").alias("revenue"))


def average_order_value(transactions: DataFrame) -> DataFrame:
    """One row; null when there are no orders."""
    orders = order_values(uncancelled(transactions))
    return orders.agg(F.avg("revenue").alias("average_order_value"))


def totals_from_months(monthly: DataFrame) -> DataFrame:
    """Totals of (month, revenue, orders) points and revenue per order between them.

    Differs from the average order value where an order spans two months.
    """
    totals = monthly.agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
    return totals.withColumn("aov", F.try_divide(F.col("revenue").cast("double"), F.col("orders").cast("double")))


def month_highlights(monthly: DataFrame) -> DataFrame:
    """The latest month and the month of the highest revenue, the earlier of equals."""
    latest = F.max(F.struct("month", "revenue", "orders"))
    highest = F.min(F.struct((-F.col("revenue")).alias("_order"), F.col("month"), F.col("revenue")))
    return monthly.agg(latest.alias("latest"), highest.alias("highest")).select(
        F.col("latest.month").alias("latest_month"),
        F.col("latest.revenue").alias("latest_revenue"),
        F.col("latest.orders").alias("latest_orders"),
        F.col("highest.month").alias("highest_month"),
        F.col("highest.revenue").alias("highest_revenue"),
    )
