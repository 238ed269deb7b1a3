"""One-time and repeat customers, and the best customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions.numbers import percentage
from tillscope.operators.joins import join_salted
from tillscope.plans.lines import known_customers, purchases
from tillscope.schemas import ONE_TIME, REPEAT


def _customer_type(invoices: Column) -> Column:
    return F.when(invoices == 1, ONE_TIME).otherwise(REPEAT)


def customer_types(transactions: DataFrame) -> DataFrame:
    """(customer_id, customer_type, lines) per customer with a purchase.

    Lines merge by customer and invoice first, in hash aggregations: comparing the
    smallest and greatest invoice would need one shuffle less, but text has to be
    sorted for that, every line of it. Unnamed invoices are not counted.
    """
    invoices = purchases(transactions).groupBy("customer_id", "invoice_no").agg(F.count("*").alias("lines"))
    return invoices.groupBy("customer_id").agg(
        _customer_type(F.count("invoice_no")).alias("customer_type"),
        F.sum("lines").alias("lines"),
    )


def customer_segments(transactions: DataFrame) -> DataFrame:
    """Customers and their percentage per customer type."""
    counted = customer_types(transactions).groupBy("customer_type").agg(F.count("*").alias("customer_count"))
    # Two rows at most, so one window partition holds them.
    everyone = F.sum("customer_count").over(Window.partitionBy())
    return counted.select(
        "customer_type", "customer_count", percentage(F.col("customer_count"), everyone).alias("percentage")
    )


def lines_with_type(transactions: DataFrame) -> DataFrame:
    """Every line with its customer's type, null for customers without a purchase."""
    bought = ~F.col("is_cancellation")
    invoices = known_customers(transactions).groupBy("customer_id", "invoice_no").agg(
        F.count("*").alias("lines"), F.count_if(bought).alias("bought")
    )
    named = F.when(F.col("bought") > 0, F.col("invoice_no"))
    types = invoices.groupBy("customer_id").agg(
        F.when(F.sum("bought") > 0, _customer_type(F.count(named))).alias("customer_type"),
        F.sum("lines").alias("lines"),
    )
    return join_salted(transactions, types, "customer_id", "lines", how="left")


def top_customers(transactions: DataFrame, rows: int = 10) -> DataFrame:
    """Known customers by revenue, cancellations included."""
    return (
        known_customers(transactions)
        .groupBy("customer_id")
        .agg(F.sum("revenue").alias("total_revenue"))
        .orderBy(F.desc_nulls_first("total_revenue"), F.asc("customer_id"))
        .limit(rows)
    )
