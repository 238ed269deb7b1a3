"""Customer cohorts by month of first purchase and their retention.

Distinct (customer, month) pairs are the base of everything: equal pairs merge
before the shuffle, and what is left per customer is at most the number of
months, so windows per customer stay small whoever buys most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions.dates import month_start, months_between_starts
from tillscope.functions.numbers import percentage
from tillscope.plans.lines import purchases


def customer_cohorts(transactions: DataFrame, ordered: bool = True) -> DataFrame:
    """(customer_id, first_purchase_month), earliest cohort first.

    This and the next two results have rows per customer. Sorting them all costs
    another shuffle; ``ordered=False`` leaves it out.
    """
    first = purchases(transactions).groupBy("customer_id").agg(F.min("invoice_date").alias("first"))
    cohorts = first.select("customer_id", month_start(F.col("first")).alias("first_purchase_month"))
    # With the customer in the order, the customers of one month can be split among tasks.
    return cohorts.orderBy(F.asc_nulls_last("first_purchase_month"), "customer_id") if ordered else cohorts


def purchase_months(transactions: DataFrame, ordered: bool = True) -> DataFrame:
    """Distinct (customer_id, purchase_month)."""
    month = month_start(F.col("invoice_date")).alias("purchase_month")
    months = purchases(transactions).select("customer_id", month).distinct()
    return months.orderBy("customer_id", F.asc_nulls_last("purchase_month")) if ordered else months


def month_numbers(transactions: DataFrame, ordered: bool = True) -> DataFrame:
    """Each purchase month with its number of months since the first purchase.

    The first month per customer is the month of the first purchase, so one scan
    replaces a join of cohorts and activity.
    """
    first = F.min("purchase_month").over(Window.partitionBy("customer_id"))
    dated = purchase_months(transactions, ordered=False).withColumn("first_purchase_month", first)
    number = months_between_starts(F.col("purchase_month"), F.col("first_purchase_month"))
    numbered = dated.select("customer_id", "first_purchase_month", "purchase_month", number.alias("month_number"))
    return numbered.orderBy("customer_id", F.asc_nulls_last("purchase_month")) if ordered else numbered


def _cohort_counts(transactions: DataFrame) -> DataFrame:
    # Pairs are distinct, so counting rows counts customers.
    return (
        month_numbers(transactions, ordered=False)
        .groupBy("first_purchase_month", "month_number")
        .agg(F.count("*").alias("active_customers"))
    )


def _ordered(cohorts: DataFrame) -> DataFrame:
    return cohorts.orderBy(F.asc_nulls_last("first_purchase_month"), F.asc_nulls_last("month_number"))


def cohort_counts(transactions: DataFrame) -> DataFrame:
    """Active customers per cohort and month number."""
    return _ordered(_cohort_counts(transactions))


def cohort_retention(transactions: DataFrame) -> DataFrame:
    """The same with the percentage of the cohort's first month."""
    by_month = Window.partitionBy("first_purchase_month").orderBy(F.asc_nulls_last("month_number"))
    base = F.first("active_customers").over(by_month)
    retained = percentage(F.col("active_customers"), base).alias("retention_percentage")
    return _ordered(_cohort_counts(transactions).select("*", retained))


def cohort_matrix(transactions: DataFrame, max_month: int = 3) -> DataFrame:
    """One row per cohort with columns m0, m1, ...; null where nobody was active."""

    def active(month: int):
        return F.max(F.when(F.col("month_number") == month, F.col("active_customers")))

    wide = (
        _cohort_counts(transactions)
        .groupBy("first_purchase_month")
        .agg(*[active(m).alias(f"active{m}") for m in range(max_month + 1)])
    )
    return wide.select(
        "first_purchase_month",
        *[percentage(F.col(f"active{m}"), F.col("active0")).alias(f"m{m}") for m in range(max_month + 1)],
    ).orderBy(F.asc_nulls_last("first_purchase_month"))
