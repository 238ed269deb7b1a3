"""The reports by name, read from the catalog and shaped as API rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillscope.operators.quality import catalog_health
from tillscope.plans import cohorts, context, customers, products, revenue
from tillscope.plans.summary import Summary
from tillscope.schemas import SUMMARY_PARTS
from tillscope.sinks.results import api_rows
from tillscope.sinks.writers import ensure_demo_table
from tillscope.sources.tables import PUBLIC_TABLE, TENANT_TABLE, ensure_tenant_table, source_rows


def _retention(rows: DataFrame) -> DataFrame:
    return cohorts.cohort_retention(rows).withColumnRenamed("first_purchase_month", "cohort")


# Report names. These always read the public table.
PUBLIC_REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "monthly-revenue": revenue.monthly_net_revenue,
    "gross-revenue": revenue.monthly_gross_revenue,
    "customer-segments": customers.customer_segments,
    "aov": revenue.average_order_value,
    "cohort-retention": _retention,
    "top-customers": customers.top_customers,
    "top-products": products.top_products,
}


def public_report(spark: SparkSession, name: str) -> DataFrame:
    """One of ``PUBLIC_REPORTS`` over the public table."""
    return api_rows(PUBLIC_REPORTS[name](source_rows(spark)))


def summary_report(
    spark: SparkSession,
    segment: str | None = None,
    country: str | None = None,
    product: str | None = None,
    owner_id: int | None = None,
) -> dict[str, DataFrame]:
    """Totals, monthly revenue and best products of a caller's rows under filters.

    A caller's customers are typed by everybody's purchases, as ``Summary`` does
    by default, so the tenant table is handed over whole and filtered by owner. The
    selected lines are stored once, and the three parts come from them.
    """
    if owner_id is None:
        rows = source_rows(spark)
    else:
        ensure_tenant_table(spark)
        rows = spark.table(TENANT_TABLE)
    summary = Summary(rows, segment, country, product, owner_id).materialized()
    parts = (summary.totals, summary.monthly, summary.top_products())
    return {name: api_rows(part) for name, part in zip(SUMMARY_PARTS, parts)}


def health_report(spark: SparkSession, owner_id: int | None = None) -> DataFrame:
    """Health of the public table, or of one tenant's rows; either is made on first use."""
    if owner_id is None:
        ensure_demo_table(spark)
        return catalog_health(spark, PUBLIC_TABLE)
    ensure_tenant_table(spark)
    return catalog_health(spark, TENANT_TABLE, owner_id)


def question_report(spark: SparkSession, question: str, owner_id: int | None = None) -> DataFrame:
    """A question with the metrics of a caller's rows as JSON."""
    return context.ask_context(source_rows(spark, owner_id), question)
