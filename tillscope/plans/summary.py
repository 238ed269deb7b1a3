"""The filtered summary: revenue and orders by month, totals and best products."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions.dates import month_label, month_start
from tillscope.operators.joins import join_per_key
from tillscope.plans.customers import customer_types
from tillscope.plans.lines import uncancelled
from tillscope.plans.products import best_named, with_share
from tillscope.schemas import ALL_COUNTRIES, ALL_CUSTOMERS, ALL_PRODUCTS, ONE_TIME, SEGMENT_TYPES
from tillscope.session import ensure_checkpoint_dir
from tillscope.sources.tables import tenant_rows


def segment_type(segment: str | None) -> str | None:
    """Customer type a segment choice stands for; None for all customers."""
    if not segment or segment == ALL_CUSTOMERS:
        return None
    return SEGMENT_TYPES.get(segment, ONE_TIME)


@dataclass(frozen=True)
class Summary:
    """A filtered view of a fact table; each property is a lazy DataFrame.

    ``segment_scope`` says whose purchases decide a customer's type when an owner
    is given: everybody's ("all") or the owner's ("owner").
    """

    transactions: DataFrame
    segment: str | None = None
    country: str | None = None
    product: str | None = None
    owner_id: int | None = None
    segment_scope: str = "all"

    @cached_property
    def lines(self) -> DataFrame:
        """Uncancelled lines under the column filters, before any segment choice."""
        lines = uncancelled(self.transactions)
        if self.owner_id is not None:
            lines = tenant_rows(lines, self.owner_id)
        if self.country and self.country != ALL_COUNTRIES:
            lines = lines.where(F.col("country") == self.country)
        if self.product and self.product != ALL_PRODUCTS:
            lines = lines.where(F.col("description") == self.product)
        return lines

    @cached_property
    def _types(self) -> DataFrame:
        scope = self.transactions
        if self.segment_scope == "owner" and self.owner_id is not None:
            scope = tenant_rows(scope, self.owner_id)
        return customer_types(scope)

    def _revenue_by(self, *keys) -> DataFrame:
        """Revenue of the selected lines by ``keys``.

        Without a segment no customer is looked up. With one, revenue is first
        merged per customer and key, so the join moves merged rows, not lines.
        """
        total = F.sum("revenue").alias("revenue")
        kind = segment_type(self.segment)
        if kind is None:
            return self.lines.groupBy(*keys).agg(total)
        known = self.lines.where(F.col("customer_id").isNotNull())
        merged = known.groupBy("customer_id", *keys).agg(total)
        # Joined to all types and chosen afterwards: a heavy customer of the other
        # type has to be recognised as heavy too.
        kept = join_per_key(merged, self._types, "customer_id", "lines")
        kept = kept.where(F.col("customer_type") == kind).drop("customer_type")
        names = [c for c in kept.columns if c not in ("customer_id", "revenue")]
        return kept.groupBy(*names).agg(total)

    def materialized(self) -> Summary:
        """The same summary with its selected lines computed and stored once.

        Worth it when all three results are wanted, above all with a segment: the
        lines are read, joined and merged by order, month and product one time,
        and the results come from the checkpoint. Every executor can reach it, so
        losing one loses no work.
        """
        ensure_checkpoint_dir(self.transactions.sparkSession)
        month = month_start(F.col("invoice_date")).alias("invoice_date")
        merged = self._revenue_by("invoice_no", month, "description")
        return Summary(merged.withColumn("is_cancellation", F.lit(False)).checkpoint())

    @property
    def monthly(self) -> DataFrame:
        """(month, revenue, orders); an order is counted in each month it touches."""
        month = month_start(F.col("invoice_date")).alias("month")
        return (
            self._revenue_by(month, "invoice_no")
            .groupBy("month")
            .agg(
                F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"),
                F.count("invoice_no").alias("orders"),
            )
            .orderBy(F.asc_nulls_last("month"))
            .withColumn("month", month_label(F.col("month")))
        )

    @property
    def totals(self) -> DataFrame:
        """One row (revenue, orders, aov), zeros when nothing is selected.

        Lines without an invoice number are one order for the average but none
        in the count.
        """
        return self._revenue_by("invoice_no").agg(
            F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"),
            F.count("invoice_no").alias("orders"),
            F.coalesce(F.avg("revenue"), F.lit(0)).alias("aov"),
        )

    def top_products(self, rows: int = 5) -> DataFrame:
        """(name, revenue, share); the share is of all selected revenue."""
        products = self._revenue_by("description")
        return with_share(best_named(products, rows), products).withColumnRenamed("description", "name")
