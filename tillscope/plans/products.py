"""Best-selling products."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions.numbers import share
from tillscope.plans.lines import uncancelled
from tillscope.schemas import ALL_PRODUCTS, POSTAGE


def top_products(transactions: DataFrame, rows: int = 10) -> DataFrame:
    """Products by uncancelled revenue, without postage."""
    return (
        uncancelled(transactions)
        .where(~F.col("description").isin(POSTAGE))
        .groupBy("stock_code", "description")
        .agg(F.sum("revenue").alias("total_revenue"))
        .orderBy(
            F.desc_nulls_first("total_revenue"),
            F.asc_nulls_last("stock_code"),
            F.asc_nulls_last("description"),
        )
        .limit(rows)
    )


def best_named(products: DataFrame, rows: int) -> DataFrame:
    """The first rows of (description, revenue) that have a description.

    The unnamed group is sorted last and dropped after the limit. Dropping it
    before would push the filter into the scan, and the total of all products
    could then no longer share this aggregation.
    """
    return (
        products.select("description", F.coalesce("revenue", F.lit(0)).alias("revenue"))
        .orderBy(F.col("description").isNull(), F.desc("revenue"), F.asc("description"))
        .limit(rows)
        .where(F.col("description").isNotNull())
    )


def with_share(best: DataFrame, products: DataFrame) -> DataFrame:
    """Add each product's share of the revenue of all ``products``, named or not."""
    total = products.agg(F.coalesce(F.sum("revenue"), F.lit(0)).alias("total")).scalar()
    return best.withColumn("share", share(F.col("revenue"), total))


def visible_products(best: DataFrame, product: str | None = None) -> DataFrame:
    """The one chosen product of a result, or all of them."""
    return best.where(F.col("name") == product) if product and product != ALL_PRODUCTS else best


def with_rank(best: DataFrame) -> DataFrame:
    """Add the rank with a zero in front, whatever its digits, to a short, ordered product list."""
    order = Window.partitionBy().orderBy(F.desc("revenue"), F.asc("name"))
    return best.withColumn("rank", F.concat(F.lit("0"), F.row_number().over(order).cast("string")))
