"""Deterministic order lines generated from monthly revenue and order counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillscope.schemas import (
    DEMO_COUNTRIES,
    DEMO_MONTHS,
    DEMO_ONE_TIME_CUSTOMERS,
    DEMO_DAYS,
    DEMO_PREFIXES,
    DEMO_PRODUCTS,
    DEMO_PRODUCT_STEP,
    DEMO_REPEAT_CUSTOMERS,
    MONEY,
    PRICE,
    QUANTITY,
)

ORDERS_PER_BLOCK = 10_000


def demo_months(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        DEMO_MONTHS, "year int, month_no int, month_revenue decimal(20,2), order_count bigint"
    )


def _order_indexes(months: DataFrame) -> DataFrame:
    """One row per order with its index in the month and its number overall.

    Orders before a month are a running sum over the months, so no order is ever
    numbered by a global sort. A month is expanded block by block, and the blocks
    are spread out, so that one huge month is no single task's work.
    """
    # One row per calendar month: small enough for a single window partition.
    earlier = Window.partitionBy().orderBy("year", "month_no").rowsBetween(Window.unboundedPreceding, -1)
    numbered = months.withColumn("orders_before", F.coalesce(F.sum("order_count").over(earlier), F.lit(0)))
    block_count = F.ceil(F.col("order_count") / ORDERS_PER_BLOCK).cast("bigint")
    blocks = (
        numbered.where(F.col("order_count") > 0)
        .withColumn("block", F.explode(F.sequence(F.lit(0), block_count - 1)))
        .repartition("year", "month_no", "block")
    )
    first = F.col("block") * ORDERS_PER_BLOCK + 1
    last = F.least(F.col("order_count"), (F.col("block") + 1) * ORDERS_PER_BLOCK)
    return blocks.withColumn("order_index", F.explode(F.sequence(first, last))).withColumn(
        "order_number", F.col("orders_before") + F.col("order_index")
    )


def _choice(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def generate_transactions(
    months: DataFrame,
    one_time_customers: int = DEMO_ONE_TIME_CUSTOMERS,
    repeat_customers: int = DEMO_REPEAT_CUSTOMERS,
) -> DataFrame:
    """One single-item order line per order of ``months``.

    ``months`` has year, month_no, month_revenue and order_count. The first
    ``one_time_customers`` orders each get their own customer, later ones cycle
    through ``repeat_customers``.
    """
    orders = _order_indexes(months)
    index, number, month = F.col("order_index"), F.col("order_number"), F.col("month_no")
    product = (index * DEMO_PRODUCT_STEP + month) % len(DEMO_PRODUCTS)

    def digits(value: Column, width: int) -> Column:
        """At least ``width`` digits; greater numbers keep all of theirs."""
        text = value.cast("string")
        return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))

    first_day = F.make_timestamp_ntz(
        F.col("year"), month, F.lit(1), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)")
    )
    price = (F.col("month_revenue").cast(MONEY) / F.col("order_count")).cast(PRICE)
    repeat = (number - one_time_customers - 1) % repeat_customers + 1
    return orders.select(
        F.concat(
            F.lit(DEMO_PREFIXES["invoice"]), F.col("year").cast("string"), F.lit("-"), digits(month, 2), F.lit("-"), digits(index, 5)
        ).alias("invoice_no"),
        F.concat(F.lit(DEMO_PREFIXES["product"]), digits(product + 1, 2)).alias("stock_code"),
        _choice(DEMO_PRODUCTS, product).alias("description"),
        F.lit(1).cast(QUANTITY).alias("quantity"),
        (first_day + F.make_dt_interval(days=(index % DEMO_DAYS).cast("int"))).alias("invoice_date"),
        price.alias("unit_price"),
        F.when(number <= one_time_customers, F.concat(F.lit(DEMO_PREFIXES["one_time"]), digits(number, 5)))
        .otherwise(F.concat(F.lit(DEMO_PREFIXES["repeat"]), digits(repeat, 5)))
        .alias("customer_id"),
        _choice(DEMO_COUNTRIES, (index + month) % len(DEMO_COUNTRIES)).alias("country"),
        price.cast(MONEY).alias("revenue"),
        F.lit(False).alias("is_cancellation"),
    )


def demo_transactions(spark: SparkSession) -> DataFrame:
    """The demo year."""
    return generate_transactions(demo_months(spark))
