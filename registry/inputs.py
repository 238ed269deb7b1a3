"""The given tables in the shapes the library works on. No row is left out.

Join strategies are left to Spark: it broadcasts a dimension only while its
measured size allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.schemas import MONEY, PRICE, QUANTITY


# Columns in use. A given schema saves Spark a job per table to look it up.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def transactions(
    spark: SparkSession,
    sf_dir: str,
    priced: bool = True,
    country: bool = False,
    yearly_accounts: bool = False,
) -> DataFrame:
    """Order lines as the canonical fact table.

    Returned lines are cancellations with negative quantity; every tenth
    customer is anonymous. Dimensions are joined only for queries that use them:
    ``priced`` adds product, price and revenue, ``country`` the country and an
    owner per nation. ``yearly_accounts`` gives a customer a new account each
    year, so that one-time customers are common.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    returned = F.col("l_returnflag") == "R"
    order = F.col("o_orderkey").cast("string")
    # Quantities are whole pieces; the detour avoids a text round trip per line.
    pieces = F.col("l_quantity").cast("bigint")
    quantity = F.when(returned, -pieces).otherwise(pieces)
    account = F.col("o_custkey").cast("string")
    if yearly_accounts:
        account = F.concat(account, F.lit("-"), F.year("o_orderdate").cast("string"))
    columns = [
        F.when(returned, F.concat(F.lit("C"), order)).otherwise(order).alias("invoice_no"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        quantity.cast(QUANTITY).alias("quantity"),
        F.col("o_orderdate").alias("invoice_date"),
        F.when(F.col("o_custkey") % 10 != 0, account).alias("customer_id"),
        returned.alias("is_cancellation"),
    ]
    if priced:
        # Prices become decimals once per part, not once per line.
        parts = table(spark, sf_dir, "part").select(
            "p_partkey", "p_name", F.col("p_retailprice").cast("decimal(10,4)").alias("price")
        )
        sold = sold.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        columns += [
            F.col("p_name").alias("description"),
            F.col("price").cast(PRICE).alias("unit_price"),
            (quantity.cast("decimal(10,0)") * F.col("price")).cast(MONEY).alias("revenue"),
        ]
    if country:
        customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        sold = sold.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
            nations, F.col("c_nationkey") == F.col("n_nationkey")
        )
        columns += [F.col("n_name").alias("country"), F.col("c_nationkey").alias("owner_id")]
    return sold.select(*columns)


def raw_retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dirty sheet: missing descriptions, odd prices and repeated rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_name",
        F.when(F.col("p_partkey") % 97 == 0, F.lit(0))
        .when(F.col("p_partkey") % 101 == 0, F.lit(-1))
        .otherwise(F.col("p_retailprice"))
        .cast(PRICE)
        .alias("price"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    returned = F.col("l_returnflag") == "R"
    order = F.col("l_orderkey").cast("string")
    quantity = F.col("l_quantity").cast("bigint")
    # orders get their country before they meet their lines, which are many more; names are the widest and come last
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    sheet = (
        lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.when(returned, F.concat(F.lit("C"), order)).otherwise(order).alias("InvoiceNo"),
            F.col("l_partkey").cast("string").alias("StockCode"),
            F.when(F.col("l_orderkey") % 53 != 0, F.col("p_name")).alias("Description"),
            F.when(returned, -quantity).otherwise(quantity).alias("Quantity"),
            F.col("o_orderdate").alias("InvoiceDate"),
            F.col("price").alias("UnitPrice"),
            F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("CustomerID"),
            F.col("n_name").alias("Country"),
        )
    )
    # Each row once, and rows whose code ends in 7 once more.
    times = F.when(F.col("StockCode").endswith("7"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return sheet.withColumn("_time", F.explode(times)).drop("_time")


def raw_upload(spark: SparkSession, sf_dir: str, numbered: bool = False) -> DataFrame:
    """A dirty all-text upload; ``numbered`` by event."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        *(["event_id"] if numbered else []),
        F.when(event % 17 != 0, (event % 4000).cast("string")).alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.when(event % 23 == 0, "not-a-date")
        .when(event % 29 != 0, F.date_format("ts", "yyyy-MM-dd"))
        .alias("order_date"),
        F.col("event_type").alias("product"),
        F.when(event % 31 == 0, "x").when(event % 37 == 0, "-1").otherwise((event % 7).cast("string")).alias("qty"),
        F.when(event % 41 != 0, F.col("value").cast("decimal(18,2)").cast("string")).alias("unit_price"),
    )


def noted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a note of up to three lines, with quotes and commas."""
    event = F.col("event_id")
    note = F.concat(
        F.lit('said "'), F.col("event_type"), F.lit('", '),
        F.repeat(F.lit("then\n"), (event % 4).cast("int")), F.when(event % 5 == 0, '"').otherwise("end"),
    )
    return table(spark, sf_dir, "events").select(
        event.cast("string").alias("event_id"), note.alias("note"), F.col("event_type").alias("kind")
    )


def uploads(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Uploads with headers of their own: the dirty one, the one with month-first dates, one without prices."""
    raw = raw_upload(spark, sf_dir)
    return {
        "plain": raw,
        "dated": dated_upload(spark, sf_dir).withColumnsRenamed({"order_id": "Invoice", "qty": "Units", "unit_price": "Price"}),
        "bare": raw.select(F.col("product").alias("Item"), F.col("qty").alias("Quantity"), "order_id"),
    }


def dated_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upload with month-first dates; its first date is none."""
    event = F.col("event_id")
    day = F.concat_ws("/", F.month("ts"), F.dayofmonth("ts"), F.year("ts"))
    dated = F.concat(day, F.lit(" "), F.hour("ts"), F.lit(":"), F.date_format("ts", "mm"))
    return table(spark, sf_dir, "events").select(
        (event % 4000).cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.when(event % 23 == 0, "TBC").otherwise(dated).alias("order_date"),
        F.col("event_type").alias("product"),
        (event % 7 + 1).cast("string").alias("qty"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("unit_price"),
    )


def large_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upload with numbers that the stored columns cannot hold."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        event.cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("order_date"),
        F.col("event_type").alias("product"),
        F.when(event % 43 == 0, "1000000000000000").when(event % 59 == 0, "90000000000000").otherwise("2").alias("qty"),
        F.when(event % 47 == 0, "123456789012345678").when(event % 59 == 0, "90000000000000").otherwise("3.5").alias("unit_price"),
    )


def preview_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upload with revenue and status as previewed text: missing cells are blank."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.when(event % 17 == 0, "").otherwise((event % 4000).cast("string")).alias("Invoice No"),
        F.when(event % 23 == 0, "soon")
        .when(event % 29 == 0, "")
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("Order Date"),
        F.col("event_type").alias("Item"),
        F.when(event % 31 == 0, "x").otherwise((event % 7).cast("string")).alias("Qty"),
        F.when(event % 41 == 0, "").otherwise(F.col("value").cast("decimal(18,2)").cast("string")).alias("Sales"),
        F.when(event % 19 == 0, "Cancelled").when(event % 43 == 0, "RETURNED").otherwise("ok").alias("Status"),
    )


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue and number of orders per calendar month."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    return orders.groupBy(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month_no")
    ).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(20,2)").alias("month_revenue"),
        F.count("*").alias("order_count"),
    )


def account_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One settings row per customer."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("owner_id"),
        F.col("c_name").alias("workspace_name"),
        F.col("c_mktsegment").alias("currency"),
        F.expr("timestamp_ntz'1990-01-01 00:00:00'").alias("updated_at"),
    )


def settings_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change per order, several per customer and time."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("owner_id"),
        F.concat(F.lit("after order "), F.col("o_orderkey").cast("string")).alias("workspace_name"),
        F.col("o_orderpriority").alias("currency"),
        F.col("o_orderdate").alias("updated_at"),
    )
