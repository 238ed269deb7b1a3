"""The generated demo year against known figures."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillscope.operators.quality import table_health
from tillscope.plans import cohorts, context, customers, products, revenue
from tillscope.plans.summary import Summary
from tillscope.sources.demo import ORDERS_PER_BLOCK, demo_transactions, generate_transactions


@pytest.fixture(scope="module")
def demo(spark):
    return demo_transactions(spark).cache()


def test_totals(demo):
    row = demo.agg(
        F.count("*"), F.count_distinct("invoice_no"), F.count_distinct("customer_id"), F.sum("revenue")
    ).first()
    assert (row[0], row[1], row[2], str(row[3])) == (15686, 15686, 8412, "2297999.8280")
    assert round(float(revenue.average_order_value(demo).first()[0]), 8) == 146.50005279


def test_months(demo):
    monthly = [(r[0].month, str(r[1])) for r in revenue.monthly_net_revenue(demo).collect()]
    assert monthly[:3] == [(1, "118399.9640"), (2, "132800.0310"), (3, "149500.0000")]
    assert monthly[-1] == (12, "278299.9584")
    assert monthly == [(r[0].month, str(r[1])) for r in revenue.monthly_gross_revenue(demo).collect()]
    points = Summary(demo).monthly
    highlights = revenue.month_highlights(points).first()
    assert (highlights["latest_month"], highlights["highest_month"]) == ("2024-12", "2024-12")
    assert highlights["latest_orders"] == 1884
    assert round(revenue.totals_from_months(points).first()["aov"], 4) == 146.5001


def test_segments(demo):
    got = {r[0]: (r[1], float(r[2])) for r in customers.customer_segments(demo).collect()}
    assert got == {"One-time": (3197, 38.01), "Repeat": (5215, 61.99)}


def test_top_lists(demo):
    best = products.top_products(demo).collect()
    assert [(r[0], str(r[2])) for r in best] == [
        ("SKU-04", "459864.7781"), ("SKU-02", "459716.5243"), ("SKU-01", "459571.4990"),
        ("SKU-03", "459423.7814"), ("SKU-05", "459423.2452"),
    ]
    top = customers.top_customers(demo).collect()
    assert [r[0] for r in top] == [f"C-REP-{n:05d}" for n in range(1716, 1726)]
    assert {str(r[1]) for r in top} == {"441.6235"}
    assert {r["share"] for r in Summary(demo).top_products().collect()} == {20.0}
    ranked = products.with_rank(Summary(demo).top_products()).orderBy("rank").collect()
    assert [(r["rank"], r["name"]) for r in ranked][:2] == [("01", "Linen lounge shirt"), ("02", "Classic leather tote")]
    best = Summary(demo).top_products()
    assert [r["name"] for r in products.visible_products(best, "Hand-poured candle").collect()] == ["Hand-poured candle"]
    assert products.visible_products(best, "All products").count() == 5


def test_cohorts(demo):
    cells = {(r[0].month, r[1]): (r[2], float(r[3])) for r in cohorts.cohort_retention(demo).collect()}
    assert cells[(4, 4)] == (500, 50.92) and cells[(4, 8)] == (380, 38.7)
    assert cells[(6, 3)] == (317, 25.56) and cells[(8, 3)] == (950, 100.0)
    assert len(cells) == 20
    matrix = {r[0]: r for r in cohorts.cohort_matrix(demo).collect()}
    assert {float(r["m0"]) for r in matrix.values()} == {100.0}
    assert {r["m1"] for r in matrix.values()} == {None}
    assert float(matrix[date(2024, 7, 1)]["m3"]) == 54.73
    assert len(cohorts.cohort_matrix(demo, max_month=5).columns) == 7


@pytest.mark.parametrize(
    "filters, expected",
    [
        ({"segment": "Repeat customers"}, ("1835032.6434", 12489, 146.9319)),
        ({"segment": "One-time customers"}, ("462967.1846", 3197, 144.8130)),
        ({"country": "Germany"}, ("766046.9559", 5229, 146.4997)),
        ({"product": "Ceramic coffee set"}, ("459423.7814", 3136, 146.4999)),
        (
            {"segment": "Repeat customers", "country": "Germany", "product": "Ceramic coffee set"},
            ("122395.3719", 833, 146.9332),
        ),
        (
            {"segment": "All customers", "country": "All countries", "product": "All products"},
            ("2297999.8280", 15686, 146.5001),
        ),
    ],
)
def test_filtered_totals(demo, filters, expected):
    row = Summary(demo, **filters).totals.first()
    assert (str(row["revenue"]), row["orders"], round(float(row["aov"]), 4)) == expected


def test_health(demo):
    row = table_health(demo).first()
    assert (row["status"], row["columns_mapped"], row["incomplete_rows"], row["quality_score"]) == (
        "connected", 9, 0, 100.0
    )


def test_context(demo):
    row = context.context_totals(demo).first()
    assert (str(row[0]), row[1], row[2]) == ("2297999.8280", 15686, 8412)
    assert context.context_products(demo).count() == 5
    with pytest.raises(ValueError):
        context.ask_context(demo, "  ")


def test_large_month_is_split(spark):
    orders = ORDERS_PER_BLOCK * 2 + 5
    months = spark.sql(
        f"select 2024 year, 1 month_no, cast(100 as decimal(20,2)) month_revenue, {orders}L order_count "
        "union all select 2024, 2, 50, 0L union all select 2024, 3, 50, 2L"
    )
    rows = generate_transactions(months)
    assert rows.count() == rows.select("invoice_no").distinct().count() == orders + 2
    last = rows.where("invoice_no = 'DEMO-2024-03-00002'").first()
    assert last["customer_id"] == f"C-REP-{(orders + 2 - 3198) % 5215 + 1:05d}"


def test_numbers_beyond_five_digits_stay_whole(spark):
    months = spark.createDataFrame([(2024, 1, Decimal(150000), 150_000)], "year int, month_no int, month_revenue decimal(20,2), order_count bigint")
    rows = generate_transactions(months, one_time_customers=150_000)
    counted = rows.agg(F.countDistinct("invoice_no").alias("invoices"), F.countDistinct("customer_id").alias("customers"), F.max(F.length("invoice_no")).alias("width")).first()
    assert (counted.invoices, counted.customers, counted.width) == (150_000, 150_000, len("DEMO-2024-01-150000"))
