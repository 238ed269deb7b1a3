"""The reports as SQL functions against the Python ones."""

from __future__ import annotations

import json

import pytest

from registry import inputs
from tests.conftest import SF_DIR, tuples
from tillscope import sql
from tillscope.plans import cohorts, context, customers, products, revenue
from tillscope.plans.summary import Summary

PYTHON = {
    "monthly_net_revenue": revenue.monthly_net_revenue,
    "monthly_gross_revenue": revenue.monthly_gross_revenue,
    "average_order_value": revenue.average_order_value,
    "customer_segments": customers.customer_segments,
    "customer_cohorts": cohorts.customer_cohorts,
    "purchase_months": cohorts.purchase_months,
    "month_numbers": cohorts.month_numbers,
    "cohort_counts": cohorts.cohort_counts,
    "cohort_retention": cohorts.cohort_retention,
    "cohort_matrix": cohorts.cohort_matrix,
    "top_customers": customers.top_customers,
    "top_products": products.top_products,
}
QUOTED = "O'Brien's \"pens\"; DROP TABLE x --"


@pytest.fixture(scope="module")
def facts(spark, lines):
    """The orders of the given tables, and a few odd lines."""
    odd = lines(
        ("1", QUOTED, "2024-01-01", "x", 10), ("1", QUOTED, "2024-02-01", "x", 5, {"country": "It's"}),
        (None, None, "2024-02-01", None, 7), ("2", "A", None, "x", -3, {"cancelled": True}), ("3", "POSTAGE", "2024-02-01", "y", 900),
    ).drop("owner_id")
    given = inputs.transactions(spark, SF_DIR, country=True, yearly_accounts=True).select(*odd.columns)
    both = given.unionByName(odd).cache()
    both.createOrReplaceTempView("sql_facts")
    names = sql.register(spark, "sql_facts")
    assert set(PYTHON) | {"summary_monthly", "summary_totals", "summary_products", "ask_context"} == set(names)
    return both


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    b = b.select(*a.columns)
    assert sorted(map(repr, tuples(a))) == sorted(map(repr, tuples(b)))


@pytest.mark.parametrize("name", sorted(PYTHON))
def test_reports_are_the_python_ones(spark, facts, name):
    same(sql.call(spark, name), PYTHON[name](facts))


@pytest.mark.parametrize(
    "choice",
    [
        {}, {"segment": "Repeat customers"}, {"segment": "One-time customers", "country": "NATION_7"}, {"product": "small ring"},
        {"segment": "All customers", "country": "All countries", "product": "All products"},
        {"segment": "Repeat customers", "country": "NATION_3", "product": "small ring"}, {"country": "nowhere"},
        {"product": QUOTED}, {"country": "It's"},
    ],
)
def test_summaries_with_bound_choices(spark, facts, choice):
    summary = Summary(facts, **choice)
    same(sql.call(spark, "summary_monthly", **choice), summary.monthly)
    same(sql.call(spark, "summary_totals", **choice), summary.totals)
    same(sql.call(spark, "summary_products", **choice), summary.top_products())


def test_places_and_quotes_are_values(spark, facts):
    assert sql.call(spark, "top_customers", places=3).count() == 3
    assert sql.call(spark, "top_products", places=0).count() == 0
    found = sql.call(spark, "summary_totals", product=QUOTED).first()
    assert (float(found.revenue), found.orders) == (15, 1)
    assert sql.call(spark, "summary_totals", product="' OR '1'='1").first().orders == 0
    with pytest.raises(ValueError):
        sql.call(spark, "top_customers(1) UNION SELECT 1, 2 --")
    joined = spark.sql("SELECT count(*) AS n FROM top_customers(:n) c JOIN customer_cohorts() f USING (customer_id)", args={"n": 4})
    assert joined.first().n == 4


def test_question_context(spark, facts):
    for question in ("Which?", ' "It\'s" '):
        got = sql.call(spark, "ask_context", question=question).first()
        expected = context.ask_context(facts, question).first()
        assert got.question == expected.question and json.loads(got.context) == json.loads(expected.context)


def test_tenths_in_sql(spark, facts):
    values = [95.65, 0.25, 0.75, 0.35, -0.25, 0.05, 1e15 + 0.25, 12345678.05, 0.0] + [k / 40 for k in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.selectExpr("binary_tenths(v)").collect()] == [round(v, 1) for v in values]
