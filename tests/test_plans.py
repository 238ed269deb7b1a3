"""Edge cases of the analytics queries and known figures on the given tables."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from registry import inputs
from tests.conftest import tuples
from tillscope.operators import clean, profile
from tillscope.plans import cohorts, context, customers, products, revenue
from tillscope.plans.summary import Summary

GOLDEN_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def year_1995(spark):
    return inputs.transactions(spark, GOLDEN_DIR).where("invoice_date < timestamp_ntz'1996-01-01'").cache()


def test_known_figures_of_one_year(year_1995):
    row = year_1995.agg(
        F.count("*"), F.sum("revenue"), F.count_if("is_cancellation"),
        F.count_distinct("invoice_no"), F.count("customer_id"),
    ).first()
    assert (row[0], str(row[1]), row[2], row[3], row[4]) == (9136, "73269380.2000", 3031, 3795, 8231)
    segments = {r[0]: (r[1], float(r[2])) for r in customers.customer_segments(year_1995).collect()}
    assert segments == {"One-time": (485, 47.0), "Repeat": (547, 53.0)}
    cells = cohorts.cohort_retention(year_1995).collect()
    assert len(cells) == 78
    assert [(r[1], r[2], float(r[3])) for r in cells[:4]] == [
        (0, 148, 100.0), (1, 9, 6.08), (2, 23, 15.54), (3, 16, 10.81)
    ]


def test_window_form_equals_join_form(year_1995):
    bought = year_1995.where("customer_id is not null and not is_cancellation")
    first = bought.groupBy("customer_id").agg(F.trunc(F.min("invoice_date"), "month").alias("first"))
    active = bought.select("customer_id", F.trunc("invoice_date", "month").alias("month")).distinct()
    joined = first.join(active, "customer_id").groupBy("first", F.months_between("month", "first").cast("int").alias("n"))
    expected = joined.agg(F.count_distinct("customer_id"))
    assert sorted(tuples(expected)) == sorted(tuples(cohorts.cohort_counts(year_1995)))


def test_properties_of_one_year(year_1995):
    net = {r[0]: r[1] for r in revenue.monthly_net_revenue(year_1995).collect()}
    gross = {r[0]: r[1] for r in revenue.monthly_gross_revenue(year_1995).collect()}
    assert all(gross[m] >= net[m] for m in net)
    summary = Summary(year_1995)
    assert sum(r["revenue"] for r in summary.monthly.collect()) == summary.totals.first()["revenue"]
    typed = customers.lines_with_type(year_1995)
    assert typed.count() == year_1995.count()
    parts = [
        Summary(year_1995, segment=s).totals.first()["revenue"] for s in ("Repeat customers", "One-time customers")
    ]
    known = year_1995.where("customer_id is not null and not is_cancellation").agg(F.sum("revenue")).first()[0]
    assert sum(parts) == known


def test_known_figures_of_the_raw_sheet(spark):
    raw = inputs.raw_retail(spark, GOLDEN_DIR)
    assert profile.shape(raw).first()["rows"] == 66109
    assert profile.duplicate_count(raw).first()[0] == 6110
    assert {r[0]: r[1] for r in profile.null_counts(raw).collect()}["Description"] == 1285
    assert tuples(profile.price_sign_counts(raw))[0][:2] == (666, 703)
    cleaned = clean.clean(raw)
    row = cleaned.agg(
        F.count("*"), F.sum("Revenue"), F.count_if("IsCancellation"), F.count_if(F.abs("Revenue") > 10000)
    ).first()
    assert (row[0], str(row[1]), row[2], row[3]) == (57592, "461686429.1000", 19267, 45795)


def test_missing_invoice_and_invoice_over_two_months(lines):
    fact = lines(
        ("1", "A", "2024-01-31", "x", 10),
        ("1", "A", "2024-02-01", "x", 30),
        (None, "B", "2024-02-01", "y", 8),
        (None, "B", "2024-02-02", None, 2),
    )
    summary = Summary(fact)
    assert tuples(summary.totals.select("revenue", "orders", F.col("aov").cast("double"))) == [(Decimal(50), 1, 25.0)]
    assert [(r[0], float(r[1]), r[2]) for r in summary.monthly.collect()] == [("2024-01", 10.0, 1), ("2024-02", 40.0, 1)]
    assert float(revenue.average_order_value(fact).first()[0]) == 25.0
    totals = revenue.totals_from_months(summary.monthly).first()
    assert (float(totals["revenue"]), totals["orders"], totals["aov"]) == (50.0, 2, 25.0)


def test_nothing_selected(lines):
    fact = lines(("1", "A", "2024-01-01", "x", 5))
    summary = Summary(fact, country="Nowhere")
    assert [tuple(map(float, r)) for r in summary.totals.collect()] == [(0.0, 0.0, 0.0)]
    assert summary.monthly.count() == summary.top_products().count() == 0
    empty = fact.limit(0)
    assert revenue.average_order_value(empty).first()[0] is None
    assert tuples(context.context_totals(empty))[0][1:] == (0, 0)
    assert customers.customer_segments(empty).count() == 0


def test_share_counts_unnamed_products(lines):
    fact = lines(
        ("1", "A", "2024-01-01", "x", 30), ("2", None, "2024-01-01", "x", 60), ("3", "B", "2024-01-01", "x", 10),
    )
    got = [(r[0], float(r[1]), r[2]) for r in Summary(fact).top_products().collect()]
    assert got == [("A", 30.0, 30.0), ("B", 10.0, 10.0)]
    assert [r[0] for r in Summary(fact).top_products(rows=1).collect()] == ["A"]
    balanced = lines(("1", "A", "2024-01-01", "x", 5), ("2", "B", "2024-01-01", "x", -5))
    assert [r["share"] for r in Summary(balanced).top_products().collect()] == [0.0, 0.0]


def test_top_products_leave_out_postage_and_put_unknown_revenue_first(lines):
    fact = lines(
        ("1", "POSTAGE", "2024-01-01", "x", 99), ("2", "DOTCOM POSTAGE", "2024-01-01", "x", 99),
        ("3", None, "2024-01-01", "x", 99), ("4", "A", "2024-01-01", "x", 1),
        ("5", "B", "2024-01-01", "x", None), ("6", "A", "2024-01-01", "x", 50, {"cancelled": True}),
    )
    assert [(r[1], r[2]) for r in products.top_products(fact).collect()] == [("B", None), ("A", Decimal(1))]


def test_top_customers_include_cancellations(lines):
    fact = lines(
        ("1", "A", "2024-01-01", "x", 10), ("C1", "A", "2024-01-02", "x", -4, {"cancelled": True}),
        ("2", "A", "2024-01-01", "y", 7), ("3", "A", "2024-01-01", None, 100),
    )
    assert [(r[0], float(r[1])) for r in customers.top_customers(fact).collect()] == [("y", 7.0), ("x", 6.0)]


def test_customer_types(lines):
    fact = lines(
        ("1", "A", "2024-01-01", "once", 1), ("1", "B", "2024-01-01", "once", 1),
        ("2", "A", "2024-01-01", "twice", 1), ("3", "A", "2024-01-01", "twice", 1),
        (None, "A", "2024-01-01", "nameless", 1),
        ("C9", "A", "2024-01-01", "returner", -1, {"cancelled": True}),
        ("4", "A", "2024-01-01", "once", -1, {"cancelled": True}),
        ("5", "A", "2024-01-01", None, 1),
    )
    kinds = {r[0]: r[1] for r in customers.customer_types(fact).collect()}
    assert kinds == {"once": "One-time", "twice": "Repeat", "nameless": "Repeat"}
    typed = sorted((r["customer_id"] or "", r["customer_type"]) for r in customers.lines_with_type(fact).collect())
    assert typed == [
        ("", None), ("nameless", "Repeat"), ("once", "One-time"), ("once", "One-time"),
        ("once", "One-time"), ("returner", None), ("twice", "Repeat"), ("twice", "Repeat"),
    ]


def test_segment_scope(lines):
    fact = lines(
        ("1", "A", "2024-01-01", "x", 10, {"owner": 1}), ("2", "A", "2024-01-01", "x", 20, {"owner": 2}),
    )
    everybody = Summary(fact, segment="Repeat customers", owner_id=1)
    own = Summary(fact, segment="Repeat customers", owner_id=1, segment_scope="owner")
    assert float(everybody.totals.first()["revenue"]) == 10.0
    assert float(own.totals.first()["revenue"]) == 0.0
    assert float(Summary(fact, owner_id=2).totals.first()["revenue"]) == 20.0


def test_any_other_segment_means_one_time(lines):
    fact = lines(("1", "A", "2024-01-01", "x", 10), ("2", "A", "2024-01-01", None, 5))
    assert float(Summary(fact, segment="One-time customers").totals.first()["revenue"]) == 10.0
    assert float(Summary(fact, segment="anything").totals.first()["revenue"]) == 10.0
    assert float(Summary(fact).totals.first()["revenue"]) == 15.0


def test_cohorts_with_missing_dates(lines):
    fact = lines(
        ("1", "A", None, "x", 1), ("2", "A", "2024-01-15", "x", 1), ("3", "A", "2024-03-15", "x", 1),
        ("4", "A", "2024-01-02", "y", 1),
    )
    got = [(r[0], r[1], r[2], float(r[3])) for r in cohorts.cohort_retention(fact).collect()]
    january = date(2024, 1, 1)
    assert got == [(january, 0, 2, 100.0), (january, 2, 1, 50.0), (january, None, 1, 50.0)]
    assert [float(v) if v is not None else None for v in tuples(cohorts.cohort_matrix(fact))[0][1:]] == [
        100.0, None, 50.0, None
    ]
    assert tuples(cohorts.purchase_months(fact))[:3] == [
        ("x", january), ("x", date(2024, 3, 1)), ("x", None)
    ]
    assert sorted(tuples(cohorts.customer_cohorts(fact))) == [("x", january), ("y", january)]


def test_context_json(lines):
    fact = lines(("1", 'Say "hi"', "2024-01-01", "x", 2.5), ("2", "B", "2024-01-01", None, 1))
    import json

    row = context.ask_context(fact, " why? ").first()
    assert row["question"] == "why?"
    assert json.loads(row["context"]) == {
        "question": "why?",
        "data": {
            "totals": {"revenue": "3.5000", "orders": 2, "customers": 1},
            "top_products": [
                {"product": 'Say "hi"', "revenue": "2.5000"}, {"product": "B", "revenue": "1.0000"}
            ],
        },
    }


@pytest.mark.parametrize(
    "filters", [{}, {"segment": "Repeat customers"}, {"segment": "One-time customers", "product": "red widget"}]
)
def test_materialized_summary_is_the_same(year_1995, filters):
    plain = Summary(year_1995, **filters)
    stored = plain.materialized()
    assert tuples(stored.totals) == tuples(plain.totals)
    assert tuples(stored.monthly) == tuples(plain.monthly)
    assert tuples(stored.top_products()) == tuples(plain.top_products())
    plan = stored.totals._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" in plan and "Join" not in plan


def test_unordered_results_have_the_same_rows(year_1995):
    for plan in (cohorts.customer_cohorts, cohorts.purchase_months, cohorts.month_numbers):
        unordered = plan(year_1995, ordered=False)
        assert "rangepartitioning" not in unordered._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(repr, tuples(unordered))) == sorted(map(repr, tuples(plan(year_1995))))
