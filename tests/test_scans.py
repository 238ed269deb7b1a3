"""How often the plans read a flat fact table. A planner that stops sharing work fails here."""

from __future__ import annotations

import pytest

from tests.conftest import TRANSACTION_DDL
from tillscope import reports
from tillscope.operators import profile
from tillscope.plans import context, customers
from tillscope.plans.summary import Summary


@pytest.fixture(scope="module")
def flat(spark, lines, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("flat") / "fact")
    lines(
        ("1", "pen", "2024-01-01", "a", 10), ("2", "pen", "2024-01-02", "a", 5), ("3", "cup", "2024-02-01", "b", 7),
        ("4", None, "2024-02-01", None, 2),
    ).write.parquet(path)
    return spark.read.schema(TRANSACTION_DDL).parquet(path)


@pytest.fixture(autouse=True)
def plain_plans(spark):
    """One plan per query, shared exchanges shown as such, no broadcast by size."""
    kept = {}
    for name, value in {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}.items():
        kept[name] = spark.conf.get(name)
        spark.conf.set(name, value)
    yield
    for name, value in kept.items():
        spark.conf.set(name, value)


def scans(df, path="fact"):
    """File scans that run: those under a reused exchange or subquery are printed once."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("FileScan" in line and path in line for line in plan.splitlines())


def sorted_aggregates(df):
    return df._jdf.queryExecution().executedPlan().toString().count("SortAggregate")


def test_segments_sort_no_lines(flat):
    plan = customers.customer_segments(flat)
    assert scans(plan) == 1 and sorted_aggregates(plan) == 0


def test_lines_with_type_reads_lines_once(flat):
    """The types are stored by then, from the only other read."""
    assert scans(customers.lines_with_type(flat)) == 1


def test_context_reads_lines_for_orders_customers_and_products(flat):
    assert scans(context.ask_context(flat, "why?")) == 3


@pytest.mark.parametrize("part", ["totals", "monthly"])
def test_summary_with_a_segment_reads_lines_and_types(flat, part):
    plan = getattr(Summary(flat, "Repeat customers"), part)
    assert scans(plan) == 2 and sorted_aggregates(plan) == 0


def test_parts_of_a_summary_report_read_nothing_again(spark, flat, monkeypatch):
    monkeypatch.setattr(reports, "source_rows", lambda session: flat)
    parts = reports.summary_report(spark, "Repeat customers")
    assert [scans(p) for p in parts.values()] == [0, 0, 0]
    assert [tuple(r) for r in parts["totals"].collect()] == [(15.0, 2, 7.5)]


def test_profile_counts_read_the_stored_rows_once(spark, tmp_path):
    schema = "InvoiceNo string, StockCode string, Description string, Quantity long, UnitPrice decimal(18,4), Revenue decimal(20,4), IsCancellation boolean"
    rows = spark.createDataFrame([], schema)
    rows.write.parquet(str(tmp_path / "fact"))
    parts = profile.profile_cleaning(spark.read.schema(schema).parquet(str(tmp_path / "fact")))
    for name in ("shape", "nulls", "price_signs", "cancellation_flags", "rows_remaining", "price_signs_after", "extreme_revenue"):
        assert scans(parts[name]) == 0, name
    assert parts["shape"].first()["rows"] == 0
