"""Reports by name over catalog tables."""

from __future__ import annotations

import json

import pytest

from tests.conftest import tuples
from tillscope import reports
from tillscope.sinks.writers import ensure_demo_table
from tillscope.sources.tables import PUBLIC_TABLE, TENANT_TABLE


@pytest.fixture(scope="module")
def catalog(spark, lines):
    for table in (PUBLIC_TABLE, TENANT_TABLE):
        spark.sql(f"drop table if exists {table}")
    ensure_demo_table(spark)
    tenants = lines(
        ("1", "A", "2024-01-01", "x", 10, {"owner": 1}),
        ("2", "B", "2024-02-01", "x", 30, {"owner": 2}),
        ("3", "B", "2024-02-01", "y", 10, {"owner": 2, "country": "FR"}),
        ("4", None, "2024-02-01", "y", 5, {"owner": 2, "cancelled": True}),
    )
    tenants.drop("stock_code").write.partitionBy("owner_id").saveAsTable(TENANT_TABLE)
    yield spark
    for table in (PUBLIC_TABLE, TENANT_TABLE):
        spark.sql(f"drop table {table}")


@pytest.mark.parametrize(
    "name, first",
    [
        ("monthly-revenue", ("2024-01", 118399.964)),
        ("gross-revenue", ("2024-01", 118399.964)),
        ("aov", (146.50005279,)),
        ("cohort-retention", ("2024-01", 0, 820, 100.0)),
        ("top-customers", ("C-REP-01716", 441.6235)),
        ("top-products", ("SKU-04", "Linen lounge shirt", 459864.7781)),
    ],
)
def test_public_reports(catalog, name, first):
    assert tuples(reports.public_report(catalog, name))[0] == first


def test_segments_report(catalog):
    assert sorted(tuples(reports.public_report(catalog, "customer-segments"))) == [
        ("One-time", 3197, 38.01), ("Repeat", 5215, 61.99)
    ]


def test_summary_report(catalog):
    public = reports.summary_report(catalog, country="Germany")
    assert tuples(public["totals"])[0][:2] == (766046.9559, 5229)
    mine = reports.summary_report(catalog, owner_id=2)
    assert tuples(mine["totals"]) == [(40.0, 2, 20.0)]
    assert tuples(mine["monthly_revenue"]) == [("2024-02", 40.0, 2)]
    assert tuples(mine["top_products"]) == [("B", 40.0, 100.0)]
    repeat = reports.summary_report(catalog, segment="Repeat customers", owner_id=2)
    assert tuples(repeat["totals"]) == [(30.0, 1, 30.0)]


def test_health_report(catalog):
    assert reports.health_report(catalog).first()["rows_analyzed"] == 15686
    row = reports.health_report(catalog, owner_id=2).first()
    assert (row["source_table"], row["rows_analyzed"], row["incomplete_rows"], row["cancellations"]) == (
        TENANT_TABLE, 3, 1, 1
    )
    assert reports.health_report(catalog, owner_id=99).first()["status"] == "dataset_empty"


def test_question_report(catalog):
    row = reports.question_report(catalog, "Why?", owner_id=2).first()
    assert json.loads(row["context"])["data"]["totals"] == {"revenue": "40.0000", "orders": 2, "customers": 2}
