from __future__ import annotations

import pytest

from registry import inputs
from tests.conftest import tuples
from tillscope.operators import quality
from tillscope.operators.standardize import rename_detected, standardize
from tillscope.functions.headers import detect_columns
from tillscope.sources.files import nulls_from_text

GOLDEN_DIR = "/root/testdata/sf0.01"
HEADER = "order_id string, customer_id string, date string, product string, qty string, price string"


def test_known_figures_of_the_upload(spark):
    raw = nulls_from_text(inputs.raw_upload(spark, GOLDEN_DIR))
    row = quality.csv_quality(raw).first()
    assert (row["rows"], row["incomplete"], row["invalidDates"], row["invalidNumbers"]) == (10000, 1791, 765, 559)
    assert (row["cancellations"], row["quality"], row["duplicateRows"]) == (262, 82.1, 0)
    report = quality.validation_report(standardize(raw)).orderBy("position").collect()
    assert [r["rows"] for r in report] == [589, 765, 323, 244, 1607, 0, 0]
    assert quality.validation_errors(standardize(raw)) == [
        "Some orders are missing order IDs.",
        "Some rows have missing dates.",
        "Some rows have missing quantities.",
        "Some rows have missing prices.",
        "Some rows have zero or negative quantities.",
    ]


def test_price_rule_infinity_and_returns(spark):
    rows = [("1", "c", "2024-01-01", "p", "2", "0"), ("2", "c", "2024-01-01", "p", "inf", "3"), ("3", "c", "2024-01-01", "p", "-1", "3")]
    df = standardize(spark.createDataFrame(rows, HEADER))
    assert quality.validation_errors(df) == [
        "Some rows have missing quantities.",
        "Some rows have zero or negative quantities.",
        "Some rows have zero or negative prices.",
    ]
    returns = standardize(spark.createDataFrame(rows[2:], HEADER))
    assert quality.validation_errors(returns, allow_returns=True) == []


def test_duplicates_weigh_every_figure(spark):
    rows = [("1", "c", "bad", "p", "x", "1")] * 3 + [("2", "c", "2024-01-01", "p", "-2", "1")] * 2
    df = spark.createDataFrame(rows, HEADER)
    row = quality.csv_quality(df, "yyyy-MM-dd").first()
    assert (row["rows"], row["duplicateRows"], row["incomplete"]) == (5, 3, 3)
    assert (row["invalidDates"], row["invalidNumbers"], row["cancellations"], row["quality"]) == (3, 3, 2, 40.0)


def test_findings_keep_the_single_figures(spark):
    rows = [("1", "c", "bad", "p", "x", "1")] * 3 + [("2", "c", "2024-01-01", "p", "-2", "1")] * 2
    report = quality.csv_quality(spark.createDataFrame(rows, HEADER), "yyyy-MM-dd")
    got = {r.check_code: r for r in quality.scan_findings(report).collect()}
    assert [tuple(r)[:5] for r in got.values()] == tuples(quality.scan_verdicts(report))
    first, fields, faults = got["scan_completeness"], got["scan_mapping"], got["scan_faults"]
    assert (first["columns"], first["quality"], first["missing"]) == (len(rows[0]), 40.0, None)
    assert fields["missing"] == ", ".join(report.first()["missing"]) and fields["quality"] is None
    assert [faults[n] for n in ("incomplete", "duplicateRows", "invalidDates", "invalidNumbers")] == [3, 3, 3, 3]
    assert faults["failing"] == 12 and got["scan_returns"]["failing"] == 2


def test_missing_field_gives_no_score(spark):
    df = spark.createDataFrame([("1", "2"), ("1", "2")], "order_id string, qty string")
    row = quality.csv_quality(df).first()
    assert (row["rows"], row["duplicateRows"], row["incomplete"], row["quality"]) == (2, 1, 0, None)
    assert quality.missing_upload_columns(df.columns) == ["customer_id", "date", "product", "unit_price"]
    verdict = tuples(quality.scan_verdicts(quality.csv_quality(df)))[0]
    assert verdict == (0, "scan_completeness", 0, 2, "warn")


def test_empty_upload(spark):
    df = spark.createDataFrame([], HEADER)
    row = quality.csv_quality(df).first()
    assert (row["rows"], row["duplicateRows"], row["quality"]) == (0, 0, None)
    assert quality.preview_scan(df).first()["quality"] is None


def test_customer_is_optional_in_the_preview(spark):
    ddl = "order_id string, date string, product string, qty string, price string"
    df = spark.createDataFrame([("1", "2024-01-01", "p", "1", "2")], ddl)
    assert quality.csv_quality(df).first()["quality"] == 100.0
    assert standardize(df).first()["customer_id"] is None


def test_clashing_names(spark):
    df = spark.createDataFrame([("a", "b", "c")], "`date` string, `Order Date` string, `revenue` string")
    renamed = rename_detected(df, detect_columns(df.columns))
    assert renamed.columns == ["date", "revenue"] and renamed.first()["date"] == "b"


def test_standardize_replaces_revenue_and_refuses_gaps(spark):
    ddl = "order_id string, date string, product string, qty string, price string, revenue string"
    df = spark.createDataFrame([("1", "2024-01-01", "p", "3", "2", "99")], ddl)
    assert standardize(df).first()["revenue"] == 6.0
    with pytest.raises(ValueError, match="unit_price"):
        standardize(df.drop("price"))


def test_preview_scan(spark):
    ddl = "`Order` string, Item string, Date string, Qty string, Total string, Status string"
    rows = [
        ("1", "a", "2024-01-01", "1", "5", "ok"),
        ("1", "a", "2024-01-01", "1", "5", "ok"),
        ("2", "", "2024-01-01", "1", "5", "1"),
        ("3", "a", "never", "Infinity", "5", "Returned"),
        ("4", "a", "", "1", "5", "10"),
    ]
    row = quality.preview_scan(spark.createDataFrame(rows, ddl)).first()
    assert (row["rows"], row["mapped"], row["incomplete"], row["duplicateRows"]) == (5, 6, 2, 1)
    assert (row["invalidDates"], row["invalidNumbers"], row["cancellations"], row["quality"]) == (1, 1, 2, 20)
    unmapped = quality.preview_scan(spark.createDataFrame(rows, ddl).drop("Date")).first()
    assert (unmapped["invalidDates"], unmapped["incomplete"], unmapped["quality"]) == (5, 5, 0)


def test_health_states(spark, lines):
    missing = quality.catalog_health(spark, "no_such_table").first()
    assert (missing["status"], missing["columns_mapped"], len(missing["missing_columns"])) == ("dataset_missing", 0, 9)
    fact = lines(("1", "A", "2024-01-01", "x", 1), ("2", None, "2024-01-01", "x", 1, {"cancelled": True}))
    partial = quality.table_health(fact.drop("country", "quantity")).first()
    assert (partial["status"], partial["missing_columns"], partial["columns_mapped"]) == (
        "schema_incomplete", ["country", "quantity"], 7
    )
    empty = quality.table_health(fact.limit(0)).first()
    assert (empty["status"], empty["quality_score"], empty["rows_analyzed"]) == ("dataset_empty", None, 0)
    good = quality.table_health(fact).first()
    assert (good["status"], good["quality_score"], good["cancellations"], good["incomplete_rows"]) == ("connected", 50.0, 1, 1)


def test_health_verdicts(spark, lines):
    def states(df):
        return {r["check_code"]: r["state"] for r in quality.health_verdicts(df).collect()}

    fact = lines(("1", "A", "2024-01-01", "x", 1), ("2", None, "2024-01-01", "x", 1))
    every = ("present", "mapping", "rows", "completeness", "values", "faults", "returns")
    names = [f"table_{n}" for n in every]
    assert states(quality.table_health(fact)) == dict(zip(names, ["pass", "pass", "pass", "warn", "warn", "warn", "info"]))
    assert states(quality.catalog_health(spark, "no_such_table")) == dict(zip(names, ["fail", *["info"] * 6]))
    assert states(quality.table_health(fact.limit(0))) == dict(zip(names, ["warn", "pass", *["info"] * 5]))
    assert states(quality.table_health(fact.drop("country"))) == dict(zip(names, ["pass", "fail", *["info"] * 5]))
    counts = [tuple(r)[2:4] for r in quality.health_verdicts(quality.table_health(fact)).orderBy("position").collect()]
    assert counts == [(None, None), (0, 9), (None, 2), (1, 2), (1, 2), (1, 2), (0, 2)]


def test_health_of_every_owner(spark, lines):
    fact = lines(
        ("1", "A", "2024-01-01", "x", 1), ("2", None, "2024-01-01", "x", 1, {"cancelled": True}),
        ("3", "A", "2024-01-01", "y", 1, {"owner": 2}), ("4", "A", "2024-01-01", "y", 1, {"owner": None}),
    )
    owners = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "owner_id int")
    assert sorted(tuples(quality.owners_health(fact, owners)), key=repr) == [
        (1, "connected", 2, 50.0, 1, 1), (2, "connected", 1, 100.0, 0, 0),
        (3, "dataset_empty", 0, None, 0, 0), (None, "connected", 1, 100.0, 0, 0),
    ]
    assert quality.owners_health(fact.limit(0), owners).count() == 4
