"""Hand-computed results on the small order file."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

from tests.conftest import tuples
from tillscope.functions.headers import detect_columns
from tillscope.operators.quality import csv_quality, preview_scan, scan_verdicts, validation_errors
from tillscope.operators.standardize import standardize, upload_records
from tillscope.plans import cohorts, customers, products, revenue
from tillscope.plans.summary import Summary
from tillscope.operators.clean import price_lines
from tillscope.sources.files import read_csv_text, read_preview, read_raw_retail, read_upload, unparsed_cells
from tillscope.sources.tables import as_transactions

TEXT = """
Invoice,Client_ID,Order_Date,Item,Qty,Unit_Price
A-1,k7,2026-03-02,Lamp,3,40
A-2,k8,2026-03-04,Mug,10,6
A-3,k7,2026-03-09,Lamp,1,40
A-4,k9,2026-03-20,Chair,2,150
A-5,k8,2026-03-31,Mug,5,16"""


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    file = tmp_path_factory.mktemp("orders") / "orders.csv"
    file.write_text(TEXT)
    return str(file)


@pytest.fixture(scope="module")
def fact(spark, path):
    return as_transactions(upload_records(standardize(read_upload(spark, path)), owner_id=7)).cache()


def test_header(spark, path):
    assert detect_columns(read_upload(spark, path).columns) == {
        "order_id": "Invoice", "customer_id": "Client_ID", "date": "Order_Date",
        "product": "Item", "quantity": "Qty", "unit_price": "Unit_Price",
    }


def test_no_rule_is_broken(spark, path):
    assert validation_errors(standardize(read_upload(spark, path))) == []


def test_rows(fact):
    assert [float(r["revenue"]) for r in fact.orderBy("invoice_no").collect()] == [120, 60, 40, 300, 80]
    assert fact.select("country").distinct().collect()[0][0] == "Unknown"
    assert {r["stock_code"] for r in fact.collect()} == {None}
    assert not any(r["is_cancellation"] for r in fact.collect())


def test_revenue(fact):
    march = date(2026, 3, 1)
    assert tuples(revenue.monthly_net_revenue(fact)) == [(march, Decimal("600.0000"))]
    assert tuples(revenue.monthly_gross_revenue(fact)) == [(march, Decimal("600.0000"))]
    assert float(revenue.average_order_value(fact).first()[0]) == 120.0


def test_customers_and_products(fact):
    segments = {r[0]: (r[1], float(r[2])) for r in customers.customer_segments(fact).collect()}
    assert segments == {"Repeat": (2, 66.67), "One-time": (1, 33.33)}
    assert [(r[0], float(r[1])) for r in customers.top_customers(fact).collect()] == [
        ("k9", 300.0), ("k7", 160.0), ("k8", 140.0)
    ]
    assert [(r[1], float(r[2])) for r in products.top_products(fact).collect()] == [
        ("Chair", 300.0), ("Lamp", 160.0), ("Mug", 140.0)
    ]


def test_cohort(fact):
    assert tuples(cohorts.cohort_retention(fact)) == [(date(2026, 3, 1), 0, 3, Decimal("100.00"))]


def test_summary(fact):
    summary = Summary(fact)
    assert [tuple(map(float, r)) for r in summary.totals.collect()] == [(600.0, 5.0, 120.0)]
    assert [(r[0], float(r[1]), r[2]) for r in summary.monthly.collect()] == [("2026-03", 600.0, 5)]
    assert [(r[0], r[2]) for r in summary.top_products().collect()] == [
        ("Chair", 50.0), ("Lamp", 26.7), ("Mug", 23.3)
    ]


def test_quality_report(spark, path):
    report = csv_quality(read_upload(spark, path)).first().asDict()
    assert report == {
        "rows": 5, "columns": 6, "mapped": 6,
        "missing": ["Revenue", "Country", "Cancellation flag"],
        "incomplete": 0, "duplicateRows": 0, "invalidDates": 0, "invalidNumbers": 0,
        "cancellations": 0, "quality": 100.0,
    }
    verdicts = tuples(scan_verdicts(csv_quality(read_upload(spark, path))))
    assert verdicts[0] == (0, "scan_completeness", 0, 5, "pass")
    assert verdicts[1] == (1, "scan_mapping", 3, 9, "warn")


def test_preview_asks_for_revenue(spark, path):
    report = preview_scan(read_preview(spark, path)).first().asDict()
    assert (report["mapped"], report["incomplete"], report["quality"]) == (6, 5, 0)


def test_row_lengths(spark, tmp_path):
    short = tmp_path / "short.csv"
    short.write_text("a,b,c\n1,2,3\n4,5\n")
    assert tuples(read_csv_text(spark, str(short))) == [("1", "2", "3"), ("4", "5", None)]
    long = tmp_path / "long.csv"
    long.write_text("a,b,c\n1,2,3\n4,5,6,7\n")
    with pytest.raises(Exception, match="more cells than the header"):
        read_csv_text(spark, str(long)).collect()
    with pytest.raises(Exception, match="more cells than the header"):
        read_csv_text(spark, str(long)).select("a").count()
    hidden = tmp_path / "hidden.csv"
    hidden.write_text('a,b,c\n1,"x,y",3,\n1,2,3,,LOST\n')
    with pytest.raises(Exception, match="more cells than the header"):
        read_csv_text(spark, str(hidden)).count()
    blank = tmp_path / "blank.csv"
    blank.write_text('a,b,c\n1,"x,y",3,\n4,5,6,,\n')
    assert read_csv_text(spark, str(blank)).count() == 2
    assert tuples(read_csv_text(spark, str(blank)))[0] == ("1", "x,y", "3")


def test_files_of_a_glob_share_one_header(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    (tmp_path / "two.csv").write_text("a,b\r\n3,4\r\n")
    assert sorted(tuples(read_csv_text(spark, str(tmp_path / "*.csv")))) == [("1", "2"), ("3", "4")]
    (tmp_path / "three.csv").write_text("b,a\n5,6\n")
    with pytest.raises(ValueError, match="different headers"):
        read_csv_text(spark, str(tmp_path / "*.csv"))


def test_raw_sheet_by_name_in_its_own_notation(spark, tmp_path):
    sheet = tmp_path / "sheet.csv"
    sheet.write_text(
        "StockCode,Description,InvoiceNo,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        "S1,pen,1,2,12/1/2010 8:26,1.25,17850.0,UK\n"
        "S2,bag,2,1,TBC,abc,17850.6,UK\n"
    )
    rows = {r.InvoiceNo: r for r in read_raw_retail(spark, str(sheet)).collect()}
    assert rows["1"].Description == "pen" and rows["1"].InvoiceDate == datetime(2010, 12, 1, 8, 26)
    assert rows["2"].InvoiceDate is None and rows["2"].UnitPrice is None
    cells = {r.column: r.cells for r in unparsed_cells(read_csv_text(spark, str(sheet))).collect()}
    assert {c for c, n in cells.items() if n} == {"InvoiceDate", "UnitPrice"}
    priced = {r.InvoiceNo: r.CustomerID for r in price_lines(read_raw_retail(spark, str(sheet))).collect()}
    assert priced == {"1": 17850, "2": None}
    lacking = tmp_path / "lacking.csv"
    lacking.write_text("InvoiceNo,StockCode\n1,2\n")
    with pytest.raises(ValueError, match="lacks columns: Description"):
        read_raw_retail(spark, str(lacking))
    long = tmp_path / "nine.csv"
    long.write_text(sheet.read_text().replace(",UK", ",UK,extra"))
    with pytest.raises(Exception, match="more cells than the header"):
        read_raw_retail(spark, str(long)).count()


def test_unreadable_files(spark, tmp_path):
    with pytest.raises(ValueError, match="CSV"):
        read_upload(spark, str(tmp_path / "orders.txt"))
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    with pytest.raises(ValueError, match="no header"):
        read_upload(spark, str(empty))


def test_missing_values_and_quotes(spark, tmp_path):
    file = tmp_path / "cells.csv"
    file.write_text('a,b\nNA,"x, ""y"""\nn/a,NaN\n , z \n')
    assert tuples(read_upload(spark, str(file))) == [(None, 'x, "y"'), (None, None), (" ", " z ")]
    assert tuples(read_preview(spark, str(file))) == [("NA", 'x, "y'), ("n/a", "NaN"), ("", "z")]
