from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillscope.functions import cancellations, dates, headers, numbers


def values(spark, texts, expression):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, v string").orderBy("i")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


def test_numbers(spark):
    texts = ["1,000", " 5\t", "1e3", "inf", "1d", "0x10", "nan", ".5", "-2.", "", None]
    assert values(spark, texts, numbers.to_number) == [
        None, 5.0, 1000.0, float("inf"), None, None, None, 0.5, -2.0, None, None
    ]


def test_dates_follow_one_format(spark):
    texts = ["2026-01-05", " 2026-02-28 ", "05/01/2026", "2026-02-30", "2026-01-05 10:00", None]
    got = values(spark, texts, lambda c: dates.parse_timestamp(c, "yyyy-MM-dd"))
    assert got == [datetime(2026, 1, 5), datetime(2026, 2, 28), None, None, None, None]


def test_other_formats(spark):
    texts = ["12/1/2010 8:26", "13/1/2010 8:26", "2010-12-01 08:26", "12/1/2010"]
    got = values(spark, texts, lambda c: dates.parse_timestamp(c, "M/d/yyyy H:mm"))
    assert got == [datetime(2010, 12, 1, 8, 26), None, None, None]
    got = values(spark, ["2010-12-01 08:26:01.25", "2010-12-01T08:26:01"], lambda c: dates.parse_timestamp(c, "yyyy-MM-dd HH:mm:ss"))
    assert got == [None, None]
    for day_format, texts in {
        "d/M/yyyy H:mm": ["29/3/2026 2:30", "1/7/1950 0:00"], "yyyyMMdd": ["20260329", "2026-03-29"]
    }.items():
        before = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        try:
            got = values(spark, texts, lambda c: dates.parse_timestamp(c, day_format))
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
        assert got in (
            [datetime(2026, 3, 29, 2, 30), datetime(1950, 7, 1)], [datetime(2026, 3, 29), None]
        )


def test_dates_do_not_depend_on_the_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        texts = ["2026-03-29 02:30", "2026-10-25 02:30", "1950-07-01 00:00"]
        got = values(spark, texts, lambda c: dates.parse_timestamp(c, "yyyy-MM-dd HH:mm"))
        assert got == [datetime(2026, 3, 29, 2, 30), datetime(2026, 10, 25, 2, 30), datetime(1950, 7, 1)]
        months = values(spark, texts, lambda c: dates.month_label(dates.parse_timestamp(c, "yyyy-MM-dd HH:mm")))
        assert months == ["2026-03", "2026-10", "1950-07"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "texts, expected",
    [
        (["2026-01-05"], "yyyy-MM-dd"),
        (["12/1/2010 8:26"], "M/d/yyyy H:mm"),
        (["13/01/2026", "01/02/2026"], "d/M/yyyy"),
        (["01/02/2026"], "M/d/yyyy"),
        (["2026-01-05T10:00:00"], "yyyy-MM-dd'T'HH:mm:ss"),
        (["TBC", "1/15/2024", "2/15/2024"], "M/d/yyyy"),
        (["nonsense"], "yyyy-MM-dd"),
        (["2024-01-15T10:00:00", "2024-01-15T10:00:00.123"], dates.ISO_TIME),
        (["2024-01-15T10:00:00Z", "2024-01-15 10:00:00+02:00"], dates.ISO_ZONED),
    ],
)
@pytest.mark.parametrize("parts", [1, 3])
def test_format_comes_from_the_whole_column(spark, texts, expected, parts):
    df = spark.createDataFrame([(None,), *[(t,) for t in texts]], "d string").repartition(parts)
    assert dates.infer_date_format(df, "d") == expected


def test_iso_fractions_and_offsets(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        texts = ["2024-01-15T10:00:00Z", "2024-01-15T10:00:00.25+0230", "2024-03-10 02:30:00-05:00", "2024-01-15", "x"]
        got = values(spark, texts, lambda c: dates.parse_timestamp(c, dates.ISO_ZONED))
        assert got == [datetime(2024, 1, 15, 10), datetime(2024, 1, 15, 7, 30, 0, 250000), datetime(2024, 3, 10, 7, 30), None, None]
        local = values(spark, ["2024-03-10T02:30:00.123", "2024-01-15"], lambda c: dates.parse_timestamp(c, dates.ISO_TIME))
        assert local == [datetime(2024, 3, 10, 2, 30, 0, 123000), datetime(2024, 1, 15)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_lenient_dates(spark):
    texts = ["2026", "1/31/2026", "Jan 5, 2026", "13/40/2026", "soon"]
    assert values(spark, texts, dates.looks_like_date) == [True, True, True, False, False]


def test_months_between(spark):
    row = spark.sql("select date'2026-02-01' a, date'2024-11-01' b")
    assert row.select(dates.months_between_starts(F.col("a"), F.col("b"))).first()[0] == 15


def test_epoch_round_trip(spark):
    row = spark.sql("select timestamp_ntz'1969-12-31 23:59:59.25' t")
    assert row.select(dates.epoch_seconds(F.col("t"))).first()[0] == -0.75
    back = row.select(dates.from_epoch_seconds(dates.epoch_seconds(F.col("t")))).first()[0]
    assert back == datetime(1969, 12, 31, 23, 59, 59, 250000)


def test_three_cancellation_rules(spark):
    assert values(spark, ["C1", "1", None], cancellations.by_invoice_prefix) == [True, False, False]
    assert values(spark, ["-1", "0", None], lambda c: cancellations.by_negative_quantity(c.cast("int"))) == [
        True, False, False
    ]
    assert values(spark, ["Cancelled", "credit", "1", "10", "ok", None], cancellations.by_status_text) == [
        True, True, True, False, False, False
    ]


def test_percentages(spark):
    row = spark.sql("select 1L one, 3L three, 0L zero, 800L many, 1L tick")
    assert float(row.select(numbers.percentage(F.col("one"), F.col("three"))).first()[0]) == 33.33
    assert float(row.select(numbers.percentage(F.col("tick"), F.col("many"))).first()[0]) == 0.13
    assert row.select(numbers.percentage(F.col("one"), F.col("zero"))).first()[0] is None
    assert row.select(numbers.share(F.col("one"), F.col("zero"))).first()[0] == 0.0
    assert row.select(numbers.quality_score(F.col("zero"), F.col("zero"))).first()[0] is None
    assert row.select(numbers.quality_score(F.col("three"), F.col("one"))).first()[0] == 66.7


def test_tenths_by_binary_value(spark):
    """Against Python's own rounding: near ties, exact ties, all scores of small counts, large and odd values."""
    numbers_ = [95.65, 0.25, 0.75, 0.35, -0.25, -95.65, 0.05, 0.04999, 0.0, 1e-300, 2.0**-57, 99.95, 1e15 + 0.25]
    numbers_ += [2.0**52 + 1, 1e300, 12345678.05, 4.5e15 + 0.5, float("inf")]
    numbers_ += [100 - k / n * 100 for n in (7, 40, 200, 1000) for k in range(0, n, 3)]
    numbers_ += [k / 20 for k in range(2100)]
    df = spark.createDataFrame([(x,) for x in numbers_], "x double")
    got = [r[0] for r in df.select(numbers.rounded_to_tenths(F.col("x"))).collect()]
    assert got == [x if x == float("inf") else round(x, 1) for x in numbers_]
    assert df.limit(1).select(numbers.rounded_to_tenths(F.lit(None).cast("double"))).first()[0] is None


def test_header_detection():
    raw = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
    assert headers.detect_columns(raw) == {
        "product": "Description", "quantity": "Quantity", "customer_id": "CustomerID"
    }
    loose = headers.detect_columns(raw, strict=False)
    assert (loose["order_id"], loose["date"], loose["unit_price"]) == ("InvoiceNo", "InvoiceDate", "UnitPrice")
    coverage = headers.field_coverage(raw)
    assert [label for label, c in coverage.items() if c is None] == ["Revenue", "Cancellation flag"]
    assert headers.detect_columns(["Order ID", "date", "order_date"]) == {
        "order_id": "Order ID", "date": "order_date"
    }
    assert headers.detect_columns(["amount"]) == {"unit_price": "amount"}
    assert headers.field_coverage(["amount"])["Revenue"] == "amount"
    assert headers.field_coverage(["amount"])["Unit price"] is None
    assert headers.preview_fields(["description", "product"])["Product"] == "description"
    assert headers.preview_fields(["created at"])["Order date"] == "created at"
