"""CSV files with line breaks inside quotes, read in splits, and first rows by place."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F

from tillscope.operators import clean, profile
from tillscope.sources.files import PLACE, first_rows, read_csv_text, read_preview, read_raw_retail, read_upload
from tillscope.sources.records import csv_records

CELLS = ["", "plain", "a,b", "two\nlines", 'say "so"', '"', '""', "\n", ',"\n",', "ends\n", '\n"x', "é\n\n\n", "5\" pipe", " lead"]


def write(path, rows, columns, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator=end)
        writer.writerow(columns)
        writer.writerows(rows)
    return str(path)


@pytest.fixture
def splits(spark):
    """Reads with the given size of a split."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield use
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def whole_file(spark, path):
    """Spark's own reading, a file in one task."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("inferSchema", False)
    return [tuple(r) for r in reader.csv(path).collect()]


@pytest.mark.parametrize("seed", range(4))
def test_split_reading_is_the_reading_of_whole_files(spark, tmp_path, splits, seed):
    rng = random.Random(seed)
    rows = [[str(i), *(rng.choice(CELLS) for _ in range(3))] for i in range(120)]
    path = write(tmp_path / "rows.csv", rows, ["id", "a", "b", "c"])
    expected = sorted(whole_file(spark, path), key=repr)
    assert len(expected) == 120
    for size in (61, 200, 1 << 20):
        splits(size)
        got = read_csv_text(spark, path, multi_line=True)
        assert sorted(map(tuple, got.collect()), key=repr) == expected
    splits(61)
    parts = csv_records(spark, path)
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    assert [r.record.split(",")[0] for r in parts.orderBy("file", "block", "row").collect()] == ["id", *map(str, range(120))]


def test_files_of_a_folder_line_ends_and_short_rows(spark, tmp_path, splits):
    splits(40)
    columns = ["id", "a", "b"]
    write(tmp_path / "one.csv", [["1", "x\ny", "z"], ["2", "p"], ["3", "q", "r"]], columns)
    write(tmp_path / "two.csv", [["4", "last\n\nbreak", "w"]], columns, end="\r\n")
    (tmp_path / "three.csv").write_text("\n\nid,a,b\n")
    got = sorted(tuple(r) for r in read_upload(spark, f"{tmp_path}/*.csv", multi_line=True).collect())
    assert got == [("1", "x\ny", "z"), ("2", "p", None), ("3", "q", "r"), ("4", "last\n\nbreak", "w")]
    long = write(tmp_path / "long.csv", [["1", "a\nb", "c", "d"]], columns)
    with pytest.raises(Exception, match="more cells than the header"):
        read_csv_text(spark, long, multi_line=True).collect()


def test_a_quote_that_never_closes_fails(spark, tmp_path):
    path = tmp_path / "open.csv"
    path.write_text("id,a\n1,ok\n2,\"open\n" + "x\n" * 50)
    with pytest.raises(Exception, match="more than 20 lines"):
        csv_records(spark, str(path), most_lines=20).collect()
    assert csv_records(spark, str(path)).count() == 3


def test_long_cells_and_a_long_line(spark, tmp_path, splits):
    splits(10_000)
    cell = ('"quoted" and ' * 20_000) + "\n" + "tail"
    path = write(tmp_path / "wide.csv", [["1", cell], ["2", "y"]], ["id", "a"])
    assert sorted(tuple(r) for r in read_csv_text(spark, path, multi_line=True).collect()) == [("1", cell), ("2", "y")]


def test_the_preview_is_the_first_lines_at_any_split(spark, tmp_path, splits):
    rows = [[str(i), f"v{i}" * (i % 7)] for i in range(5000)]
    path = write(tmp_path / "many.csv", rows, ["id", "a"])
    for size in (500, 4000, 1 << 20):
        splits(size)
        preview = read_preview(spark, path)
        assert [r["id"] for r in preview.collect()] == [str(i) for i in range(300)]
        assert "TakeOrderedAndProject" in preview._jdf.queryExecution().executedPlan().toString()
    shuffled = read_csv_text(spark, path, place=True).repartition(7, F.rand(3))
    assert [r["id"] for r in first_rows(shuffled, 4).collect()] == ["0", "1", "2", "3"]
    both = read_csv_text(spark, path, multi_line=True, place=True)
    assert [r["id"] for r in first_rows(both, 3).collect()] == ["0", "1", "2"] and PLACE in both.columns


def test_profile_heads_are_the_first_rows(spark, tmp_path, splits):
    splits(700)
    header = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
    rows = [[("C" if i % 10 == 9 else "") + str(i), "A", "pen", "1", "2010-12-01 08:26:00", "1.5", "17850", "UK"] for i in range(400)]
    path = write(tmp_path / "sheet.csv", rows + rows[:50], header)
    raw = read_raw_retail(spark, path, place=True)
    parts = profile.profile_raw(raw)
    assert [r["InvoiceNo"] for r in parts["head"].collect()] == ["0", "1", "2", "3", "4"]
    assert [r["InvoiceNo"] for r in parts["cancellation_sample"].collect()] == ["C9", "C19", "C29", "C39", "C49"]
    assert parts["duplicates"].first()[0] == 50 and parts["shape"].first()["columns"] == 8
    steps = profile.profile_cleaning(clean.price_lines(raw))
    assert [r["InvoiceNo"] for r in steps["head"].collect()] == ["0", "1", "2", "3", "4"]
    assert steps["rows_remaining"].first()["rows"] == 400 and PLACE not in steps["head"].columns
