from __future__ import annotations

import collections
import glob
import hashlib
import re

import pytest

from tillscope.llm import warc

SCHEMA = "page_id long, url string, html string, digest string"


def sample():
    inner = "x" * 1200 + "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\nWARC/1.0\r\n" + "yé" * 300 + "\r\n\r\n"
    rows = [(100 + i, f"http://x/{i}", f"<p>page {i}</p>" * i, "c") for i in range(40)]
    rows += [(200 + i, "u", inner, "c") for i in range(5)]
    rows += [(300 + i, None, "WARC/1.0\r\n" * i, "c") for i in range(12)]
    rows += [(400, "a b\r\nWARC-Type: revisit", None, "c"), (401, "u", "", "c"), (None, "u", "z" * 2000, "c"), (402, "u", "z" * 2000, "c")]
    rows += [(403, "u", "é" * 499, "c"), (404, "u", "é" * 499, "c"), (405, "u", "é" * 500, "c"), (406, "u", "é" * 500, "c")]
    rows += [(407, "u", "\r\n\r\n", "c"), (408, "u", "\r\n\r\nWARC/1.0\r\n", "c"), (409, "u", "long " * 60_000, "c")]
    rows += [(None, "u", "q" * 1500, "c"), (None, "u", "q" * 1500, "c"), (410, "u", "r" * 1500, "c"), (410, "u", "r" * 1500, "c")]
    return rows


def brute(rows):
    groups = collections.defaultdict(list)
    for i, _, html, _ in rows:
        groups[(html or "").encode()].append(i)
    out = []
    for payload, ids in groups.items():
        largest = max((i for i in ids if i is not None), default=None)
        for i in ids:
            revisit = len(payload) >= 1000 and len(ids) > 1 and largest is not None and i != largest
            out.append((i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", largest if revisit else None))
    return sorted(out, key=repr)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_round_trip_in_small_splits(spark, small_splits, tmp_path):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = warc.archived_pages(df, str(tmp_path / "a"), file_records=10)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    files = glob.glob(str(tmp_path / "a" / "part-*"))
    assert len(files) >= 4
    for name in files:  # read one after the other, by the lengths alone
        data = open(name, "rb").read()
        at = 0
        while at < len(data):
            assert data[at : at + 10] == b"WARC/1.0\r\n"
            head, _, _ = data[at:].partition(b"\r\n\r\n")
            at += len(head) + 4 + int(re.search(rb"\nContent-Length: (\d+)", head)[1])
            assert data[at : at + 4] == b"\r\n\r\n"
            at += 4


def test_without_a_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", -1)
    rows = sample()
    got = warc.archived_pages(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "a"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_a_broken_file_gives_what_comes_before_the_break(spark, tmp_path):
    rows = [(i, "u", f"text {i}", "c") for i in range(6)]
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), str(tmp_path / "a"))
    (name,) = glob.glob(str(tmp_path / "a" / "part-*"))
    data = open(name, "rb").read()
    third = [m.start() for m in re.finditer(rb"WARC/1.0", data)][3]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "one.warc").write_bytes(data[:third] + b"junk" + data[third:])
    assert sorted(r.page_id for r in warc.read_archives(spark, str(tmp_path / "b")).collect()) == [0, 1, 2]


def test_empty_table(spark, tmp_path):
    assert warc.archived_pages(spark.createDataFrame([], SCHEMA), str(tmp_path / "a")).count() == 0
