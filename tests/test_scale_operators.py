"""Skew-safe joins, exact quantiles, upsert and row merging against brute force."""

from __future__ import annotations

import random
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import tuples
from tillscope.operators import joins, profile
from tillscope.operators.joins import join_per_key
from tillscope.operators.quantiles import exact_quantiles
from tillscope.operators.upsert import upsert_latest


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have one key, a third none, and some keys are unknown."""
    rng = random.Random(5)
    keys = ["hot"] * 400 + [None] * 400 + [f"k{rng.randrange(150)}" for _ in range(400)]
    rows = [(k, i) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "key string, n int"), rows


@pytest.mark.parametrize("hot", [0, 1, 7, 1000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_per_key(spark, skewed, monkeypatch, hot, how):
    monkeypatch.setattr(joins, "HOT_KEYS", hot)
    df, rows = skewed
    counts = Counter(k for k, _ in rows if k is not None)
    known = {k: (k.upper(), c) for k, c in counts.items() if k == "hot" or int(k[1:]) % 2}
    per_key = spark.createDataFrame([(k, *v) for k, v in known.items()], "key string, label string, w long")
    got = sorted(map(repr, tuples(join_per_key(df, per_key, "key", "w", how))))
    expected = [
        (k, n, known[k][0] if k in known else None) for k, n in rows if how == "left" or k in known
    ]
    assert got == sorted(map(repr, expected))


def test_join_broadcasts_hot_keys_only(spark, skewed):
    df, _ = skewed
    per_key = df.where("key is not null").groupBy("key").agg(F.count("*").alias("w"))
    joined = join_per_key(df, per_key.withColumn("label", F.lit(1)), "key", "w")
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "GlobalLimit 1000" in text
    with pytest.raises(ValueError):
        join_per_key(df, per_key, "key", "w", "full")


@pytest.mark.parametrize("salts", [1, 7])
@pytest.mark.parametrize("hot", [0, 1, 1000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_salted(spark, skewed, monkeypatch, hot, how, salts):
    monkeypatch.setattr(joins, "HOT_KEYS", hot)
    monkeypatch.setattr(joins, "SALTS", salts)
    df, rows = skewed
    counts = Counter(k for k, _ in rows if k is not None)
    known = {k: (k.upper(), c) for k, c in counts.items() if k == "hot" or int(k[1:]) % 2}
    per_key = spark.createDataFrame([(k, *v) for k, v in known.items()], "key string, label string, w long")
    got = sorted(map(repr, tuples(joins.join_salted(df, per_key, "key", "w", how))))
    expected = [(k, n, known[k][0] if k in known else None) for k, n in rows if how == "left" or k in known]
    assert got == sorted(map(repr, expected))


def test_quantiles_of_large_whole_numbers(spark):
    values = [2**60 + k // 3 for k in range(50)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = {r[1]: r[2] for r in exact_quantiles(df, ["v"], [0.5, 1.0], 2, 3).collect()}
    assert got == {0.5: float(2**60), 1.0: float(2**60)}


def test_mean_of_decimals_does_not_depend_on_order(spark):
    amounts = [Decimal("0.1"), Decimal("1000000000000.7"), Decimal("-1000000000000.3")] * 50
    df = spark.createDataFrame([(a,) for a in amounts], "v decimal(20,4)")
    for part in (df.coalesce(1), df.repartition(7), df.orderBy("v")):
        assert profile.describe(part).first()["mean"] == float(Decimal("0.5") / 3)


@pytest.mark.parametrize("sorted_values", [3, 40, 100_000])
@pytest.mark.parametrize("fan", [2, 5, 16])
def test_quantiles_match_numpy(spark, fan, sorted_values):
    rng = random.Random(fan)
    a = [None if rng.random() < 0.1 else round(rng.gauss(0, 50), 2) for _ in range(700)]
    b = [7.0] * 300 + [float(rng.randrange(5)) for _ in range(400)]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r[0], float(r[1])): r[2] for r in exact_quantiles(df, ["a", "b"], probabilities, fan, sorted_values).collect()}
    for name, data in (("a", [x for x in a if x is not None]), ("b", b)):
        for p in probabilities:
            assert got[(name, p)] == pytest.approx(np.quantile(data, p), abs=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3), st.floats(-1e6, 1e6)), min_size=1, max_size=40))
def test_quartiles_property(spark, data):
    present = [float(x) for x in data if x is not None]
    df = spark.createDataFrame([(None if x is None else float(x),) for x in data], "v double")
    got = {float(r[1]): r[2] for r in exact_quantiles(df, ["v"], [0.25, 0.5, 0.75], 2, 4).collect()}
    assert len(got) == (3 if present else 0)
    for p, v in got.items():
        assert v == pytest.approx(np.quantile(present, p), rel=1e-9, abs=1e-6)


def test_describe(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None)], "a double, b double")
    rows = {r["column"]: r for r in profile.describe(df).collect()}
    a = rows["a"]
    assert (a["count"], a["mean"], a["min"], a["q25"], a["q50"], a["q75"], a["max"]) == (4, 4.0, 1, 1.75, 2.5, 4.75, 10)
    assert a["std"] == pytest.approx(np.std([1, 2, 3, 10], ddof=1))
    assert rows["b"]["count"] == 0 and rows["b"]["q50"] is None and rows["b"]["mean"] is None


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", 1), (None, None), (None, None)], "x string, y int")
    assert profile.duplicate_count(df).first()[0] == 2
    assert profile.duplicate_count(df.limit(0)).first()[0] == 0


def test_upsert(spark):
    ddl = "owner_id int, name string, updated_at int"
    base = spark.createDataFrame([(1, "old", 5), (2, "kept", 5), (3, "newer", 9)], ddl)
    changes = spark.createDataFrame([(1, "first", 6), (1, "last", 7), (3, "stale", 8), (4, "added", 1), (2, "same time", 5)], ddl)
    got = sorted(tuples(upsert_latest(base, changes, ["owner_id"], "updated_at")))
    assert got == [(1, "last", 7), (2, "same time", 5), (3, "newer", 9), (4, "added", 1)]
    stamped = upsert_latest(base, changes.where("owner_id = 3"), ["owner_id"], "updated_at", F.lit(99))
    assert sorted(tuples(stamped))[2] == (3, "stale", 99)


def test_upsert_does_not_depend_on_row_order(spark):
    ddl = "owner_id int, name string, updated_at int"
    rows = [(1, n, 5) for n in "abcdef"]
    base = spark.createDataFrame([(1, "z", 4)], ddl)
    for order in (rows, rows[::-1]):
        changes = spark.createDataFrame(order, ddl)
        assert tuples(upsert_latest(base, changes, ["owner_id"], "updated_at")) == [(1, "f", 5)]


def test_duplicates_by_fingerprint(spark, monkeypatch):
    """Same counts with few and with many fingerprints, and when all fingerprints collide."""
    from pyspark.sql import functions as F

    from tillscope.operators import profile

    rows = [(i % 40, None if i % 3 else "x", float(i % 7)) for i in range(600)] + [(None, None, None)] * 3 + [(None, "x", None)]
    df = spark.createDataFrame(rows, "a int, `b.c` string, d double")
    expected = len(rows) - len(set(rows))
    assert profile.duplicate_count(df).first()[0] == expected
    assert profile.duplicate_count(df, few=0).first()[0] == expected
    assert profile.duplicate_count(df.limit(0)).first()[0] == 0 and profile.duplicate_count(df.dropDuplicates()).first()[0] == 0
    monkeypatch.setattr(profile, "fingerprint", lambda df: F.struct(F.lit(1).alias("a"), F.lit(2).alias("b")))
    assert profile.duplicate_count(df).first()[0] == expected


def test_fingerprints_move_without_the_cells(spark, tmp_path):
    from tillscope.operators import profile

    wide = spark.range(1000).selectExpr("id % 900 as id", *[f"repeat('x', 200) as c{i}" for i in range(30)])
    wide.write.parquet(str(tmp_path / "wide"))
    df = spark.read.parquet(str(tmp_path / "wide"))
    seen = []
    original = profile.stored
    profile.stored = lambda frame, name: seen.append(frame) or original(frame, name)
    try:
        assert profile.duplicate_count(df).first()[0] == 100
    finally:
        profile.stored = original
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    exchange = next(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert "c1#" not in exchange and "_fingerprint" in exchange


def test_many_fingerprints_pick_rows_by_bits(spark, monkeypatch):
    """With many repeated fingerprints, rows that occur once mostly stay where they are."""
    from tillscope.operators import profile

    df = spark.range(20_000).selectExpr("if(id < 2000, id % 1000, id) as id", "if(id % 3 = 0, null, 'x') as c", "null as _copy")
    seen = []
    original = profile.row_copies
    monkeypatch.setattr(profile, "row_copies", lambda frame, name="copies": seen.append(frame) or original(frame, name))
    expected = df.count() - df.distinct().count()
    assert expected > 0 and profile.duplicate_count(df, few=0).first()[0] == expected
    assert seen[0].columns == df.columns
    repeated = df.groupBy(*df.columns).count().where("count > 1").agg({"count": "sum"}).first()[0]
    assert repeated <= seen[0].count() < repeated + 4000


def test_sheet_is_made_once(spark, monkeypatch, tmp_path):
    """The stored sheet is what the operator reads, not the joins behind it."""
    from registry import catalog
    from tillscope.operators import profile

    seen = []
    monkeypatch.setattr(profile, "duplicate_count", lambda df: seen.append(df) or df)
    catalog._stored_duplicates(spark.createDataFrame([(1,), (1,)], "a int").join(spark.range(1)))
    assert "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString() and seen[0].count() == 2
