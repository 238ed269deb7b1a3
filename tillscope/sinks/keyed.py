"""Keyed upsert of a stored table: only the buckets that have changes are read and written.

The table is partitioned by a bucket of the keys' hash. Changes are dealt to buckets;
the buckets they touch are read, merged and written to fresh folders, and each is
switched to its new folder as a whole (``versions``). All other buckets stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.operators.upsert import upsert_latest
from tillscope.session import stored
from tillscope.sinks.versions import fresh_folder, switch_partition

BUCKET = "_bucket"
BUCKETS = 64


def bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def create_keyed(base: DataFrame, table: str, keys: list[str], buckets: int = BUCKETS, location: str | None = None) -> None:
    """Stores ``base``, one row per key, as a table in buckets of its keys.

    The keys and the number of buckets are kept with the table, so that every later
    upsert deals alike. A bucket should fit a task: rows / buckets at the size to come.
    """
    spark = base.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)
    at = f" LOCATION '{location}'" if location else ""
    properties = f"'keyed.keys' = '{','.join(keys)}', 'keyed.buckets' = '{int(buckets)}'"
    spark.sql(
        f"CREATE TABLE {table} ({columns}, {BUCKET} int) USING parquet PARTITIONED BY ({BUCKET}){at} TBLPROPERTIES ({properties})"
    )
    _write(base.withColumn(BUCKET, bucket(keys, buckets)), table, list(range(buckets)))


def keyed_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a keyed table."""
    return spark.table(table).drop(BUCKET)


def _layout(spark: SparkSession, table: str) -> tuple[list[str], int]:
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return found["keyed.keys"].split(","), int(found["keyed.buckets"])


def _write(rows: DataFrame, table: str, touched: list[int]) -> None:
    spark = rows.sparkSession
    folder = fresh_folder(spark, table)
    # rows of a bucket come together, large ones in several files
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)
    there = {r[0] for r in spark.read.schema(rows.schema).parquet(folder).select(BUCKET).distinct().collect()}
    for number in touched:
        if number in there:
            switch_partition(spark, table, BUCKET, number, f"{folder}/{BUCKET}={number}")


def touched_buckets(changes: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """Numbers of the buckets that have changes: at most as many as there are buckets."""
    return sorted(r[0] for r in changes.select(bucket(keys, buckets)).distinct().collect())


def rows_to_merge(spark: SparkSession, table: str, touched: list[int]) -> DataFrame:
    """The stored rows of some buckets; the others are pruned before their files are listed."""
    return spark.table(table).where(F.col(BUCKET).isin(touched)).drop(BUCKET)


def upsert_stored(changes: DataFrame, table: str, order_column: str, stamp: Column | None = None) -> list[int]:
    """Applies ``changes`` to a keyed table as ``upsert_latest`` does; returns the buckets that were written.

    Readers see each bucket before or after the upsert, never in between. Buckets are
    switched one by one: a job that dies between two leaves every key at its old or its
    new row, and the same upsert run again ends what is left, as the latest row wins. An
    empty frame changes nothing. One writer at a time.
    """
    spark = changes.sparkSession
    keys, buckets = _layout(spark, table)
    if stamp is not None:
        changes = changes.withColumn(order_column, stamp)
    changes = stored(changes, "upsert-changes")  # one evaluation for the dealing and the merge
    touched = touched_buckets(changes, keys, buckets)
    if not touched:
        return []
    merged = upsert_latest(rows_to_merge(spark, table, touched), changes, keys, order_column)
    _write(merged.withColumn(BUCKET, bucket(keys, buckets)), table, touched)
    return touched
