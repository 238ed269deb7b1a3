"""Partitions that are replaced as a whole: rows go to a fresh folder, then the catalog is switched to it.

A partition of a catalog table is the folder that the catalog names for it. New rows
are written to a folder of their own below ``_versions`` in the table, where nobody
reads, and one catalog command makes that folder the partition. A reader that has
planned before goes on with the old files, one that plans later has the new ones, and
no reader sees some of both. A writer that dies before the switch leaves a folder that
nobody names. Folders that are no longer named stay for the readers that still use
them, until ``drop_old_versions`` is told that they are old enough.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

VERSIONS = "_versions"
#: Seconds that a folder stays after it was written: longer than any reader runs.
RETENTION = 7 * 24 * 3600


def table_location(spark: SparkSession, table: str) -> str:
    """The folder of a catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location").rstrip("/")


def partition_location(spark: SparkSession, table: str, column: str, value: int) -> str | None:
    """The folder that the catalog names for a partition; None for one that isn't there."""
    if spark.sql(f"SHOW PARTITIONS {table} PARTITION ({column} = {int(value)})").isEmpty():
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({column} = {int(value)})").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location").rstrip("/")


def fresh_folder(spark: SparkSession, table: str) -> str:
    """A folder of the table that no reader looks into and no other writer uses."""
    return f"{table_location(spark, table)}/{VERSIONS}/{uuid.uuid4().hex}"


def switch_partition(spark: SparkSession, table: str, column: str, value: int, folder: str) -> None:
    """Makes ``folder`` the partition, in one catalog command."""
    spec, place = f"({column} = {int(value)})", folder.replace("'", "\\'")
    if spark.sql(f"SHOW PARTITIONS {table} PARTITION {spec}").isEmpty():
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION {spec} LOCATION '{place}'")
        if partition_location(spark, table, column, value) == folder:
            return
    spark.sql(f"ALTER TABLE {table} PARTITION {spec} SET LOCATION '{place}'")
    spark.catalog.refreshTable(table)


def replace_partition(rows: DataFrame, table: str, column: str, value: int) -> int:
    """Makes ``rows`` (without ``column``) all there is in a partition; returns their number.

    An empty frame empties the partition. Rows are written by the tasks they are in, so
    a partition with most rows of the table isn't gathered in one. They are counted from
    the files that were written.
    """
    spark = rows.sparkSession
    folder = f"{fresh_folder(spark, table)}/{column}={int(value)}"
    rows.write.parquet(folder)
    count = spark.read.schema(rows.schema).parquet(folder).count()
    switch_partition(spark, table, column, value, folder)
    return count


def drop_old_versions(spark: SparkSession, table: str, column: str, retention: float = RETENTION) -> int:
    """Deletes folders below ``_versions`` that no partition names and that are older than ``retention`` seconds.

    Returns how many partition folders went. Folders are looked at one by one, rows never.
    """
    root = f"{table_location(spark, table)}/{VERSIONS}"
    files = spark._jvm.org.apache.hadoop.fs
    at = files.Path(root)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(at):
        return 0
    before, gone = (time.time() - retention) * 1000, 0
    for version in system.listStatus(at):
        parts = system.listStatus(version.getPath())
        left = len(parts)
        for part in parts:
            name, _, value = part.getPath().getName().partition("=")
            if name != column or part.getModificationTime() > before:
                continue
            named = partition_location(spark, table, column, int(value))
            if named is not None and files.Path(named).toUri().getPath() == part.getPath().toUri().getPath():
                continue
            system.delete(part.getPath(), True)
            gone, left = gone + 1, left - 1
        if not left and version.getModificationTime() <= before:
            system.delete(version.getPath(), True)
    return gone
