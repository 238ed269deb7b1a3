"""Catalog sources: the public fact table and the tenants' rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.schemas import TENANT_TRANSACTIONS, TRANSACTIONS

PUBLIC_TABLE = "transactions"
TENANT_TABLE = "user_transactions"


def ensure_tenant_table(spark: SparkSession, table: str = TENANT_TABLE, location: str | None = None) -> None:
    """Creates the tenants' table, a partition per owner, unless it exists."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({TENANT_TRANSACTIONS.toDDL()}) "
        f"USING parquet PARTITIONED BY (owner_id){at}"
    )


def table_columns(spark: SparkSession, table: str) -> set[str]:
    """Column names, empty for a table that does not exist."""
    if not spark.catalog.tableExists(table):
        return set()
    return {column.name for column in spark.catalog.listColumns(table)}


def tenant_rows(rows: DataFrame, owner_id: int) -> DataFrame:
    """One tenant's rows; on a table partitioned by owner only its files are read."""
    return rows.where(F.col("owner_id") == owner_id)


def as_transactions(tenant: DataFrame) -> DataFrame:
    """Tenant rows in the shape of the public table; the stock code is unknown."""
    known = tenant.columns
    return tenant.select(
        *[
            F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name)
            for f in TRANSACTIONS
        ],
        *[c for c in known if c == "owner_id"],
    )


def source_rows(spark: SparkSession, owner_id: int | None = None) -> DataFrame:
    """The public table, or one tenant's rows for a known caller, who may have none yet."""
    if owner_id is None:
        return spark.table(PUBLIC_TABLE)
    ensure_tenant_table(spark)
    return as_transactions(tenant_rows(spark.table(TENANT_TABLE), owner_id))
