"""Keyed upsert: the latest row per key wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert_latest(
    base: DataFrame, changes: DataFrame, keys: list[str], order_column: str, stamp: Column | None = None
) -> DataFrame:
    """``base`` with ``changes`` applied, one row per key.

    The greatest ``order_column`` wins, a change before a base row of the same
    time, then the greatest remaining values, so the result never depends on row
    order. The winner is an aggregate, not a window: rows of a key meet the
    winner of their task first and a key with most rows cannot fill one task.
    ``stamp`` (for example ``current_timestamp()``) sets the time of all changes.
    """
    if stamp is not None:
        changes = changes.withColumn(order_column, stamp)
    rest = [c for c in base.columns if c not in keys and c != order_column]
    rows = (
        base.withColumn("_change", F.lit(0)).unionByName(changes.withColumn("_change", F.lit(1)))
    )
    winner = F.max(F.struct(order_column, "_change", *rest)).alias("_winner")
    merged = rows.groupBy(*keys).agg(winner)
    return merged.select(
        *[F.col(c) if c in keys else F.col(f"_winner.{c}").alias(c) for c in base.columns]
    )
