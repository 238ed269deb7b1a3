"""Join of many rows to one row per key, safe for keys that hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions.columns import named
from tillscope.session import stored

# This many of the heaviest keys are broadcast, whatever the data. Any other key
# is lighter than each of them and so holds less than 1/1000 of the weight.
HOT_KEYS = 1000


def hot_keys(per_key: DataFrame, key: str, weight: str) -> DataFrame:
    """The heaviest keys. Keys are unique, so the order and the choice are fixed."""
    return per_key.orderBy(F.desc(weight), F.asc(key)).limit(HOT_KEYS)


#: Rows of a hot key are spread over this many parts of the shuffle.
SALTS = 64


def join_salted(rows: DataFrame, per_key: DataFrame, key: str, weight: str, how: str = "inner") -> DataFrame:
    """Join ``rows``, read once, to ``per_key``, which has unique keys and their ``weight``.

    For rows that are costly to read twice. Rows of hot keys, and rows without a key in
    a left join, get a salt from their content; a hot key is there once for each salt.
    The 1000 hot keys are broadcast to mark their rows. ``per_key`` is needed twice and
    is stored, so it is computed once whatever the planner shares.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join: {how}")
    per_key = stored(per_key, "per-key")
    hot = hot_keys(per_key, key, weight).select(F.col(key).alias("_hot"))
    spread = F.pmod(F.xxhash64(*[named(c) for c in rows.columns]), F.lit(SALTS)).cast("int")
    salted = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull() | F.col(key).isNull(), spread).otherwise(F.lit(0))
    )
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    looked_up = per_key.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    looked_up = looked_up.withColumn(
        "_salt", F.explode(F.when(F.col("_hot").isNotNull(), every).otherwise(F.array(F.lit(0))))
    )
    joined = salted.drop("_hot").join(looked_up.drop("_hot", weight), [key, "_salt"], how)
    added = [c for c in per_key.columns if c not in (key, weight)]
    return joined.select(*rows.columns, *added)


def join_per_key(rows: DataFrame, per_key: DataFrame, key: str, weight: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``per_key``, which has unique keys and their ``weight``.

    ``per_key`` must have every key that may be heavy, with a weight no less than
    its number of ``rows``. Rows of hot keys, and in a left join rows without a
    key, meet a broadcast of the hot keys where they are and are never shuffled.
    Only the others go through the shuffle, where no key holds 1/1000 of the
    weight. Both parts read ``rows``: cheap when it ends in an aggregation, whose
    shuffle they share.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join: {how}")
    # Always true, but it makes both uses of per_key need the weight, so that
    # they are the same aggregation and Spark computes it once.
    per_key = per_key.where(F.col(weight) > 0)
    looked_up = [c for c in per_key.columns if c not in (key, weight)]
    # One struct of everything looked up, again so that both uses are the same.
    hot = hot_keys(per_key, key, weight).select(
        key, F.struct(F.lit(True).alias("found"), *looked_up).alias("_hot")
    )
    # An anti join for the second part would be pushed below an aggregation in
    # ``rows`` and compute it twice; with a marked outer join both parts share it.
    marked = rows.join(F.broadcast(hot), key, "left")
    stays = F.col("_hot").isNotNull()
    if how == "left":
        stays = stays | F.col(key).isNull()
    stay = marked.where(stays).select(*rows.columns, *[F.col(f"_hot.{c}").alias(c) for c in looked_up])
    move = marked.where(F.col("_hot").isNull() & F.col(key).isNotNull()).select(*rows.columns)
    moved = move.join(per_key.drop(weight), key, how)
    return stay.unionByName(moved)
