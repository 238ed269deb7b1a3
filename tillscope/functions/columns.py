from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """Column of exactly this name, whatever dots, spaces or quotes it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def count_where(condition: Column, weight: Column | None = None) -> Column:
    """Number of rows meeting ``condition``; 0, not null, when there are none.

    ``weight`` is for frames that hold one row per group of equal rows.
    """
    if weight is None:
        return F.count_if(condition)
    return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0)).cast("bigint")


WHITE_SPACE = " \t\n\r\f\v\u00a0\ufeff"


def stripped(column: Column) -> Column:
    """Text without white space of any kind around it; plain trim only takes spaces."""
    return F.trim(column.cast("string"), F.lit(WHITE_SPACE))


def blank(column: Column) -> Column:
    return F.coalesce(stripped(column), F.lit("")) == ""


def na_to_null(column: Column, tokens: list[str]) -> Column:
    return F.when(~column.isin(tokens), column)
