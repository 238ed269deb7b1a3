"""Result rows as an API would return them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.functions.columns import named
from tillscope.functions.dates import month_label


def api_rows(result: DataFrame) -> DataFrame:
    """Months (dates) as yyyy-MM text and decimals as doubles."""

    def shaped(field: T.StructField):
        column = named(field.name)
        if isinstance(field.dataType, T.DateType):
            column = month_label(column)
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        return column.alias(field.name)

    return result.select(*[shaped(field) for field in result.schema])


def json_rows(result: DataFrame) -> DataFrame:
    """One JSON object per row, in a column ``value``, ready to be written as text."""
    shaped = api_rows(result)
    return shaped.select(F.to_json(F.struct(*[named(c) for c in shaped.columns]), {"ignoreNullFields": "false"}).alias("value"))
