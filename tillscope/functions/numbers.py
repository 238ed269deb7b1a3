from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillscope.functions.columns import stripped

# A JVM cast would also take "1d" or "2f"; only plain decimal notation counts.
PLAIN_NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)$"


def to_number(column: Column) -> Column:
    """Double, or null where the text is not a number."""
    return stripped_number(stripped(column))


def stripped_number(text: Column) -> Column:
    """The same for a text without white space around it."""
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def is_finite(number: Column) -> Column:
    return number.isNotNull() & (F.abs(number) < F.lit(float("inf")))


def percentage(part: Column, whole: Column) -> Column:
    """Exact percentage to 2 places, halves away from zero; null for an empty whole."""
    ratio = F.try_divide(part * F.lit(Decimal("100.0")), whole.cast("decimal(20,0)"))
    return F.round(ratio, 2).cast("decimal(9,2)")


def rounded_to_tenths(value: Column) -> Column:
    """A double to 1 place by its binary value: 95.65 is stored a little above the tie and gives 95.7.

    Exact ties go to the even digit. Below the point a double above 1/32 is a whole
    number of 2**-57, so the digit and what is left over are found in whole numbers;
    smaller values round to 0. From 2**52 up there is nothing to round.
    """
    magnitude = F.abs(value)
    whole = F.floor(magnitude)
    ticks = ((magnitude - whole) * float(1 << 57)).cast("bigint") * 10
    digit = F.shiftright(ticks, 57)
    rest = ticks.bitwiseAND(F.lit((1 << 57) - 1))
    half = F.lit(1 << 56)
    up = (rest > half) | ((rest == half) & (digit % 2 == 1))
    tenths = whole * 10 + digit + F.when(up, 1).otherwise(0)
    rounded = (tenths.cast("decimal(20,0)") / 10).cast("decimal(21,1)").cast("double")
    small = F.when(value < 0, -rounded).otherwise(rounded)
    return F.when(magnitude < float(1 << 52), small).otherwise(value)


def share(part: Column, total: Column) -> Column:
    """Share of a total in percent to 1 place; 0 when the total is 0."""
    part, total = part.cast("double"), total.cast("double")
    percent = F.try_divide(part * 100, total)
    return F.when(total != 0, rounded_to_tenths(percent)).otherwise(F.lit(0.0))


def quality_score(rows: Column, incomplete: Column) -> Column:
    """Percent of complete rows to 1 place; null when there are no rows."""
    bad = F.try_divide(incomplete.cast("double"), rows.cast("double")) * 100
    return F.when(rows > 0, rounded_to_tenths(F.greatest(F.lit(0.0), F.lit(100.0) - bad)))


def rounded_percent(part: Column, rows: Column) -> Column:
    """Whole percent, halves up, never below 0; null when there are no rows."""
    value = F.floor(F.try_divide(F.lit(100.0) * part, rows.cast("double")) + 0.5)
    return F.when(rows > 0, F.greatest(F.lit(0), value).cast("bigint"))
