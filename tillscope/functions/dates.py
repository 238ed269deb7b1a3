"""Months and date parsing, all independent of the session time zone."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions.columns import named, stripped

# ISO times whose fraction may have any length, without and with an offset or Z.
# Times with an offset are taken to UTC.
ISO_TIME, ISO_ZONED = "ISO time", "ISO time with offset"

# The format that fits most values of a column is its format. Of equally good ones
# the first in this order is taken, so month comes before day when both always fit.
DATE_FORMATS = [
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy/MM/dd",
    "yyyy/MM/dd HH:mm:ss",
    "M/d/yyyy",
    "M/d/yyyy H:mm",
    "M/d/yyyy H:mm:ss",
    "d/M/yyyy",
    "d/M/yyyy H:mm",
    "d/M/yyyy H:mm:ss",
    "d-M-yyyy",
    "d.M.yyyy",
    "yyyyMMdd",
    "d MMM yyyy",
    "MMM d, yyyy",
    ISO_TIME,
    ISO_ZONED,
]


def epoch_ntz() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def month_start(column: Column) -> Column:
    """First day of the month, as a DATE so that no time zone is involved."""
    return F.trunc(column, "month")


def month_label(column: Column) -> Column:
    return F.date_format(month_start(column), "yyyy-MM")


def months_between_starts(later: Column, earlier: Column) -> Column:
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def epoch_seconds(column: Column) -> Column:
    """Exact seconds since 1970 of a zone-free timestamp."""
    return (column - epoch_ntz()).cast("interval second").cast("decimal(24,6)")


def from_epoch_seconds(seconds: Column) -> Column:
    return epoch_ntz() + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


# Formats that a plain cast reads, much faster than a formatter; the pattern
# keeps the cast from also taking the other ISO notations.
ISO_PATTERNS = {
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
    "yyyy-MM-dd HH:mm": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$",
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    "yyyy-MM-dd'T'HH:mm:ss": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$",
    "yyyy-MM-dd HH:mm:ss.SSSSSS": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{6}$",
    ISO_TIME: r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$",
}
ZONED_PATTERN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})$"


#: What the fields of a format can be at most; a text that isn't of this shape can't fit.
_MONTH, _DAY, _NAME, _NUMBER = r"0*(?:1[0-2]|[1-9])", r"0*(?:[12]\d|3[01]|[1-9])", r"\D+", r"[-+]?\d++"


def shape_pattern(date_format: str) -> str | None:
    """A pattern that every text of the format matches, far cheaper than a failed parse; None if there's none."""
    if not re.fullmatch(r"[yMdHms/.:, -]+", date_format):
        return None
    parts = []
    for letters, sign in re.findall(r"([A-Za-z]+)|([^A-Za-z])", date_format):
        if sign:
            parts.append(re.escape(sign))
        elif len(set(letters)) > 1:  # fields without a sign between them
            if "MMM" in letters:
                return None
            parts.append(_NUMBER)
        elif letters.startswith("MMM"):
            parts.append(_NAME)
        else:
            parts.append({"M": _MONTH, "d": _DAY}.get(letters[0], _NUMBER))
    return f"^{''.join(parts)}$"


def parse_timestamp(column: Column, date_format: str) -> Column:
    """Zone-free timestamp; null where the text does not fit the format."""
    return parse_stripped(stripped(column), date_format)


def parse_stripped(text: Column, date_format: str) -> Column:
    """The same for a text without white space around it."""
    if date_format in ISO_PATTERNS:
        return F.when(text.rlike(ISO_PATTERNS[date_format]), text.try_cast("timestamp_ntz"))
    if date_format == ISO_ZONED:
        # with its offset in the text, the instant does not depend on the session's zone
        colon = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2")
        instant = F.when(text.rlike(ZONED_PATTERN), colon.try_cast("timestamp"))
        return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch_ntz())
    # Read as UTC and counted from the epoch, so that a daylight-saving gap of the
    # session's zone cannot move the time.
    instant = F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(date_format + " xx"))
    if shape := shape_pattern(date_format):
        instant = F.when(text.rlike(shape), instant)
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch_ntz())


def infer_date_format(df: DataFrame, column: str) -> str:
    """The format that fits most values of the column, from one aggregation over all of them.

    Equal texts merge before they are parsed. One stray value does not matter, and
    neither does the order or the partitioning of the rows.
    """
    text = named(column)
    counted = df.where(text.isNotNull()).groupBy(text.alias("v")).agg(F.count("*").alias("n"))
    fits = counted.agg(
        *[F.sum(F.when(parse_timestamp(F.col("v"), f).isNotNull(), F.col("n"))) for f in DATE_FORMATS]
    ).first()
    best = max(range(len(DATE_FORMATS)), key=lambda i: (fits[i] or 0, -i))
    return DATE_FORMATS[best]


# Notations a browser reads besides ISO ones.
BROWSER_FORMATS = [
    "M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M-d-yyyy", "yyyy/M/d",
    "yyyy/M/d H:mm:ss", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy",
]


def looks_like_date(column: Column) -> Column:
    """Whether a lenient, browser-like reading of the text gives a date."""
    text = stripped(column)
    return F.coalesce(
        text.try_cast("timestamp_ntz"), *[parse_timestamp(text, f) for f in BROWSER_FORMATS]
    ).isNotNull()
