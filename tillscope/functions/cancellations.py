"""The three cancellation rules. They disagree by design and are never merged."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: status texts that mean a cancelled line.
CANCELLED_TEXT = r"(?i)cancel|return|credit|true|^1$"


def by_invoice_prefix(invoice_no: Column) -> Column:
    return F.coalesce(invoice_no.cast("string").startswith("C"), F.lit(False))


def by_negative_quantity(quantity: Column) -> Column:
    return F.coalesce(quantity < 0, F.lit(False))


def by_status_text(status: Column) -> Column:
    return F.coalesce(status.cast("string"), F.lit("")).rlike(CANCELLED_TEXT)
