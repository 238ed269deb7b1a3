from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tillscope.session import local_session

    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        8, shuffle_partitions=4, memory="4g", conf={"spark.sql.warehouse.dir": str(warehouse)}
    )
    yield session
    session.stop()


TRANSACTION_DDL = (
    "invoice_no string, stock_code string, description string, quantity decimal(18,4), "
    "invoice_date timestamp_ntz, unit_price decimal(18,4), customer_id string, country string, "
    "revenue decimal(20,4), is_cancellation boolean, owner_id int"
)


@pytest.fixture(scope="session")
def lines(spark):
    """Builds a small fact table: (invoice, description, date, customer, revenue, ...)."""
    from datetime import datetime
    from decimal import Decimal

    def build(*rows):
        full = []
        for row in rows:
            invoice, description, day, customer, revenue = row[:5]
            extra = row[5] if len(row) > 5 else {}
            amount = None if revenue is None else Decimal(str(revenue))
            full.append(
                (
                    invoice, extra.get("stock_code", description), description, Decimal(1),
                    datetime.fromisoformat(day) if day else None, amount, customer,
                    extra.get("country", "UK"), amount, extra.get("cancelled", False),
                    extra.get("owner", 1),
                )
            )
        return spark.createDataFrame(full, TRANSACTION_DDL)

    return build


def tuples(df):
    return [tuple(r) for r in df.collect()]
