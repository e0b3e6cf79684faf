from __future__ import annotations

import sys
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from wattledger import schemas  # noqa: E402
from wattledger.session import local_session  # noqa: E402

DEFAULTS = {
    "dim_customer": {"customer_id": 1, "customer_name": "Customer_01", "industry": None, "start_date": "2023-01-01"},
    "dim_contract": {
        "contract_id": 101, "contract_version": 1, "customer_id": 1, "effective_start": "2023-01-01",
        "effective_end": "2024-12-31", "racks_entitled": 4, "power_commit_kw": "20.00", "price_per_kw": "100.00",
        "sla_tier": "Standard", "overage_allowed_flag": True,
    },
    "fact_meter_power_daily": {
        "reading_date": "2023-01-10", "contract_id": 101, "contract_version": 1, "used_kw": "10.00",
        "reading_status": "on_time", "ingested_at": "2023-01-10 06:00:00",
    },
    "fact_rack_utilization_daily": {
        "usage_date": "2023-01-10", "contract_id": 101, "contract_version": 1, "racks_used": 3,
        "ingested_at": "2023-01-10 06:00:00",
    },
    "fact_invoice_line": {
        "invoice_id": 1, "invoice_line_id": 1, "posting_date": "2023-01-31", "invoice_month": "2023-01-01",
        "contract_id": 101, "contract_version": 1, "revenue_type": "recurring", "amount": "2000.00",
    },
    "fact_power_cost_monthly": {
        "cost_month": "2023-01-01", "site_id": 1, "total_power_cost": "500.00", "allocation_method": "kw_share",
        "true_up_flag": False,
    },
}


def _typed(value, kind: str):
    if value is None or not isinstance(value, str):
        return value
    if kind == "date":
        return date.fromisoformat(value)
    if kind.startswith("timestamp"):
        return datetime.fromisoformat(value)
    return Decimal(value) if kind.startswith("decimal") else value


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4, **{"spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Builds a typed table from partial rows: ``make("dim_contract", {...}, {...})``."""

    def build(table: str, *rows: dict):
        schema = schemas.BY_NAME[table].schema
        full = [{**DEFAULTS[table], **r} for r in rows]
        return spark.createDataFrame(
            [tuple(_typed(r[f.name], f.dataType.simpleString()) for f in schema.fields) for r in full], schema
        )

    return build


def rows(df, *columns: str):
    """Sorted tuples with plain values, for comparing whole results."""

    def plain(value):
        if isinstance(value, Decimal):
            return float(value)
        return value.isoformat() if isinstance(value, date) else value

    out = [tuple(plain(v) for v in r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))
