"""Table schemas, declared keys and layer of every table.

Spark does not enforce keys or NOT NULL, so the declarations here feed the checks in
``operators.integrity``. Each field states whether it may be NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LAYERS = ("raw", "curated", "mart", "recon")


@dataclass(frozen=True)
class Table:
    layer: str
    name: str
    schema: T.StructType
    key: tuple[str, ...]
    # Date column whose month partitions the stored table; None for small tables.
    dated_by: str | None = None
    # Stored beside the declared columns and not part of the source format.
    audit: tuple[str, ...] = ()
    # Amounts whose sum the ledger keeps for each month.
    control: tuple[str, ...] = ()

    @property
    def month_column(self) -> str | None:
        """Partition column: the date itself where it already is a month, else one derived from it."""
        if self.dated_by is None or self.dated_by.endswith("month"):
            return self.dated_by
        return self.dated_by.removesuffix("_date") + "_month"

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema.fields if not f.nullable)


@dataclass(frozen=True)
class ForeignKey:
    child: str
    columns: tuple[str, ...]
    parent: str


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


INT, LONG, DATE, STR, BOOL = T.IntegerType(), T.LongType(), T.DateType(), T.StringType(), T.BooleanType()
TS = T.TimestampNTZType()
KW, LINE_AMOUNT, AMOUNT = T.DecimalType(10, 2), T.DecimalType(12, 2), T.DecimalType(14, 2)
USAGE = T.DecimalType(12, 2)

#: When a row came in by a rerun; NULL on a first load.
REPROCESSED = "reprocessed_at"

DIM_CUSTOMER = Table(
    "curated",
    "dim_customer",
    _struct(
        ("customer_id", INT, False),
        ("customer_name", STR, False),
        ("industry", STR, True),
        ("start_date", DATE, False),
    ),
    ("customer_id",),
)

DIM_CONTRACT = Table(
    "curated",
    "dim_contract",
    _struct(
        ("contract_id", INT, False),
        ("contract_version", INT, False),
        ("customer_id", INT, False),
        ("effective_start", DATE, False),
        ("effective_end", DATE, False),
        ("racks_entitled", INT, False),
        ("power_commit_kw", KW, False),
        ("price_per_kw", KW, False),
        ("sla_tier", STR, False),
        ("overage_allowed_flag", BOOL, False),
    ),
    ("contract_id", "contract_version"),
)

FACT_METER = Table(
    "raw",
    "fact_meter_power_daily",
    _struct(
        ("reading_date", DATE, False),
        ("contract_id", INT, False),
        ("contract_version", INT, False),
        ("used_kw", KW, True),
        ("reading_status", STR, False),
        ("ingested_at", TS, False),
    ),
    ("reading_date", "contract_id", "contract_version"),
    "reading_date",
    (REPROCESSED,),
    control=("used_kw",),
)

FACT_RACK = Table(
    "raw",
    "fact_rack_utilization_daily",
    _struct(
        ("usage_date", DATE, False),
        ("contract_id", INT, False),
        ("contract_version", INT, False),
        ("racks_used", INT, True),
        ("ingested_at", TS, False),
    ),
    ("usage_date", "contract_id", "contract_version"),
    "usage_date",
    (REPROCESSED,),
)

FACT_INVOICE = Table(
    "raw",
    "fact_invoice_line",
    _struct(
        ("invoice_id", INT, False),
        ("invoice_line_id", INT, False),
        ("posting_date", DATE, False),
        ("invoice_month", DATE, False),
        ("contract_id", INT, False),
        ("contract_version", INT, False),
        ("revenue_type", STR, False),
        ("amount", LINE_AMOUNT, False),
    ),
    ("invoice_id", "invoice_line_id"),
    "invoice_month",
    (REPROCESSED,),
    control=("amount",),
)

FACT_COST = Table(
    "raw",
    "fact_power_cost_monthly",
    _struct(
        ("cost_month", DATE, False),
        ("site_id", INT, False),
        ("total_power_cost", AMOUNT, True),
        ("allocation_method", STR, False),
        ("true_up_flag", BOOL, False),
    ),
    ("cost_month", "site_id"),
    control=("total_power_cost",),
)

MART = Table(
    "mart",
    "mart_contract_monthly",
    _struct(
        ("contract_id", INT, True),
        ("contract_version", INT, True),
        ("month", DATE, True),
        ("racks_entitled", INT, True),
        ("power_commit_kw", KW, True),
        ("total_kw", USAGE, True),
        ("avg_daily_kw", USAGE, True),
        ("peak_kw", USAGE, True),
        ("avg_racks_used", KW, True),
        ("max_racks_used", INT, True),
        ("erp_revenue_total", AMOUNT, True),
        ("erp_mrr", AMOUNT, True),
        ("erp_overage", AMOUNT, True),
        ("erp_credits", AMOUNT, True),
        ("allocated_power_cost", AMOUNT, True),
        ("gross_margin", AMOUNT, True),
        ("late_reading_days", INT, True),
        ("estimated_days", INT, True),
        ("true_up_flag", BOOL, True),
    ),
    ("contract_id", "contract_version", "month"),
    "month",
    control=("erp_revenue_total", "allocated_power_cost", "total_kw"),
)

RECON = Table(
    "recon",
    "recon_erp_vs_mart_monthly",
    _struct(
        ("month", DATE, True),
        ("erp_revenue_total", T.DecimalType(38, 2), True),
        ("mart_revenue_total", T.DecimalType(38, 2), True),
        ("variance_amount", T.DecimalType(38, 2), True),
        ("variance_pct", T.DoubleType(), True),
        ("variance_bucket", STR, True),
        ("control_status", STR, True),
        ("last_reconciled_at", T.TimestampType(), True),
    ),
    ("month",),
)

#: What each write left in a month of a table (NULL: of a table without months), the latest write last.
LAYER_LEDGER = Table(
    "recon",
    "layer_ledger",
    _struct(
        ("table_name", STR, False),
        ("month", DATE, True),
        ("row_count", LONG, False),
        ("control_sum", T.DecimalType(38, 2), True),
        ("write_id", LONG, False),
    ),
    ("table_name", "month", "write_id"),
)

#: Energy cost booked to contract-months at each close; entries are only ever added.
COST_JOURNAL = Table(
    "mart",
    "power_cost_journal",
    _struct(
        ("contract_id", INT, False),
        ("contract_version", INT, False),
        ("usage_month", DATE, False),
        ("close_on", DATE, False),
        ("booked", AMOUNT, False),
    ),
    ("contract_id", "contract_version", "usage_month", "close_on"),
    "usage_month",
    control=("booked",),
)

#: Contract-months as they were signed off; rows are only ever added.
SIGNOFF_LOCK = Table(
    "recon",
    "signoff_lock",
    _struct(
        ("contract_id", INT, False),
        ("contract_version", INT, False),
        ("month", DATE, False),
        ("total_kw", USAGE, True),
        ("erp_revenue_total", AMOUNT, True),
        ("gross_margin", AMOUNT, True),
    ),
    ("contract_id", "contract_version", "month"),
    "month",
    control=("total_kw", "erp_revenue_total", "gross_margin"),
)

USAGE_MONTHLY = Table(
    "curated",
    "usage_monthly",
    _struct(
        ("contract_id", INT, True),
        ("contract_version", INT, True),
        ("usage_month", DATE, True),
        ("total_kw", USAGE, True),
        ("avg_daily_kw", USAGE, True),
        ("peak_kw", USAGE, True),
        ("late_reading_days", INT, True),
        ("estimated_days", INT, True),
    ),
    ("contract_id", "contract_version", "usage_month"),
    "usage_month",
    control=("total_kw",),
)

RACK_MONTHLY = Table(
    "curated",
    "rack_monthly",
    _struct(
        ("contract_id", INT, True),
        ("contract_version", INT, True),
        ("usage_month", DATE, True),
        ("avg_racks_used", KW, True),
        ("max_racks_used", INT, True),
    ),
    ("contract_id", "contract_version", "usage_month"),
    "usage_month",
)

ERP_REVENUE_MONTHLY = Table(
    "curated",
    "erp_revenue_monthly",
    _struct(
        ("contract_id", INT, True),
        ("contract_version", INT, True),
        ("invoice_month", DATE, True),
        ("erp_revenue_total", AMOUNT, True),
        ("erp_mrr", AMOUNT, True),
        ("erp_overage", AMOUNT, True),
        ("erp_credits", AMOUNT, True),
    ),
    ("contract_id", "contract_version", "invoice_month"),
    "invoice_month",
    control=("erp_revenue_total",),
)

SOURCE_TABLES = (DIM_CUSTOMER, DIM_CONTRACT, FACT_METER, FACT_RACK, FACT_INVOICE, FACT_COST)
ALL_TABLES = (*SOURCE_TABLES, USAGE_MONTHLY, RACK_MONTHLY, ERP_REVENUE_MONTHLY, MART, RECON, LAYER_LEDGER, COST_JOURNAL, SIGNOFF_LOCK)
BY_NAME = {t.name: t for t in ALL_TABLES}

FOREIGN_KEYS = (
    ForeignKey("dim_contract", ("customer_id",), "dim_customer"),
    # Not declared by any table, but every fact is meant to join to a contract version.
    ForeignKey("fact_meter_power_daily", ("contract_id", "contract_version"), "dim_contract"),
    ForeignKey("fact_rack_utilization_daily", ("contract_id", "contract_version"), "dim_contract"),
    ForeignKey("fact_invoice_line", ("contract_id", "contract_version"), "dim_contract"),
)
