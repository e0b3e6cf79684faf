"""Billed against modelled revenue: monthly reconciliation, MRR check and causes of variance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.expressions import (
    CAUSE_LATE,
    CAUSE_MAPPING,
    CAUSE_MISSING,
    CAUSE_NONE,
    CAUSE_TIMING,
    GREEN_MAX_PCT,
    RED,
    YELLOW_MAX_PCT,
    control_status,
    exception_reason,
    month_floor,
    variance_pct,
)


def recon_erp_vs_mart_monthly(
    invoices: DataFrame,
    mart: DataFrame,
    reconciled_at: Column | None = None,
    green_max_pct: float = GREEN_MAX_PCT,
    yellow_max_pct: float = YELLOW_MAX_PCT,
) -> DataFrame:
    """ERP and mart revenue of each month, their variance, its likely reason and a control colour.

    ``invoices`` are lines or already billed contract-months, by invoice_month and amount; ``mart`` is the
    mart itself, as stored or as composed. Both sides are grouped by month before they meet, so the full join sees one row per month. A month
    only one side knows is Red. The 1 % tolerance is documented; the limit between Yellow and Red is a
    parameter of ours. Percentages are compared unrounded and shown with four decimals.
    """
    erp = invoices.groupBy(F.col("invoice_month").alias("month")).agg(F.sum("amount").alias("erp_sum"))
    modelled = mart.groupBy("month").agg(
        F.sum("erp_revenue_total").alias("mart_sum"),
        F.sum("late_reading_days").alias("late_days"),
        F.sum("estimated_days").alias("estimated_days"),
        F.max("true_up_flag").alias("true_up"),
    )
    return _reconciled(erp.join(modelled, "month", "full_outer"), reconciled_at, green_max_pct, yellow_max_pct)


def _reconciled(sides: DataFrame, reconciled_at: Column | None, green_max_pct: float, yellow_max_pct: float) -> DataFrame:
    """Variance, bucket and colour of months with what each side sums up to; NULL where a side has none."""
    one_sided = F.col("erp_sum").isNull() | F.col("mart_sum").isNull()
    billed, booked = F.col("erp_revenue_total"), F.col("mart_revenue_total")
    status = control_status(billed, booked, green_max_pct, yellow_max_pct)
    return (
        sides.withColumn("erp_revenue_total", F.coalesce("erp_sum", F.lit(0)))
        .withColumn("mart_revenue_total", F.coalesce("mart_sum", F.lit(0)))
        .select(
            "month",
            "erp_revenue_total",
            "mart_revenue_total",
            (booked - billed).alias("variance_amount"),
            F.round(variance_pct(billed, booked), 4).alias("variance_pct"),
            exception_reason(F.col("late_days"), F.col("estimated_days"), F.col("true_up")).alias("variance_bucket"),
            F.when(one_sided, RED).otherwise(status).alias("control_status"),
            (F.current_timestamp() if reconciled_at is None else reconciled_at).alias("last_reconciled_at"),
        )
    )


def controls_data_integrity(recon: DataFrame) -> DataFrame:
    return recon.select(
        "month",
        "erp_revenue_total",
        "mart_revenue_total",
        "variance_amount",
        "variance_pct",
        "variance_bucket",
        "control_status",
        "last_reconciled_at",
    )


def mrr_vs_invoiced(
    contract_mrr: DataFrame,
    erp_revenue: DataFrame,
    green_max_pct: float = GREEN_MAX_PCT,
    yellow_max_pct: float = YELLOW_MAX_PCT,
) -> DataFrame:
    """Contract-defined against invoiced recurring revenue per contract-month, also where one is absent."""
    keys = ["contract_id", "contract_version", "month"]
    defined = contract_mrr.select(*keys, "contract_mrr")
    billed = erp_revenue.select("contract_id", "contract_version", F.col("invoice_month").alias("month"), "erp_mrr")
    zero = F.lit(0).cast("decimal(14,2)")
    both = defined.join(billed, keys, "full_outer").select(
        *keys,
        F.coalesce("contract_mrr", zero).alias("contract_mrr"),
        F.coalesce("erp_mrr", zero).alias("invoiced_mrr"),
    )
    expected, actual = F.col("contract_mrr"), F.col("invoiced_mrr")
    return both.withColumn("mrr_difference", actual - expected).withColumn(
        "control_status", control_status(expected, actual, green_max_pct, yellow_max_pct)
    )


def variance_root_cause(invoices: DataFrame, contracts: DataFrame, usage: DataFrame) -> DataFrame:
    """Why billed revenue of a contract-month may not reach the mart, first match wins.

    Lines are grouped first, so the joins run at contract-month grain on keys the grouping already
    partitioned by.
    """
    keys = ["contract_id", "contract_version", "invoice_month"]
    off_month = month_floor(F.col("posting_date")) != F.col("invoice_month")
    billed = invoices.groupBy(*keys).agg(
        F.sum("amount").cast("decimal(14,2)").alias("erp_revenue_total"),
        F.max(off_month).alias("posted_in_other_month"),
    )
    used = usage.select(
        "contract_id", "contract_version", F.col("usage_month").alias("invoice_month"), "late_reading_days"
    )
    known = contracts.select("contract_id", "contract_version", F.lit(True).alias("known_version"))
    cause = (
        F.when(F.col("known_version").isNull(), CAUSE_MAPPING)
        .when(F.col("late_reading_days").isNull(), CAUSE_MISSING)
        .when(F.col("posted_in_other_month"), CAUSE_TIMING)
        .when(F.col("late_reading_days") > 0, CAUSE_LATE)
        .otherwise(CAUSE_NONE)
    )
    return (
        billed.join(used, keys, "left")
        .join(known, ["contract_id", "contract_version"], "left")
        .select(*keys, "erp_revenue_total", cause.alias("root_cause"))
    )
