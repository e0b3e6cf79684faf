"""Daily and line-level facts brought to contract x version x month, the grain of the mart.

Each is a single hash aggregation with a partial stage before the shuffle, so a contract holding a
third of all rows sends one row per map task and month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.expressions import (
    CREDIT,
    ESTIMATED,
    LATE,
    OVERAGE,
    RECURRING,
    cents,
    count_where,
    month_floor,
    ratio,
    sum_cents,
    sum_where,
)

CONTRACT_MONTH = ("contract_id", "contract_version", "usage_month")


def _month_of(daily: DataFrame, day: str) -> Column:
    """The month the rows were dealt by, so that their sums need no shuffle; else that of the day."""
    return F.col("usage_month") if "usage_month" in daily.columns else month_floor(F.col(day)).alias("usage_month")


def usage_monthly(effective_meter: DataFrame) -> DataFrame:
    """Monthly usage. A NULL reading counts towards late or estimated days but not towards kW."""
    status, kw = F.col("reading_status"), F.col("used_kw")
    return effective_meter.groupBy("contract_id", "contract_version", _month_of(effective_meter, "reading_date")).agg(
        sum_cents(cents(kw), "decimal(12,2)").alias("total_kw"),
        F.avg(kw).cast("decimal(12,2)").alias("avg_daily_kw"),
        F.max(kw).cast("decimal(12,2)").alias("peak_kw"),
        count_where(status == LATE).cast("int").alias("late_reading_days"),
        count_where(status == ESTIMATED).cast("int").alias("estimated_days"),
    )


def usage_quality_monthly(effective_meter: DataFrame) -> DataFrame:
    """Share of each contract-month's kW that came late or was estimated; NULL for a month of zero kW."""
    status, kw = F.col("reading_status"), F.col("used_kw")
    return (
        effective_meter.groupBy(
            "contract_id", "contract_version", month_floor(F.col("reading_date")).alias("usage_month")
        )
        .agg(
            F.sum(kw).alias("total_kw"),
            sum_where(status == LATE, kw).alias("late_kw"),
            sum_where(status == ESTIMATED, kw).alias("estimated_kw"),
        )
        .withColumn("late_share", ratio(F.col("late_kw"), F.col("total_kw")))
        .withColumn("estimated_share", ratio(F.col("estimated_kw"), F.col("total_kw")))
    )


def rack_monthly(effective_racks: DataFrame) -> DataFrame:
    return effective_racks.groupBy("contract_id", "contract_version", _month_of(effective_racks, "usage_date")).agg(
        F.avg("racks_used").cast("decimal(10,2)").alias("avg_racks_used"),
        F.max("racks_used").alias("max_racks_used"),
    )


def erp_revenue_monthly(invoices: DataFrame) -> DataFrame:
    """Billed revenue by kind. Credits are negative amounts and are summed as they are."""
    kind, amount = F.col("revenue_type"), cents(F.col("amount"))

    def billed(wanted: str) -> Column:
        return sum_cents(F.when(kind == wanted, amount).otherwise(0), "decimal(14,2)")

    return invoices.groupBy("contract_id", "contract_version", "invoice_month").agg(
        sum_cents(amount, "decimal(14,2)").alias("erp_revenue_total"),
        billed(RECURRING).alias("erp_mrr"),
        billed(OVERAGE).alias("erp_overage"),
        billed(CREDIT).alias("erp_credits"),
    )


def power_cost_monthly(power_cost: DataFrame) -> DataFrame:
    """One cost row per month: usage carries no site, so a second site must not fan rows out."""
    return power_cost.groupBy("cost_month").agg(
        F.sum("total_power_cost").alias("total_power_cost"),
        F.max("true_up_flag").alias("true_up_flag"),
    )
