"""Revenue leakage and overbilling: usage not billed, versions not followed, overage not allowed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions.expressions import OVERAGE
from wattledger.operators.calendar import active_contract_months

OTHER_VERSION, NO_VERSION = "other version in force", "no version in force"


def unbilled_spikes(usage: DataFrame, erp_revenue: DataFrame, contracts: DataFrame) -> DataFrame:
    """Months whose peak passed the commitment, on contracts that may be charged for it, with no overage billed.

    From the monthly tables: cost and site totals, which the mart would bring along, are not needed.
    """
    terms = contracts.where("overage_allowed_flag").select("contract_id", "contract_version", "power_commit_kw")
    billed = erp_revenue.select("contract_id", "contract_version", F.col("invoice_month").alias("usage_month"), "erp_overage")
    return (
        usage.join(billed, ["contract_id", "contract_version", "usage_month"], "left")
        .where(F.coalesce("erp_overage", F.lit(0)) == 0)
        .join(terms, ["contract_id", "contract_version"])
        .where(F.col("peak_kw") > F.col("power_commit_kw"))
        .select(
            "contract_id",
            "contract_version",
            F.col("usage_month").alias("month"),
            "peak_kw",
            "power_commit_kw",
            (F.col("peak_kw") - F.col("power_commit_kw")).alias("kw_over_commit"),
        )
    )


def stale_version_billing(invoices: DataFrame, contracts: DataFrame) -> DataFrame:
    """Lines billed under a version that was not in force on any day of their month, with the reason.

    With an amendment inside a month both versions may be billed for it. ``in_force_version`` is the last
    of the month's versions, NULL in a month without one. Works on single lines: a contract with a third
    of them is split by adaptive execution's skew join. The contract-months are never broadcast: Spark takes
    them for as many as the contracts they are made from, and a task would hold all of them.
    """
    billed = F.col("contract_version")
    in_month = (
        active_contract_months(contracts)
        .groupBy("contract_id", F.col("month").alias("invoice_month"))
        .agg(F.collect_set("contract_version").alias("versions"), F.max("contract_version").alias("in_force_version"))
    )
    none = F.col("versions").isNull()
    return (
        invoices.join(in_month.hint("merge"), ["contract_id", "invoice_month"], "left")
        .where(none | billed.isNull() | ~F.array_contains("versions", billed))
        .select(
            "invoice_id",
            "invoice_line_id",
            "contract_id",
            "invoice_month",
            billed.alias("billed_version"),
            "in_force_version",
            F.when(none, NO_VERSION).otherwise(OTHER_VERSION).alias("stale_reason"),
            "revenue_type",
            "amount",
        )
    )


def disallowed_overage(invoices: DataFrame, contracts: DataFrame) -> DataFrame:
    """Overage lines on contract versions that do not allow overage."""
    barred = contracts.where(~F.col("overage_allowed_flag")).select("contract_id", "contract_version")
    return (
        invoices.where(F.col("revenue_type") == OVERAGE)
        .join(barred, ["contract_id", "contract_version"], "left_semi")
        .select("invoice_id", "invoice_line_id", "contract_id", "contract_version", "invoice_month", "amount")
    )
