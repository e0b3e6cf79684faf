"""The contract x version x month margin mart and the reports read from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattledger.functions.expressions import clamp, flag, ratio
from wattledger.operators.allocation import power_cost_allocated
from wattledger.operators.monthly import CONTRACT_MONTH
from wattledger.schemas import MART


def _money_or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("decimal(14,2)")


def gross_margin(revenue: Column, cost: Column) -> Column:
    zero = F.lit(0).cast("decimal(14,2)")
    return F.coalesce(revenue, zero) - F.coalesce(cost, zero)


def mart_contract_monthly(
    usage: DataFrame,
    contracts: DataFrame,
    rack_usage: DataFrame,
    erp_revenue: DataFrame,
    power_cost: DataFrame,
) -> DataFrame:
    """The mart, driven by usage.

    An invoice without usage stays out; finding that loss is the reconciliation's task. Missing revenue,
    cost and true-up count as zero, missing rack counts stay NULL. The three monthly frames are already
    partitioned by the join keys, so those joins add no shuffle; contracts come last for that reason.
    """
    allocation = power_cost_allocated(usage, power_cost, keep_uncosted=True)
    erp = erp_revenue.withColumnRenamed("invoice_month", "usage_month")
    terms = contracts.select("contract_id", "contract_version", "racks_entitled", "power_commit_kw")
    joined = (
        allocation.join(rack_usage, list(CONTRACT_MONTH), "left")
        .join(erp, list(CONTRACT_MONTH), "left")
        .join(terms, ["contract_id", "contract_version"])
        .withColumnRenamed("usage_month", "month")
        .withColumns({c: _money_or_zero(c) for c in
                      ("erp_revenue_total", "erp_mrr", "erp_overage", "erp_credits", "allocated_power_cost")})
        .withColumn("gross_margin", gross_margin(F.col("erp_revenue_total"), F.col("allocated_power_cost")))
        .withColumn("true_up_flag", F.coalesce(F.col("true_up_flag"), F.lit(False)))
    )
    # Ids keep the width they came with; everything else takes the declared type.
    ids = ("contract_id", "contract_version")
    return joined.select(
        *[f.name if f.name in ids else F.col(f.name).cast(f.dataType).alias(f.name) for f in MART.schema.fields]
    )


def customer_monthly(mart: DataFrame, contracts: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue, usage, cost and margin per customer and month.

    Names come last and by a left join: a customer the dimension lacks still shows up, without a name.
    """
    owners = contracts.select("contract_id", "contract_version", "customer_id")
    names = customers.select("customer_id", "customer_name", "industry")
    return (
        mart.join(owners, ["contract_id", "contract_version"])
        .groupBy("customer_id", "month")
        .agg(
            F.count("*").alias("contract_rows"),
            F.sum("total_kw").alias("total_kw"),
            F.sum("erp_revenue_total").alias("erp_revenue_total"),
            F.sum("erp_mrr").alias("erp_mrr"),
            F.sum("erp_overage").alias("erp_overage"),
            F.sum("erp_credits").alias("erp_credits"),
            F.sum("allocated_power_cost").alias("allocated_power_cost"),
            F.sum("gross_margin").alias("gross_margin"),
        )
        .join(names, "customer_id", "left")
    )


def clamped_utilization(utilization: DataFrame) -> DataFrame:
    """Average utilisation held between nothing and all of what the contract grants, for gauges and scores."""
    none, all_of_it = F.lit(0.0), F.lit(1.0)
    return utilization.select(
        "contract_id",
        "contract_version",
        "month",
        clamp(F.col("avg_power_utilization"), none, all_of_it).alias("power_utilization"),
        clamp(F.col("avg_rack_utilization"), none, all_of_it).alias("rack_utilization"),
    )


def contract_utilization(mart: DataFrame) -> DataFrame:
    """Power and racks used against what the contract grants."""
    return mart.select(
        "contract_id",
        "contract_version",
        "month",
        ratio(F.col("avg_daily_kw"), F.col("power_commit_kw")).alias("avg_power_utilization"),
        ratio(F.col("peak_kw"), F.col("power_commit_kw")).alias("peak_power_utilization"),
        ratio(F.col("avg_racks_used"), F.col("racks_entitled")).alias("avg_rack_utilization"),
        ratio(F.col("max_racks_used"), F.col("racks_entitled")).alias("peak_rack_utilization"),
        flag(F.col("peak_kw") > F.col("power_commit_kw")).alias("over_commit_flag"),
        flag(F.col("max_racks_used") > F.col("racks_entitled")).alias("over_racks_flag"),
    )


def monthly_trend(mart: DataFrame) -> DataFrame:
    """Site totals by month with the change from the month before.

    The unpartitioned window runs over one row per month, after the aggregation.
    """
    measures = {
        "revenue": "erp_revenue_total",
        "power_cost": "allocated_power_cost",
        "margin": "gross_margin",
        "usage_kw": "total_kw",
    }
    order = W.orderBy("month")
    totals = mart.groupBy("month").agg(*[F.sum(c).alias(name) for name, c in measures.items()])
    return totals.select(
        "month",
        *measures,
        *[(F.col(m) - F.lag(m).over(order)).alias(f"{m}_change") for m in measures],
        ratio(F.col("margin"), F.col("revenue")).alias("margin_ratio"),
    )
