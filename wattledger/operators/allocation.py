"""Site power cost shared out to contracts by usage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.operators.monthly import CONTRACT_MONTH, power_cost_monthly


def total_usage_monthly(usage: DataFrame) -> DataFrame:
    return usage.groupBy("usage_month").agg(F.sum("total_kw").alias("total_site_kw"))


def broadcast_months(months: DataFrame) -> DataFrame:
    """Broadcast a frame that was just grouped by month.

    Its size is bounded by the calendar and not by the data: twelve rows a year, under 120,000 for every
    month a four-digit year can name. Left to a shuffle, a join on month would squeeze the contracts of
    a month into one task.
    """
    return F.broadcast(months)


def allocated(kw: str, site_kw: str, cost: str):
    """Usage share times cost, divided first, in cents; 0 when the site used nothing.

    The inputs are exact decimal sums, so one double division gives the same cents on any partitioning
    and cannot overflow, as a decimal quotient of site-wide totals would. Rounding to six digits first
    takes out the double's own error, so that an exact half cent rounds up.
    """
    share = F.col(kw).cast("double") / F.col(site_kw).cast("double")
    return (
        F.when(F.col(site_kw) == 0, F.lit(0.0))
        .otherwise(share * F.col(cost).cast("double"))
        .cast("decimal(20,6)")
        .cast("decimal(14,2)")
    )


def power_cost_allocated(usage: DataFrame, power_cost: DataFrame, keep_uncosted: bool = False) -> DataFrame:
    """Cost share of each contract-month. Months without a cost row are dropped unless asked for.

    Usage carries no site, so all sites of a month form one pool.
    """
    site = broadcast_months(total_usage_monthly(usage))
    cost = broadcast_months(power_cost_monthly(power_cost).withColumnRenamed("cost_month", "usage_month"))
    return (
        usage.join(site, "usage_month")
        .join(cost, "usage_month", "left" if keep_uncosted else "inner")
        .withColumn("allocated_power_cost", allocated("total_kw", "total_site_kw", "total_power_cost"))
    )


def true_up_delta(usage: DataFrame, estimated_cost: DataFrame, actual_cost: DataFrame) -> DataFrame:
    """What each contract's share changes by when actual cost replaces estimated cost.

    The two cost sets meet at month grain, where they are tiny; usage is read once for both.
    """
    estimate = power_cost_monthly(estimated_cost).select(
        F.col("cost_month").alias("usage_month"), F.col("total_power_cost").alias("estimated_cost")
    )
    actual = power_cost_monthly(actual_cost).select(
        F.col("cost_month").alias("usage_month"), F.col("total_power_cost").alias("actual_cost")
    )
    costs = broadcast_months(estimate.join(actual, "usage_month", "full_outer"))
    site = broadcast_months(total_usage_monthly(usage))
    zero = F.lit(0).cast("decimal(14,2)")
    shares = (
        usage.join(site, "usage_month")
        .join(costs, "usage_month")
        .select(
            *CONTRACT_MONTH,
            F.coalesce(allocated("total_kw", "total_site_kw", "estimated_cost"), zero).alias("estimated_allocation"),
            F.coalesce(allocated("total_kw", "total_site_kw", "actual_cost"), zero).alias("actual_allocation"),
        )
    )
    return shares.withColumn("true_up_amount", F.col("actual_allocation") - F.col("estimated_allocation"))


def cost_as_of(cost_versions: DataFrame, closes: DataFrame) -> DataFrame:
    """Site cost of each month as it was known at each close: ``cost_month``, ``close_on``, ``total_power_cost``.

    ``cost_versions`` has a row for each time a site's cost of a month became known anew (``known_from``), and
    the last one that a close could know counts; sites add up. A close before anything was known has no row.
    Equality on the month comes with the bound on time, and both sides are bounded by the calendar.
    """
    known = cost_versions.join(closes, "cost_month").where(F.col("known_from") <= F.col("close_on"))
    last = known.groupBy("cost_month", "close_on", "site_id").agg(F.max(F.struct("known_from", "total_power_cost")).alias("last"))
    return last.groupBy("cost_month", "close_on").agg(F.sum("last.total_power_cost").alias("total_power_cost"))


def journal_entries(usage: DataFrame, snapshot: DataFrame, journal: DataFrame) -> DataFrame:
    """What a close has to book so that each contract-month's entries add up to its share of the cost known now.

    ``snapshot`` is the cost as of the close (``cost_as_of``), one row for each month; ``journal`` is what was
    booked before. The first close of a contract-month books its whole share, later ones the difference; a
    share that stays as it was books nothing, so a close that is run again adds no entry. Contract-months
    that are no longer used are booked back to zero.
    """
    months = broadcast_months(snapshot.select(F.col("cost_month").alias("usage_month"), "close_on", "total_power_cost"))
    site = broadcast_months(total_usage_monthly(usage))
    zero = F.lit(0).cast("decimal(14,2)")
    share = F.coalesce(allocated("total_kw", "total_site_kw", "total_power_cost"), zero)
    due = usage.join(site, "usage_month").join(months, "usage_month").select(*CONTRACT_MONTH, share.alias("due"))
    booked = journal.groupBy(*CONTRACT_MONTH).agg(F.sum("booked").alias("before"))
    closed = months.select("usage_month", "close_on")
    return (
        due.join(booked, list(CONTRACT_MONTH), "full_outer")
        .join(broadcast_months(closed), "usage_month")
        .select(*CONTRACT_MONTH, "close_on", (F.coalesce("due", zero) - F.coalesce("before", zero)).cast("decimal(14,2)").alias("booked"), F.col("before").isNull().alias("first"))
        .where("first OR booked <> 0")
        .drop("first")
    )
