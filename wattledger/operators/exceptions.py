"""Contract-level exceptions and summaries, all read from the mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.expressions import ESTIMATED, count_where, exception_reason, flag, month_floor, ratio


def contract_variance_monthly(mart: DataFrame) -> DataFrame:
    """Mart rows with 0/1 flags; ``true_up_flag2`` repeats ``true_up_flag`` and readers expect both."""
    return mart.select(
        "month",
        "contract_id",
        "contract_version",
        F.col("erp_revenue_total").alias("contract_erp_revenue"),
        "allocated_power_cost",
        "gross_margin",
        "late_reading_days",
        "estimated_days",
        "true_up_flag",
        "total_kw",
        "avg_daily_kw",
        "peak_kw",
        flag(F.col("late_reading_days") > 0).alias("late_flag"),
        flag(F.col("estimated_days") > 0).alias("estimated_flag"),
        flag(F.col("true_up_flag")).alias("true_up_flag2"),
    )


def _reason() -> Column:
    return exception_reason(F.col("late_reading_days"), F.col("estimated_days"), F.col("true_up_flag"))


def contract_exception_reason(mart: DataFrame) -> DataFrame:
    return mart.select("month", "contract_id", "contract_version", _reason().alias("exception_reason"))


def exception_counts(mart: DataFrame) -> DataFrame:
    return mart.groupBy("month", _reason().alias("exception_reason")).agg(F.count("*").alias("contract_rows"))


def exceptions_only(mart: DataFrame) -> DataFrame:
    """Every arm of the filter is a plain comparison, so all three reach the Parquet scan."""
    return mart.where(
        (F.col("late_reading_days") > 0) | (F.col("estimated_days") > 0) | (F.col("true_up_flag") == F.lit(True))
    )


def controls_summary(mart: DataFrame) -> DataFrame:
    """Counts by month. A row may be in several counts, unlike with the reason ladder."""
    return mart.groupBy("month").agg(
        F.count("*").alias("contract_rows"),
        count_where(F.col("late_reading_days") > 0).alias("contracts_with_late_data"),
        count_where(F.col("estimated_days") > 0).alias("contracts_with_estimated_data"),
        count_where(F.col("true_up_flag")).alias("contracts_with_trueups"),
        count_where(F.col("gross_margin") < 0).alias("contracts_negative_margin"),
    )


def negative_margin(mart: DataFrame) -> DataFrame:
    return mart.where(F.col("gross_margin") < 0)


def top_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First n rows. End the order with a unique key, or ties at the cut are decided by chance."""
    return df.orderBy(*order).limit(n)


def latest_months(by_month: DataFrame, n: int = 12) -> DataFrame:
    return top_rows(by_month, n, F.col("month").desc())


def recent_contracts(mart: DataFrame, n: int) -> DataFrame:
    return top_rows(mart, n, F.col("month").desc(), F.col("contract_id"), F.col("contract_version"))


def open_days(classes: DataFrame) -> DataFrame:
    """Days of each contract-month without a reading, and with one that came after the backfill window."""
    overdue = ~F.col("missing") & (F.col("lateness_class") == ESTIMATED)
    return classes.groupBy(
        "contract_id", "contract_version", month_floor(F.col("reading_date")).alias("month")
    ).agg(count_where(F.col("missing")).alias("missing_days"), count_where(overdue).alias("overdue_days"))


def _with_signed(mart: DataFrame, classes: DataFrame) -> DataFrame:
    """A contract-month may be signed off if no reading is estimated, missing or came after the backfill window."""
    closed = (F.col("estimated_days") == 0) & (F.col("missing_days") == 0) & (F.col("overdue_days") == 0)
    keys = ["contract_id", "contract_version", "month"]
    return mart.join(open_days(classes), keys, "left").withColumn("signed", F.coalesce(closed, F.lit(False)))


def signoff_set(mart: DataFrame, classes: DataFrame) -> DataFrame:
    """Contract-months with a reading in time for every day, the only ones finance may sign off.

    ``classes`` are the lateness classes of all contract days. The mart's own column counts the readings
    that are labelled estimated; days without any are only known to the calendar.
    """
    return _with_signed(mart, classes).where("signed").select(
        "contract_id", "contract_version", "month", "total_kw", "erp_revenue_total", "gross_margin"
    )


def signoff_share(mart: DataFrame, classes: DataFrame) -> DataFrame:
    """How much of each month can be signed off, by contract rows and by kW."""
    signed = F.col("signed")
    return (
        _with_signed(mart, classes)
        .groupBy("month")
        .agg(
            F.count("*").alias("contract_rows"),
            count_where(signed).alias("signed_rows"),
            F.sum("total_kw").alias("total_kw"),
            F.sum(F.when(signed, F.col("total_kw")).otherwise(F.lit(0))).alias("signed_kw"),
        )
        .withColumn("signed_row_share", ratio(F.col("signed_rows"), F.col("contract_rows")))
        .withColumn("signed_kw_share", ratio(F.col("signed_kw"), F.col("total_kw")))
    )


SIGNED_VALUES = ("total_kw", "erp_revenue_total", "gross_margin")


def newly_signed(signed: DataFrame, lock: DataFrame) -> DataFrame:
    """Contract-months that may be signed off now and were not before; what is signed stays as it was signed."""
    keys = ["contract_id", "contract_version", "month"]
    return signed.select(*keys, *SIGNED_VALUES).join(lock.select(*keys), keys, "left_anti")


def lock_conflicts(lock: DataFrame, mart: DataFrame) -> DataFrame:
    """Signed contract-months whose values a rebuilt mart would change, with both and the change of margin.

    A contract-month the mart no longer has would lose its values: they are NULL on the mart's side.
    """
    keys = ["contract_id", "contract_version", "month"]
    now = mart.select(*keys, *[F.col(c).alias(f"rebuilt_{c}") for c in SIGNED_VALUES])
    signed = lock.select(*keys, *[F.col(c).alias(f"signed_{c}") for c in SIGNED_VALUES])
    differs = [~F.col(f"signed_{c}").eqNullSafe(F.col(f"rebuilt_{c}")) for c in SIGNED_VALUES]
    change = F.coalesce("rebuilt_gross_margin", F.lit(0)) - F.coalesce("signed_gross_margin", F.lit(0))
    return signed.join(now, keys, "left").where(differs[0] | differs[1] | differs[2]).withColumn("gross_margin_change", change)
