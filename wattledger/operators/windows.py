"""Contract version windows: which version counts on which day.

Every range test comes with an equality on the contract, so it plans as a hash or sort-merge join with
a residual condition. No side carries a broadcast hint: contracts grow with the business, so Spark
broadcasts them only while their measured size is under its threshold and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UNKNOWN_VERSION, OUTSIDE_WINDOW = "unknown version", "outside window"


def _windows(contracts: DataFrame) -> DataFrame:
    return contracts.select("contract_id", "contract_version", "effective_start", "effective_end")


def _in_window(day: str):
    return F.col(day).between(F.col("effective_start"), F.col("effective_end"))


def effective(daily: DataFrame, contracts: DataFrame, day: str) -> DataFrame:
    """Daily rows inside the window of the version they name, both ends included."""
    joined = daily.join(_windows(contracts), ["contract_id", "contract_version"])
    return joined.where(_in_window(day)).select(*daily.columns)


def effective_meter(latest: DataFrame, contracts: DataFrame) -> DataFrame:
    return effective(latest, contracts, "reading_date")


def effective_racks(latest: DataFrame, contracts: DataFrame) -> DataFrame:
    return effective(latest, contracts, "usage_date")


def rejected_readings(latest: DataFrame, contracts: DataFrame, day: str = "reading_date") -> DataFrame:
    """The complement of ``effective``, with the reason. One join serves both reasons."""
    joined = latest.join(_windows(contracts), ["contract_id", "contract_version"], "left")
    unknown = F.col("effective_start").isNull()
    return joined.where(unknown | ~_in_window(day)).select(
        *latest.columns,
        F.when(unknown, UNKNOWN_VERSION).otherwise(OUTSIDE_WINDOW).alias("reject_reason"),
    )


def disjoint_windows(contracts: DataFrame) -> DataFrame:
    """The windows with every version ending before any later one starts: an amendment replaces what it amends.

    Windows that are left empty are dropped. The SQL window holds one contract's versions, as above.
    """
    later = W.partitionBy("contract_id").orderBy("contract_version").rowsBetween(1, W.unboundedFollowing)
    replaced = F.date_sub(F.min("effective_start").over(later), 1)
    return (
        _windows(contracts)
        .withColumn("effective_end", F.least(F.col("effective_end"), replaced))
        .where(F.col("effective_start") <= F.col("effective_end"))
    )


def version_in_force(rows: DataFrame, contracts: DataFrame, day: str) -> DataFrame:
    """Adds ``in_force_version``, the version whose window holds the day; NULL when none does.

    Where windows overlap the later version counts, so every row comes back once.
    """
    windows = disjoint_windows(contracts).withColumnRenamed("contract_version", "in_force_version").alias("w")
    left = rows.alias("r")
    matches = (F.col("r.contract_id") == F.col("w.contract_id")) & F.col(f"r.{day}").between(
        F.col("w.effective_start"), F.col("w.effective_end")
    )
    return left.join(windows, matches, "left").select("r.*", "w.in_force_version")


def reattributed_readings(latest: DataFrame, contracts: DataFrame) -> DataFrame:
    """Every reading under the version in force on its day, next to the version it was labelled with."""
    changed = ~F.col("contract_version").eqNullSafe(F.col("in_force_version"))
    return version_in_force(latest, contracts, "reading_date").select(
        "reading_date",
        "contract_id",
        F.col("contract_version").alias("stated_version"),
        "in_force_version",
        "used_kw",
        changed.alias("reattributed"),
    )


def version_windows(contracts: DataFrame) -> DataFrame:
    """A sweep over each contract's windows in order of their start: the days from the end of all windows so
    far to the next start; negative overlaps, positive leaves days that no version covers.

    ``covered_until`` is the latest end of a window and all before it, so a version overlaps with any earlier
    one that still runs, not only with its neighbour, and no gap is seen where an earlier window goes on.
    Windows that start together are in order of their version. The SQL window holds one contract's versions,
    which do not grow with the fact tables.
    """
    order = W.partitionBy("contract_id").orderBy("effective_start", "contract_version")
    gap = F.col("gap_days")
    return (
        _windows(contracts)
        .withColumn("covered_until", F.max("effective_end").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
        .withColumn("next_start", F.lead("effective_start").over(order))
        .withColumn("gap_days", F.datediff("next_start", "covered_until") - 1)
        .withColumn(
            "window_status",
            F.when(gap.isNull(), "last").when(gap < 0, "overlap").when(gap > 0, "gap").otherwise("contiguous"),
        )
    )


def amendments(contracts: DataFrame) -> DataFrame:
    """Versions that followed another one, with the change of every commercial term."""
    order = W.partitionBy("contract_id").orderBy("contract_version")
    terms = ("racks_entitled", "power_commit_kw", "price_per_kw")
    previous = {t: F.lag(t).over(order) for t in terms}
    staged = contracts.select(
        "contract_id",
        "contract_version",
        "effective_start",
        *terms,
        F.lag("contract_version").over(order).alias("previous_version"),
        *[previous[t].alias(f"previous_{t}") for t in terms],
    )
    return staged.where(F.col("previous_version").isNotNull()).select(
        "contract_id",
        "contract_version",
        "previous_version",
        F.col("effective_start").alias("amended_from"),
        *[(F.col(t) - F.col(f"previous_{t}")).alias(f"{t}_change") for t in terms],
    )
