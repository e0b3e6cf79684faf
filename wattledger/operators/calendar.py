"""Calendars of contracts: days with and without readings, months in which a version is active."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattledger.functions.expressions import BACKFILL_DAYS, day_sequence, lateness, month_sequence


def reading_calendar(effective_meter: DataFrame, contracts: DataFrame) -> DataFrame:
    """Every day of every contract version, with its reading where there is one.

    Built without joining readings to a spine of days. Each version gets a marker before its first and
    after its last day; each row then stretches over the days up to the next one. Readings cross the
    network once, the days are generated after the shuffle, and no window holds more rows than the
    version has days.
    """
    readings = effective_meter.select(
        "contract_id", "contract_version", "reading_date", "used_kw", "ingested_at", F.lit(False).alias("marker")
    )
    edges = F.array(F.date_sub("effective_start", 1), F.date_add("effective_end", 1))
    markers = contracts.select(
        "contract_id",
        "contract_version",
        F.explode(edges).alias("reading_date"),
        F.lit(None).cast("decimal(10,2)").alias("used_kw"),
        F.lit(None).cast("timestamp_ntz").alias("ingested_at"),
        F.lit(True).alias("marker"),
    )
    order = W.partitionBy("contract_id", "contract_version").orderBy("reading_date")
    marker, read_on = F.col("marker"), F.col("reading_date")
    first = F.when(marker, F.date_add(read_on, 1)).otherwise(read_on)
    stretched = (
        readings.unionByName(markers)
        .withColumn("next_date", F.lead("reading_date").over(order))
        .where(F.col("next_date").isNotNull())
        .withColumn("day", F.explode(day_sequence(first, F.date_sub("next_date", 1))))
    )
    present = ~marker & (F.col("day") == read_on)
    return stretched.select(
        "contract_id",
        "contract_version",
        F.col("day").alias("reading_date"),
        F.when(present, F.col("used_kw")).alias("used_kw"),
        F.when(present, F.col("ingested_at")).alias("ingested_at"),
        (~present).alias("missing"),
    )


def missing_readings(effective_meter: DataFrame, contracts: DataFrame) -> DataFrame:
    return (
        reading_calendar(effective_meter, contracts)
        .where("missing")
        .select("contract_id", "contract_version", "reading_date")
    )


def lateness_classes(
    effective_meter: DataFrame, contracts: DataFrame, backfill_days: int = BACKFILL_DAYS
) -> DataFrame:
    """Every contract day as on_time, late or estimated, judged by arrival and not by the meter's own label."""
    return reading_calendar(effective_meter, contracts).select(
        "contract_id",
        "contract_version",
        "reading_date",
        "missing",
        lateness(F.col("reading_date"), F.col("ingested_at"), backfill_days).alias("lateness_class"),
    )


def active_contract_months(contracts: DataFrame) -> DataFrame:
    """One row per version and month its window touches; explodes months, so there is no overlap join."""
    return contracts.withColumn(
        "month", F.explode(month_sequence(F.col("effective_start"), F.col("effective_end")))
    )


def contract_mrr(contracts: DataFrame) -> DataFrame:
    """Contract-defined recurring charge of every active month; a part month is not prorated."""
    return active_contract_months(contracts).select(
        "contract_id",
        "contract_version",
        "customer_id",
        "month",
        F.round(F.col("power_commit_kw") * F.col("price_per_kw"), 2).cast("decimal(14,2)").alias("contract_mrr"),
    )
