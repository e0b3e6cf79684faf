"""Domain tables derived from the star-schema test tables.

A contract is a supplier, a meter or rack reading is a shipped line, an invoice line is a line of its
order, and the monthly site cost is a share of that month's orders. Everything is a column expression
over the whole tables; the SQL in ``plans.oracle`` states the same rules a second time.

Keys stay BIGINT as in the source. The site-wide cost is kept wider than the declared DECIMAL(14,2),
which a large site total would overflow.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.functions.expressions import (
    CREDIT,
    ESTIMATED,
    LATE,
    ON_TIME,
    OVERAGE,
    RECURRING,
    day_sequence,
    month_end,
    month_floor,
)
from wattledger.operators.dedupe import latest_readings

# Fixed values of the derivation.
FIRST_DAY, LAST_DAY = "1995-01-01", "2001-12-31"
AMENDED_FROM, AMENDED_UNTIL = "1998-04-01", "1998-03-31"
AMENDED_MID_MONTH, RUNS_ON_UNTIL = "1998-04-15", "1998-06-30"

# Tie-breaks after the arrival time; together they order every line of one contract and day.
LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


# Columns read from each source table. Declaring them spares a job per table that reads file footers.
_COLUMNS = {
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "orders": "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"
    ),
}


@dataclass(frozen=True)
class SourceTables:
    customers: DataFrame
    contracts: DataFrame
    meter: DataFrame
    racks: DataFrame
    invoices: DataFrame
    power_cost: DataFrame


class DerivedTables:
    """The same tables derived from one directory, each on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._from = (spark, sf_dir)

    @cached_property
    def customers(self) -> DataFrame:
        return customers(*self._from)

    @cached_property
    def contracts(self) -> DataFrame:
        return contracts(*self._from)

    @cached_property
    def meter(self) -> DataFrame:
        return meter(*self._from)

    @cached_property
    def racks(self) -> DataFrame:
        return racks(*self._from)

    @cached_property
    def invoices(self) -> DataFrame:
        return invoices(*self._from)

    @cached_property
    def power_cost(self) -> DataFrame:
        return power_cost(*self._from)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(T.StructType.fromDDL(_COLUMNS[table])).parquet(f"{sf_dir}/{table}.parquet")


def _version_on(contract_id: Column, day: Column) -> Column:
    amended = (contract_id % 5 < 3) & (day >= F.lit(AMENDED_FROM).cast("date"))
    return F.when(amended, 2).otherwise(1)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = _read(spark, sf_dir, "supplier"), _read(spark, sf_dir, "nation")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("customer_id"),
        F.col("s_name").alias("customer_name"),
        F.col("n_name").alias("industry"),
        F.lit(FIRST_DAY).cast("date").alias("start_date"),
    )


def contracts(spark: SparkSession, sf_dir: str, overlapping: bool = False) -> DataFrame:
    """``overlapping`` amends in the middle of a month and lets the first version run on after it."""
    key = F.col("s_suppkey")
    amended = key % 5 < 3
    second = F.col("contract_version") == 2
    commit = (20 + key % 31).cast("decimal(10,2)")
    price = (180 + key % 271).cast("decimal(10,2)")
    versions = F.when(amended, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        _read(spark, sf_dir, "supplier")
        .select("s_suppkey", F.explode(versions).alias("contract_version"))
        .select(
            key.alias("contract_id"),
            "contract_version",
            key.alias("customer_id"),
            F.when(second, F.lit(AMENDED_MID_MONTH if overlapping else AMENDED_FROM)).otherwise(F.lit(FIRST_DAY)).cast("date").alias("effective_start"),
            F.when(amended & ~second, F.lit(RUNS_ON_UNTIL if overlapping else AMENDED_UNTIL))
            .otherwise(F.lit(LAST_DAY))
            .cast("date")
            .alias("effective_end"),
            (1 + key % 10).cast("int").alias("racks_entitled"),
            F.when(second, (commit * F.lit("1.1").cast("decimal(2,1)")).cast("decimal(10,2)"))
            .otherwise(commit)
            .alias("power_commit_kw"),
            F.when(second, (price * F.lit("1.05").cast("decimal(3,2)")).cast("decimal(10,2)"))
            .otherwise(price)
            .alias("price_per_kw"),
            F.when(key % 2 == 1, "Premium").otherwise("Standard").alias("sla_tier"),
            (key % 2 == 1).alias("overage_allowed_flag"),
        )
    )


# Windows of contracts by contract_id % 4: one that outlasts its successors, a gap, versions numbered against
# time, and a nested window before an overlap and a gap.
TANGLED = (
    (("1995-01-01", "2001-12-31"), ("1998-04-01", "1998-06-30"), ("1998-07-01", "2001-12-31")),
    (("1995-01-01", "1996-12-31"), ("1997-02-01", "2001-12-31")),
    (("1997-01-01", "2001-12-31"), ("1995-01-01", "1996-12-31")),
    (("1995-01-01", "1999-12-31"), ("1996-01-01", "1996-12-31"), ("1999-06-01", "2000-12-31"), ("2001-03-01", "2001-12-31")),
)


def tangled_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract windows with every fault a window check must find."""
    date = lambda day: F.lit(day).cast("date")
    lists = [
        F.array(*[F.struct(F.lit(v).alias("contract_version"), date(a).alias("effective_start"), date(b).alias("effective_end")) for v, (a, b) in enumerate(windows, 1)])
        for windows in TANGLED
    ]
    of = F.get(F.array(*lists), (F.col("s_suppkey") % len(TANGLED)).cast("int"))
    return _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("contract_id"), F.inline(of))


def _shipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped lines with the fields the two daily facts share."""
    return _read(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_suppkey").alias("contract_id"),
        F.col("l_linenumber").alias("racks_used"),
        (F.col("l_shipdate") + F.make_dt_interval((F.col("l_orderkey") % 11).cast("int"))).alias("ingested_at"),
        *LINE_ORDER,
    )


def meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily meter readings, not deduplicated, about 3 % labelled with the other contract version."""
    day = F.col("day")
    version = _version_on(F.col("contract_id"), day)
    bucket = F.col("l_orderkey") % 100
    return _shipped_lines(spark, sf_dir).select(
        day.alias("reading_date"),
        "contract_id",
        F.when(F.col("l_partkey") % 33 == 0, 3 - version).otherwise(version).alias("contract_version"),
        F.col("l_quantity").cast("decimal(10,2)").alias("used_kw"),
        F.when(bucket < 8, LATE).when(bucket < 12, ESTIMATED).otherwise(ON_TIME).alias("reading_status"),
        "ingested_at",
        F.struct(*LINE_ORDER).alias("source_order"),
    )


def racks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rack counts, not deduplicated, always labelled with the version in force."""
    day = F.col("day")
    return _shipped_lines(spark, sf_dir).select(
        day.alias("usage_date"),
        "contract_id",
        _version_on(F.col("contract_id"), day).alias("contract_version"),
        "racks_used",
        "ingested_at",
        F.struct(*LINE_ORDER).alias("source_order"),
    )


def invoices(spark: SparkSession, sf_dir: str, misfiled: bool = False) -> DataFrame:
    """ERP lines. ``misfiled`` books some under the other version and some one month late."""
    lines = _read(spark, sf_dir, "lineitem").select(
        # Cents take half the bytes of a double in the shuffle.
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", F.col("l_extendedprice").cast("decimal(12,2)").alias("price")
    )
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    posting = F.col("o_orderdate").cast("date")
    version, month = _version_on(F.col("l_suppkey"), posting), month_floor(posting)
    if misfiled:
        version = F.when(F.col("l_partkey") % 47 == 0, 3 - version).otherwise(version)
        month = F.when(F.col("l_partkey") % 53 == 0, F.add_months(month, 1)).otherwise(month)
    price = F.col("price")
    kind = F.col("l_returnflag")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_linenumber").alias("invoice_line_id"),
        posting.alias("posting_date"),
        month.alias("invoice_month"),
        F.col("l_suppkey").alias("contract_id"),
        version.alias("contract_version"),
        F.when(kind == "N", RECURRING).when(kind == "A", OVERAGE).otherwise(CREDIT).alias("revenue_type"),
        F.when(kind == "R", (price * F.lit("-0.2").cast("decimal(2,1)")).cast("decimal(12,2)"))
        .otherwise(price)
        .alias("amount"),
    )


def power_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = month_floor(F.col("o_orderdate").cast("date"))
    return (
        _read(spark, sf_dir, "orders")
        .groupBy(month.alias("cost_month"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("ordered"))
        .select(
            "cost_month",
            F.lit(1).alias("site_id"),
            (F.col("ordered") * F.lit("0.35").cast("decimal(2,2)")).cast("decimal(20,2)").alias("total_power_cost"),
            F.lit("kw_share").alias("allocation_method"),
            (F.month("cost_month") % 8 == 0).alias("true_up_flag"),
        )
    )


def dense_meter(spark: SparkSession, sf_dir: str, corrected: bool = False) -> DataFrame:
    """Readings of every tenth contract, each carried on in time over the days up to the next one.

    ``corrected`` adds 1 kW to every twentieth contract's readings in March, June and September.
    """
    day = F.col("day")
    latest = latest_readings(meter(spark, sf_dir).where(F.col("contract_id") % 10 == 0))
    following = F.lead("reading_date").over(W.partitionBy("contract_id").orderBy("reading_date"))
    until = F.coalesce(F.date_sub(following, 1), F.lit(LAST_DAY).cast("date"))
    days = latest.withColumn("until", until).withColumn("day", F.explode(day_sequence(F.col("reading_date"), F.col("until"))))
    own = day == F.col("reading_date")
    more = F.when((F.col("contract_id") % 20 == 0) & F.month("day").isin(3, 6, 9), 1).otherwise(0) if corrected else F.lit(0)
    return days.select(
        day.alias("reading_date"),
        "contract_id",
        F.when(own, F.col("contract_version")).otherwise(_version_on(F.col("contract_id"), day)).alias("contract_version"),
        (F.col("used_kw") + more).cast("decimal(10,2)").alias("used_kw"),
        F.when(own, F.col("reading_status")).otherwise(ON_TIME).alias("reading_status"),
        F.when(own, F.col("ingested_at")).otherwise(day.cast("timestamp_ntz") + F.expr("interval 6 hours")).alias("ingested_at"),
    )


def cost_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site cost of each month each time it became known anew: an order is known up to 44 days after its date."""
    ordered = F.col("o_orderdate").cast("date")
    known = F.date_add(ordered, (F.col("o_orderkey") % 45).cast("int"))
    by_day = (
        _read(spark, sf_dir, "orders")
        .groupBy(month_floor(ordered).alias("cost_month"), known.alias("known_from"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("ordered"))
    )
    # A month becomes known over 75 days at most, which bounds this window.
    so_far = F.sum("ordered").over(W.partitionBy("cost_month").orderBy("known_from"))
    cost = (so_far.cast("decimal(22,2)") * F.lit("0.35").cast("decimal(2,2)")).cast("decimal(20,2)")
    return by_day.select("cost_month", F.lit(1).alias("site_id"), "known_from", cost.alias("total_power_cost"))


def closes(spark: SparkSession, sf_dir: str, days: int) -> DataFrame:
    """A close of every month with orders, so many days after its end."""
    months = _read(spark, sf_dir, "orders").select(month_floor(F.col("o_orderdate").cast("date")).alias("cost_month")).distinct()
    return months.withColumn("close_on", F.date_add(month_end(F.col("cost_month")), days))
