"""Physical plans: what must hold at any size, and that skew is met by splitting and not by luck."""

import re

import pytest
from conftest import rows

from pyspark.sql import functions as F

from wattledger.operators import dedupe, integrity, leakage, monthly, windows
from wattledger.plans import catalog
from wattledger.plans.frames import Frames
from wattledger.session import INITIAL_PARTITIONS, SHUFFLE_BYTES, TASK_BYTES, bound_tasks, split_hot_keys
from wattledger.sources import driver_tables

SF_DIR = "/root/testdata/sf0.001"
WRITES = {
    "csv_contracts", "csv_invoice_lines", "table_append_load", "mart_partition_overwrite",
    "stream_usage_daily", "stream_usage_monthly", "stream_intake", "mart_full_rebuild", "stream_day_status",
    "stream_usage_monthly_events", "layer_ledger_check", "load_audit", "csv_damaged_lines", "folder_load",
    "key_registry", "true_up_journal", "signoff_changes",
}


# The reconciliation reads the lines beside the mart, which has read them too: a control that shared its
# input with what it controls would see no fault in it.
TWO_LINE_SETS = {"controls_data_integrity": 2, "top_controls_integrity": 2, "controls_of_altered_mart": 2}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    df.collect()
    return plan_of(df).split("+- == Initial Plan ==")[0]


@pytest.fixture
def settings(spark):
    changed = {}

    def apply(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            changed[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield apply
    for key, value in changed.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.mark.parametrize("broadcasting", [True, False])
@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - WRITES))
def test_no_pairwise_joins_and_no_python(spark, settings, name, broadcasting):
    if not broadcasting:
        settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    plan = plan_of(catalog.queries()[name](spark, SF_DIR))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Python" not in plan and "Pandas" not in plan


def test_only_frames_of_one_row_per_month_are_broadcast_without_a_size_check(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    keys = re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan_of(Frames.from_dir(spark, SF_DIR).mart))
    assert keys and all(re.fullmatch(r"usage_month#\d+", k) for k in keys)


def test_scans_read_only_the_columns_used(spark):
    plan = Frames.from_dir(spark, SF_DIR).mart._jdf.queryExecution().optimizedPlan().toString()
    assert "l_comment" not in plan
    scan = plan_of(monthly.erp_revenue_monthly(Frames.from_dir(spark, SF_DIR).tables.invoices))
    assert sorted(re.findall(r"FileScan parquet \[([^\]]*)\]", re.sub(r"#\d+L?", "", scan))) == [
        "l_orderkey,l_suppkey,l_extendedprice,l_returnflag",
        "o_orderkey,o_orderdate",
    ]


def test_stored_mart_takes_the_exception_filter(spark, tmp_path):
    from wattledger.operators import exceptions

    Frames.from_dir(spark, SF_DIR).mart.write.parquet(str(tmp_path / "mart"))
    plan = plan_of(exceptions.exceptions_only(spark.read.parquet(str(tmp_path / "mart"))))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert all(c in pushed for c in ("late_reading_days", "estimated_days", "true_up_flag"))


def test_mart_reads_meter_readings_once(spark, settings):
    """Usage and the site totals share one deduplication shuffle, and the monthly joins add none."""
    settings(spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    plan = executed(Frames.from_dir(spark, SF_DIR).mart)
    assert len(re.findall(r"ReusedExchange \[[^\]]*contract_id[^\]]*reading_date", plan)) == 1
    assert plan.count("FileScan parquet [l_") == 3  # meter, racks and invoices
    joins = re.findall(r"SortMergeJoin \[contract_id#\d+L, contract_version#\d+, usage_month#\d+\]", plan)
    assert len(joins) == 2
    assert not re.search(r"Exchange hashpartitioning\(contract_id#\d+L, contract_version#\d+, usage_month#\d+, \d+\)", plan)


def test_no_query_does_the_heavy_work_twice(spark, settings):
    """One deduplication of the meter readings and one join of lines and orders, in whatever is read of them."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    for name in sorted(set(catalog.queries()) - WRITES):
        plan = executed(catalog.queries()[name](spark, SF_DIR))
        readings = re.findall(r"\n[^\n]*Exchange hashpartitioning\(key_hash#\d+L, contract_id#\d+L, reading_date", plan)
        assert len([r for r in readings if "Reused" not in r]) <= 1, name
        joins = len(re.findall(r"SortMergeJoin\(?(?:skew=true\) )?\s?\[l_orderkey", plan))
        assert joins <= TWO_LINE_SETS.get(name, 1), name


def test_copies_of_one_key_are_reduced_before_the_shuffle(spark, make):
    """A third of all readings are one contract and day: each map task still sends one row for it."""
    cold = make("fact_meter_power_daily", *[{"contract_id": c} for c in range(200, 300)])
    copies = spark.range(0, 50_000, 1, 8).select(
        F.lit("2023-05-05").cast("date").alias("reading_date"),
        F.lit(101).alias("contract_id"),
        F.lit(1).alias("contract_version"),
        (F.col("id") % 9000).cast("decimal(10,2)").alias("used_kw"),
        F.lit("on_time").alias("reading_status"),
        F.lit("2023-05-05 06:00:00").cast("timestamp_ntz").alias("ingested_at"),
    )
    meter = copies.unionByName(cold)
    latest = dedupe.latest_readings(meter)
    plan = executed(latest)
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "functions=[max(" in above and "functions=[partial_max(" in below
    assert rows(latest.where("contract_id = 101"), "used_kw") == [(8999.0,)]
    assert latest.count() == 101


def test_hot_contract_is_split_when_contracts_are_too_many_to_broadcast(spark, settings, make):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    contracts = make("dim_contract", *[{"contract_id": c} for c in range(100, 300)])
    lines = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("invoice_id"),
        F.lit(1).alias("invoice_line_id"),
        F.lit("2023-01-01").cast("date").alias("invoice_month"),
        F.when(F.col("id") % 3 == 0, 101).otherwise(100 + F.col("id") % 200).cast("int").alias("contract_id"),
        F.when(F.col("id") % 2 == 0, 2).otherwise(1).alias("contract_version"),
        F.lit("recurring").alias("revenue_type"),
        F.lit("5.00").cast("decimal(12,2)").alias("amount"),
    )
    stale = leakage.stale_version_billing(lines, contracts)
    assert stale.count() == 30_000
    assert "skew=true" in executed(stale)
    assert stale.where("stale_reason = 'other version in force'").count() == 30_000
    reattributed = windows.version_in_force(lines, contracts, "invoice_month")
    assert reattributed.where("in_force_version = 1").count() == 60_000


def test_hot_order_is_split_though_the_check_groups_by_it(spark, settings, tmp_path):
    """A third of all lines belong to one order, and orders are too many to broadcast."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    number = F.col("id")
    order = F.when(number % 3 == 0, 7).otherwise(number % 900)
    spark.range(0, 60_000, 1, 8).select(
        order.alias("l_orderkey"), (number % 5).alias("l_partkey"), (number % 50).alias("l_suppkey"),
        (number % 7).cast("int").alias("l_linenumber"), F.lit(2.0).alias("l_quantity"),
        F.lit(9.5).alias("l_extendedprice"), F.lit("N").alias("l_returnflag"),
        F.lit("1996-01-05").cast("timestamp_ntz").alias("l_shipdate"),
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(900).select(
        F.col("id").alias("o_orderkey"), F.lit(5.0).alias("o_totalprice"),
        F.lit("1996-01-01").cast("timestamp_ntz").alias("o_orderdate"),
    ).write.parquet(str(tmp_path / "orders.parquet"))
    split_hot_keys(spark)
    lines = driver_tables.invoices(spark, str(tmp_path))
    found = integrity.key_violations(lines, "fact_invoice_line", ("invoice_id", "invoice_line_id"))
    assert "skew=true" in executed(found)
    assert found.agg(F.sum("row_count")).collect()[0][0] == 60_000


@pytest.mark.parametrize("name", ["pk_violations", "load_audit"])
def test_registered_queries_bound_what_a_task_reads(spark, settings, name):
    advisory, split = TASK_BYTES
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="64MB", spark__sql__files__maxPartitionBytes="128MB")
    catalog.queries()[name](spark, SF_DIR)
    assert {k: int(spark.conf.get(k).rstrip("b")) for k in (advisory, split)} == TASK_BYTES
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB", spark__sql__files__maxPartitionBytes="3m")
    bound_tasks(spark)
    assert (spark.conf.get(advisory), spark.conf.get(split)) == ("20KB", "3m")


def test_partitions_of_a_load_follow_its_input(spark, settings, monkeypatch, tmp_path):
    """With few partitions set, twice the lines are dealt to twice as many, and all of them come out."""
    monkeypatch.setattr("wattledger.session.SHUFFLE_BYTES", 20_000)
    settings(spark__sql__shuffle__partitions="2", spark__sql__adaptive__advisoryPartitionSizeInBytes="1KB")
    settings(**{INITIAL_PARTITIONS.replace(".", "__"): "2"})
    initial = []
    for n in (6_000, 12_000):
        folder, number = tmp_path / str(n), F.col("id")
        spark.range(0, n, 1, 1).select(
            number.alias("l_orderkey"), F.xxhash64(number).alias("l_partkey"), (number % 50).alias("l_suppkey"),
            F.lit(1).alias("l_linenumber"), F.lit(2.0).alias("l_quantity"), (F.xxhash64(number) % 90_000 / 100).alias("l_extendedprice"),
            F.lit("N").alias("l_returnflag"), F.lit("1996-01-05").cast("timestamp_ntz").alias("l_shipdate"),
        ).write.parquet(str(folder / "lineitem.parquet"))
        spark.range(0, n, 1, 1).select(
            number.alias("o_orderkey"), F.lit(5.0).alias("o_totalprice"), F.lit("1996-01-01").cast("timestamp_ntz").alias("o_orderdate"),
        ).write.parquet(str(folder / "orders.parquet"))
        spark.range(0, 50, 1, 1).select(number.alias("s_suppkey"), F.lit("s").alias("s_name"), F.lit(1).alias("s_nationkey")).write.parquet(str(folder / "supplier.parquet"))
        audited = catalog.queries()["load_audit"](spark, str(folder))
        assert audited.agg(F.sum("copies")).collect()[0][0] == n
        initial.append(int(spark.conf.get(INITIAL_PARTITIONS)))
    assert 2 < initial[0] and 1.6 <= initial[1] / initial[0] <= 2.4
    monkeypatch.undo()
    bound_tasks(spark, 3 * SHUFFLE_BYTES)
    assert int(spark.conf.get(INITIAL_PARTITIONS)) == initial[1]


def test_contract_months_are_not_broadcast(spark, make):
    """A few contracts make many contract-months, which no task holds whole."""
    contracts = make("dim_contract", {}, {"contract_id": 102, "effective_start": "2023-03-01"})
    lines = make(
        "fact_invoice_line",
        {}, {"invoice_id": 2, "contract_id": 102}, {"invoice_id": 3, "contract_version": 2},
    )
    stale = leakage.stale_version_billing(lines, contracts)
    assert "Broadcast" not in executed(stale)
    assert rows(stale, "invoice_id", "in_force_version", "stale_reason") == [
        (2, None, leakage.NO_VERSION), (3, 1, leakage.OTHER_VERSION),
    ]
