from datetime import date

import pytest
from conftest import rows
from test_mart import tables

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wattledger.operators import reconciliation
from wattledger.plans import warehouse
from wattledger.plans.frames import Frames
from wattledger.schemas import (
    ALL_TABLES,
    DIM_CONTRACT,
    ERP_REVENUE_MONTHLY,
    FACT_COST,
    FACT_INVOICE,
    FACT_METER,
    FACT_RACK,
    LAYERS,
    MART,
    RACK_MONTHLY,
    RECON,
    USAGE_MONTHLY,
)
from wattledger.sources.driver_tables import SourceTables
from wattledger.sources.files import new_folder, own_dir, read_csv, scratch_dir, write_csv
from wattledger.sources.layers import LOAD_SIZES, LayerStore
from wattledger.sources.ledger import LedgerStore, WriteMismatch

JAN, FEB = date(2023, 1, 1), date(2023, 2, 1)


def stamp():
    return F.lit("2023-03-01").cast("timestamp")


@pytest.fixture
def store(spark, tmp_path):
    s = LayerStore(spark, str(tmp_path / "store"), prefix=f"t{abs(hash(tmp_path)) % 10**9}_")
    yield s
    for layer in LAYERS:
        spark.sql(f"DROP DATABASE IF EXISTS {s.database(layer)} CASCADE")


def two_months(make):
    return tables(
        make,
        meter=({}, {"reading_date": "2023-02-10"}),
        invoices=({}, {"invoice_id": 2, "invoice_month": "2023-02-01"}),
        cost=({}, {"cost_month": "2023-02-01"}),
    )


def test_csv_round_trip_keeps_bits_and_cents(spark, make, tmp_path):
    contracts = make("dim_contract", {}, {"contract_id": 102, "overage_allowed_flag": False, "price_per_kw": "420.89"})
    write_csv(contracts, str(tmp_path / "c"))
    text = "".join(p.read_text() for p in (tmp_path / "c").glob("*.csv"))
    assert text.splitlines()[0].startswith("contract_id,contract_version,customer_id") and ",420.89,Standard,0" in text
    back = read_csv(spark, str(tmp_path / "c"), DIM_CONTRACT)
    assert back.dtypes == contracts.dtypes and rows(back) == rows(contracts)


def test_csv_times_are_cut_to_seconds(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text(
        "reading_date,contract_id,contract_version,used_kw,reading_status,ingested_at\n"
        "2023-01-01,101,1,19.5,on_time,2026-01-05 10:11:12.987654\n2023-01-02,101,1,,late,2026-01-05 10:11:13\n"
    )
    back = read_csv(spark, str(path), FACT_METER)
    assert [r.ingested_at.isoformat() for r in back.orderBy("reading_date").collect()] == [
        "2026-01-05T10:11:12", "2026-01-05T10:11:13",
    ]
    assert rows(back, "reading_date", "used_kw") == [("2023-01-01", 19.5), ("2023-01-02", None)]


@pytest.mark.parametrize(
    "text, complaint",
    [
        ("site_id,cost_month,total_power_cost,allocation_method,true_up_flag\n1,2023-01-01,1.5,kw_share,0\n", "header does not conform"),
        ("cost_month,site_id,total_power_cost,allocation_method,true_up_flag\n2023-01-01,one,1.5,kw_share,0\n", "MALFORMED_RECORD"),
    ],
)
def test_csv_in_another_shape_fails_instead_of_turning_null(spark, tmp_path, text, complaint):
    path = tmp_path / "bad.csv"
    path.write_text(text)
    with pytest.raises((PySparkException, Py4JJavaError), match=complaint):
        read_csv(spark, str(path), FACT_COST).collect()


def test_layers_hold_all_tables_and_creation_repeats(spark, store):
    store.create()
    store.create()
    for table in ALL_TABLES:
        assert spark.catalog.tableExists(store.name(table))
        stored = dict(spark.table(store.name(table)).dtypes)
        assert {f.name: f.dataType.simpleString() for f in table.schema.fields}.items() <= stored.items()


def test_append_adds_and_overwrite_replaces_touched_months_only(make, store):
    store.create([FACT_METER, USAGE_MONTHLY])
    store.append(make("fact_meter_power_daily", {}), FACT_METER)
    store.append(make("fact_meter_power_daily", {}, {"reading_date": "2023-02-10"}), FACT_METER)
    assert store.read(FACT_METER).count() == 3
    assert store.read(FACT_METER, [FEB]).count() == 1
    store.overwrite(make("fact_meter_power_daily", {"used_kw": "7.00"}), FACT_METER, [JAN])
    assert rows(store.read(FACT_METER), "reading_date", "used_kw") == [("2023-01-10", 7.0), ("2023-02-10", 10.0)]
    store.overwrite(make("fact_meter_power_daily", {"used_kw": "8.00"}), FACT_METER)
    assert rows(store.read(FACT_METER), "reading_date", "used_kw") == [("2023-01-10", 8.0)]
    assert store.read(FACT_METER, [FEB]).isEmpty()


def test_overwrite_empties_rebuilt_months_without_rows(make, store):
    store.create([FACT_METER])
    store.append(make("fact_meter_power_daily", {}, {"reading_date": "2023-02-10"}), FACT_METER)
    store.overwrite(make("fact_meter_power_daily", {}), FACT_METER, [JAN, FEB])
    assert rows(store.read(FACT_METER), "reading_date") == [("2023-01-10",)]
    store.append(make("fact_meter_power_daily", {"reading_date": "2023-02-11"}), FACT_METER)
    assert rows(store.read(FACT_METER, [FEB]), "reading_date") == [("2023-02-11",)]


def test_month_read_prunes_partitions(make, store):
    store.create([FACT_INVOICE])
    store.append(make("fact_invoice_line", {}), FACT_INVOICE)
    plan = store.read(FACT_INVOICE, [FEB])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(invoice_month" in plan


def test_stored_build_equals_the_composed_frames(make, store):
    t = two_months(make)
    for _ in range(2):
        warehouse.load_sources(store, t)
    warehouse.build(store, stamp())
    f = Frames(t)
    assert rows(store.read(MART)) == rows(f.mart)
    assert rows(store.read(RECON).drop("last_reconciled_at")) == rows(f.recon.drop("last_reconciled_at"))


@pytest.fixture
def ledger(spark, tmp_path):
    s = LedgerStore(spark, str(tmp_path / "store"), prefix=f"l{abs(hash(tmp_path)) % 10**9}_")
    yield s
    s.drop()


def status(store, *tables):
    found = store.check(tables or (FACT_METER, FACT_INVOICE, FACT_COST, USAGE_MONTHLY, ERP_REVENUE_MONTHLY, MART))
    return {(r.table_name, r.month and r.month.isoformat()) for r in found.where("ledger_status = 'Red'").collect()}


def test_ledger_agrees_with_what_the_store_wrote(make, ledger):
    for _ in range(2):
        warehouse.load_sources(ledger, two_months(make))
        warehouse.build(ledger, stamp())
    warehouse.backfill(ledger, make("fact_meter_power_daily", {"reading_date": "2023-02-11"}, {"reading_date": "2023-03-01"}), stamp())
    warehouse.backfill_invoices(ledger, make("fact_invoice_line", {"invoice_id": 2, "invoice_month": "2023-01-01"}), stamp())
    assert status(ledger) == set()
    checked = ledger.check([MART, FACT_COST]).orderBy("table_name", "month")
    assert rows(checked, "table_name", "month", "stored_rows") == [
        ("fact_power_cost_monthly", None, 2), ("mart_contract_monthly", "2023-01-01", 1), ("mart_contract_monthly", "2023-02-01", 1), ("mart_contract_monthly", "2023-03-01", 1),
    ]
    ledger.overwrite(make("fact_meter_power_daily", {}), FACT_METER)
    assert status(ledger, FACT_METER) == set() and ledger.check([FACT_METER]).count() == 1


@pytest.mark.parametrize("fault", ["lost", "doubled", "priced", "foreign"])
def test_ledger_and_reconciliation_show_what_changed_behind_the_store(spark, make, ledger, fault):
    warehouse.load_sources(ledger, two_months(make))
    warehouse.build(ledger, stamp())
    colours = lambda: dict(rows(recon_of(ledger), "month", "control_status"))
    before, counted = colours(), ledger.read(MART).count()
    assert set(before.values()) == {"Green"}
    mart = warehouse.mart_rows(ledger, [JAN])
    altered = {
        "lost": mart.where("false"),
        "doubled": mart.unionByName(mart),
        "priced": mart.withColumn("erp_revenue_total", F.col("erp_revenue_total") * 2),
        "foreign": mart.withColumn("month", F.lit("2023-04-01").cast("date")),
    }[fault]
    LayerStore(spark, ledger.root, prefix=ledger.prefix).overwrite(altered, MART, [JAN, date(2023, 4, 1)])
    broken = {"2023-01-01", "2023-04-01"} if fault == "foreign" else {"2023-01-01"}
    assert status(ledger) == {("mart_contract_monthly", m) for m in broken}
    assert {m for m, c in colours().items() if c == "Red"} == broken
    assert ledger.read(MART).count() == counted + {"lost": -1, "doubled": 1}.get(fault, 0)
    # The next rebuild of the month puts it right.
    warehouse.build_mart(ledger, [JAN, date(2023, 4, 1)])
    assert status(ledger) == set() and colours() == before


def recon_of(store):
    billed = store.read(ERP_REVENUE_MONTHLY).withColumnRenamed("erp_revenue_total", "amount")
    return reconciliation.recon_erp_vs_mart_monthly(billed, store.read(MART))


def test_a_write_onto_altered_rows_is_refused_an_entry(spark, make, ledger):
    ledger.create([FACT_METER])
    ledger.append(make("fact_meter_power_daily", {}), FACT_METER)
    LayerStore(spark, ledger.root, prefix=ledger.prefix).append(make("fact_meter_power_daily", {}), FACT_METER)
    with pytest.raises(WriteMismatch):
        ledger.append(make("fact_meter_power_daily", {}), FACT_METER)
    assert status(ledger, FACT_METER) == {("fact_meter_power_daily", "2023-01-01")}


def test_composed_reconciliation_reads_the_mart(make):
    f = Frames(two_months(make))
    assert {r.control_status for r in f.recon.collect()} == {"Green"}
    f = Frames(two_months(make))
    f.mart = f.mart.where("month <> '2023-02-01'")
    assert dict(rows(f.recon, "month", "control_status")) == {"2023-01-01": "Green", "2023-02-01": "Red"}


def test_views_over_the_store_read_stored_months(spark, make, store):
    warehouse.load_sources(store, two_months(make))
    warehouse.build(store, stamp())
    warehouse.StoredFrames(store).register_views()
    summary = spark.sql("SELECT month, contract_rows FROM v_controls_summary ORDER BY month DESC LIMIT 1")
    assert rows(summary) == [("2023-02-01", 1)]
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert "mart_contract_monthly" in plan and "fact_" not in plan


def test_backfill_rebuilds_its_months_and_may_run_again(make, store):
    warehouse.load_sources(store, two_months(make))
    warehouse.build(store, stamp())
    late = make(
        "fact_meter_power_daily",
        {"reading_date": "2023-02-10", "used_kw": "30.00", "reading_status": "late", "ingested_at": "2023-02-14 06:00:00"},
    )
    for _ in range(2):
        assert warehouse.backfill(store, late, stamp()) == [FEB]
        assert rows(store.read(MART), "month", "total_kw", "late_reading_days") == [
            ("2023-01-01", 10.0, 0),
            ("2023-02-01", 30.0, 1),
        ]
    assert rows(store.read(RECON), "month", "variance_bucket") == [
        ("2023-01-01", "No Flag"), ("2023-02-01", "Late Meter Data"),
    ]


def test_full_rebuild_leaves_nothing_of_removed_months(make, store):
    warehouse.load_sources(store, two_months(make))
    warehouse.build(store, stamp())
    assert store.read(MART, [FEB]).count() == 1
    # The contract ends in January: no reading of February counts any more, and its line is taken back.
    ended = tables(
        make,
        contracts=({"effective_end": "2023-01-31"},),
        meter=({}, {"reading_date": "2023-02-10"}),
        cost=({}, {"cost_month": "2023-02-01"}),
    )
    warehouse.load_sources(store, ended)
    warehouse.build(store, stamp())
    for table, month in ((USAGE_MONTHLY, "usage_month"), (RACK_MONTHLY, "usage_month"), (ERP_REVENUE_MONTHLY, "invoice_month"), (MART, "month"), (RECON, "month")):
        assert {r[0] for r in store.read(table).select(month).collect()} <= {JAN}, table.name
    # An emptied fact empties what is built on it.
    warehouse.load_sources(store, tables(make, meter=()))
    warehouse.build(store, stamp())
    assert store.read(USAGE_MONTHLY).isEmpty() and store.read(MART).isEmpty()


def test_a_load_deals_no_rows_and_a_build_deals_readings_once(spark, make, store, monkeypatch):
    """Readings and lines are written as they come, latest readings and their monthly sums share one shuffle."""
    plans = {}

    def replace(rows, table, settings):
        plans[table.name] = rows._jdf.queryExecution().executedPlan().toString()
        LayerStore._replace(store, rows, table, settings)

    monkeypatch.setattr(store, "_replace", replace)
    before = {key: spark.conf.get(key) for key in (*LOAD_SIZES, "spark.sql.files.openCostInBytes")}
    warehouse.load_sources(store, two_months(make))
    warehouse.build(store, stamp())
    assert not any("Exchange" in plans[t.name] for t in (FACT_METER, FACT_RACK, FACT_INVOICE))
    for table in (USAGE_MONTHLY, RACK_MONTHLY):
        dealt = [line for line in plans[table.name].split("\n") if "Exchange hashpartitioning" in line]
        # One by contract and month, one that deals the result by month.
        assert len(dealt) == 2 and "REBALANCE" in dealt[0] and "hashpartitioning(contract_id" in dealt[1] and "trunc(" in dealt[1]
    assert {key: spark.conf.get(key) for key in before} == before


def test_build_takes_the_latest_of_many_copies(make, store):
    """Later arrival first, then the largest values; readings without a day or an arrival lose or count nowhere."""
    copies = [{"used_kw": f"{n}.00", "ingested_at": f"2023-01-1{n % 3} 06:00:00"} for n in range(9)]
    copies += [{"used_kw": "99.00"}, {"used_kw": "77.00", "ingested_at": "2023-01-20 06:00:00"}]
    # The later of the eleventh, by its values, names a version that the contract does not have.
    copies += [{"reading_date": "2023-01-11", "used_kw": "6.00"}, {"reading_date": "2023-01-11", "used_kw": "5.00", "contract_version": 2}]
    meter = make("fact_meter_power_daily", *copies).withColumns({
        "ingested_at": F.when(F.col("used_kw") != 99, F.col("ingested_at")),
        "reading_date": F.when(F.col("used_kw") != 77, F.col("reading_date")),
    })
    given = two_months(make)
    warehouse.load_sources(store, SourceTables(given.customers, given.contracts, meter.repartition(5), given.racks, given.invoices, given.power_cost))
    warehouse.build(store, stamp())
    assert rows(store.read(USAGE_MONTHLY), "usage_month", "total_kw") == [("2023-01-01", 8.0)]


def test_backfill_stamps_readings_and_counts(make, store):
    warehouse.load_sources(store, two_months(make))
    warehouse.build(store, stamp())
    assert store.read(FACT_METER, audit=True).where("reprocessed_at IS NOT NULL").isEmpty()
    late = make("fact_meter_power_daily", {"reading_date": "2023-02-11", "used_kw": "5.00"})
    assert warehouse.backfill(store, late, stamp(), stamp()) == [FEB]
    stamped = store.read(FACT_METER, audit=True).where("reprocessed_at IS NOT NULL")
    assert rows(stamped, "reading_date") == [("2023-02-11",)]
    racks = make("fact_rack_utilization_daily", {"usage_date": "2023-02-10", "racks_used": 9})
    for _ in range(2):
        assert warehouse.backfill_racks(store, racks, stamp(), stamp()) == [FEB]
        assert rows(store.read(MART, [FEB]), "max_racks_used", "total_kw") == [(9, 15.0)]
    assert warehouse.backfill(store, late.where("false"), stamp()) == []


def test_backfill_of_a_corrected_line_replaces_it_wherever_it_was(make, store):
    warehouse.load_sources(store, two_months(make))
    warehouse.build(store, stamp())
    corrected = make("fact_invoice_line", {"invoice_id": 2, "invoice_month": "2023-01-01", "amount": "50.00"})
    for _ in range(2):
        assert warehouse.backfill_invoices(store, corrected, stamp(), stamp()) == ([JAN, FEB] if _ == 0 else [JAN])
        assert rows(store.read(MART), "month", "erp_revenue_total") == [("2023-01-01", 2050.0), ("2023-02-01", 0.0)]
    assert rows(store.read(FACT_INVOICE, audit=True).where("reprocessed_at IS NOT NULL"), "invoice_id") == [(2,)]


def test_scratch_follows_the_shared_setting(spark):
    assert scratch_dir(spark) != scratch_dir(spark)
    assert new_folder("hdfs://shared/state/", "yarn").startswith("hdfs://shared/state/wattledger-")
    for cluster in ("yarn", "local-cluster[3,2,3000]"):
        with pytest.raises(RuntimeError):
            new_folder(None, cluster)
    assert new_folder(None, "local[4]") and new_folder(None, "local")


def test_own_folders_are_emptied_and_used_again(spark):
    first = own_dir(spark, "a_query")
    spark.range(3).write.parquet(f"{first}/rows")
    assert own_dir(spark, "a_query") == first
    spark.range(2).write.parquet(f"{first}/rows")
    assert spark.read.parquet(f"{first}/rows").count() == 2
