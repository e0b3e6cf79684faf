"""Loads and closes: constraints that hold, damaged lines, files loaded once, keys, journals and sign-offs that stay."""

from datetime import date
from decimal import Decimal

import pytest
from conftest import rows

from pyspark.sql import functions as F

from wattledger.operators import allocation, exceptions
from wattledger.plans import warehouse
from wattledger.schemas import COST_JOURNAL, DIM_CONTRACT, FACT_INVOICE, SIGNOFF_LOCK, USAGE_MONTHLY
from wattledger.sources import admission, arrivals
from wattledger.sources.layers import LayerStore
from wattledger.sources.registry import KeyRegistry


@pytest.fixture
def store(spark, tmp_path):
    s = LayerStore(spark, str(tmp_path / "store"), prefix=f"a{abs(hash(tmp_path)) % 10**9}_")
    s.create([FACT_INVOICE])
    yield s
    s.drop()


def without_amount(lines):
    return lines.withColumn("amount", F.when(F.col("invoice_id") != 3, F.col("amount")))


def test_good_rows_are_published_and_others_listed_with_a_reason(make, store, tmp_path):
    lines = without_amount(
        make("fact_invoice_line", {}, {}, {"amount": "2500.00"}, {"invoice_id": 2}, {"invoice_id": 3}, {"invoice_id": 3}, {"invoice_id": 4, "contract_id": 999})
    )
    staged = str(tmp_path / "staged")
    done = admission.admit(store, lines, FACT_INVOICE, {"dim_contract": make("dim_contract", {}, {})}, staged)
    assert done == admission.Admission(given=7, published=2, quarantined=5)
    assert rows(store.read(FACT_INVOICE), "invoice_id", "amount") == [(1, 2500.0), (2, 2000.0)]
    assert rows(admission.quarantine(store, staged), "invoice_id", "amount", "copies", "reason") == [
        (1, 2000.0, 2, "duplicate key"),
        (3, None, 2, "missing amount"),
        (4, 2000.0, 1, "no dim_contract for contract_id contract_version"),
    ]


def test_a_load_with_too_many_refused_rows_publishes_nothing(make, store, tmp_path):
    contracts = {"dim_contract": make("dim_contract", {})}
    admission.admit(store, make("fact_invoice_line", {}), FACT_INVOICE, contracts, str(tmp_path / "one"), most_refused=0.0)
    with pytest.raises(admission.LoadRefused):
        admission.admit(store, make("fact_invoice_line", {"invoice_id": 5}, {"invoice_id": 5}), FACT_INVOICE, contracts, str(tmp_path / "two"), most_refused=0.4)
    assert rows(store.read(FACT_INVOICE), "invoice_id") == [(1,)]
    assert rows(admission.quarantine(store, str(tmp_path / "two")), "invoice_id", "copies") == [(5, 1)]


def test_an_empty_load_empties_the_table(make, store, tmp_path):
    empty = make("fact_invoice_line", {}).where("false")
    assert admission.admit(store, empty, FACT_INVOICE, {}, str(tmp_path / "none"), most_refused=0.0) == admission.Admission(0, 0, 0)
    assert store.read(FACT_INVOICE).isEmpty()


HEADER = ",".join(DIM_CONTRACT.schema.names)
GOOD = "1,1,1,2023-01-01,2024-12-31,4,20.00,100.00,Standard,0"
BAD = ["2,1,1,2023-01-01", "3,1,1,2023-01-01,2024-12-31,four,20.00,100.00,Standard,1", GOOD + ",extra", "4,1,1,not a day,2024-12-31,4,20.00,100.00,Standard,1"]


def deliver(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def test_damaged_lines_are_set_aside(spark, tmp_path):
    deliver(tmp_path / "in", "a.csv", GOOD, *BAD, GOOD.replace("1,1,1", "5,1,1").replace(",0", ",1"), "6,,,,,,,,,")
    lines = arrivals.read_lines(spark, str(tmp_path / "in"), DIM_CONTRACT)
    good, damaged = arrivals.good_lines(lines), arrivals.damaged_lines(lines)
    assert rows(good, "contract_id", "effective_start", "overage_allowed_flag") == [
        (1, "2023-01-01", False), (5, "2023-01-01", True), (6, None, None),
    ]
    assert sorted(r[0] for r in damaged.collect()) == sorted(BAD)
    assert good.count() + damaged.count() == lines.count() == 7


def test_files_are_loaded_once(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    load = lambda: arrivals.load_new_files(spark, str(folder), DIM_CONTRACT, out)
    deliver(folder, "a.csv", GOOD, BAD[0])
    for _ in range(2):
        load()
    assert arrivals.loaded(spark, out).count() == 2
    deliver(folder, "b.csv", GOOD.replace("1,1,1", "7,1,1"))
    load()
    found = arrivals.loaded(spark, out)
    assert rows(arrivals.good_lines(found), "contract_id", "effective_end") == [(1, "2024-12-31"), (7, "2024-12-31")]
    assert [r[0] for r in arrivals.damaged_lines(found).collect()] == [BAD[0]]
    assert found.schema["effective_start"].dataType.simpleString() == "date" and found.first().effective_start in (date(2023, 1, 1), None)


def test_keys_stay_whatever_comes_later(spark, tmp_path):
    pairs = lambda *given: spark.createDataFrame(given, "source_system string, natural_id long").repartition(3)
    registry = KeyRegistry(spark, str(tmp_path / "keys"))
    assert registry.register(pairs(("erp", 5), ("erp", 2), ("erp", 5), ("crm", 2), (None, 1), ("erp", None))) == 3
    first = rows(registry.keys())
    assert first == [("crm", 2, 1), ("erp", 2, 2), ("erp", 5, 3)]
    assert registry.register(pairs(("erp", 1), ("crm", 2), ("erp", 5), ("abc", 9))) == 2
    assert registry.register(pairs(("erp", 1), ("crm", 2))) == 0
    found = rows(registry.keys())
    assert set(first) < set(found) and [k for _, _, k in sorted(found, key=lambda r: r[2])] == [1, 2, 3, 4, 5]
    assert rows(registry.keyed(pairs(("abc", 9), ("new", 1)))) == [("abc", 9, 4), ("new", 1, None)]


def test_many_keys_are_numbered_by_ranges_without_gaps(spark, tmp_path):
    registry = KeyRegistry(spark, str(tmp_path / "keys"))
    ids = spark.range(0, 5000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source_system"), (F.col("id") * 7 % 5000).alias("natural_id"))
    registry.register(ids.where("natural_id % 2 = 0"))
    registry.register(ids)
    keys = registry.keys()
    assert keys.agg(F.count("*"), F.count_distinct("key"), F.min("key"), F.max("key")).first() == (5000, 5000, 1, 5000)
    assert keys.where("natural_id % 2 = 0").agg(F.max("key")).first()[0] == 2500


def cost_rows(spark, *given):
    return spark.createDataFrame(
        [(date.fromisoformat(m), site, date.fromisoformat(known), Decimal(cost)) for m, site, known, cost in given],
        "cost_month date, site_id int, known_from date, total_power_cost decimal(20,2)",
    )


def close(spark, *given):
    return spark.createDataFrame([(date.fromisoformat(m), date.fromisoformat(day)) for m, day in given], "cost_month date, close_on date")


def test_cost_as_known_at_a_close(spark):
    known = cost_rows(
        spark, ("2023-01-01", 1, "2023-01-20", "100.00"), ("2023-01-01", 1, "2023-02-10", "130.00"), ("2023-01-01", 2, "2023-02-05", "50.00"), ("2023-02-01", 1, "2023-03-20", "9.00")
    )
    at = close(spark, ("2023-01-01", "2023-02-04"), ("2023-01-01", "2023-02-05"), ("2023-01-01", "2023-02-28"), ("2023-02-01", "2023-03-19"))
    assert rows(allocation.cost_as_of(known, at)) == [
        ("2023-01-01", "2023-02-04", 100.0), ("2023-01-01", "2023-02-05", 150.0), ("2023-01-01", "2023-02-28", 180.0),
    ]


def test_journal_adds_up_to_what_is_known_last(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "store"), prefix=f"j{abs(hash(tmp_path)) % 10**9}_")
    store.create([USAGE_MONTHLY, COST_JOURNAL])
    use = lambda *given: spark.createDataFrame(
        [(c, 1, date(2023, 1, 1), Decimal(kw), None, None, 0, 0) for c, kw in given], store.read(USAGE_MONTHLY).schema
    )
    known = cost_rows(spark, ("2023-01-01", 1, "2023-01-20", "100.00"), ("2023-01-01", 1, "2023-02-10", "130.00"))
    snapshot = lambda day: allocation.cost_as_of(known, close(spark, ("2023-01-01", day)))
    store.overwrite(use((1, "30.00"), (2, "10.00"), (3, "0.00")), USAGE_MONTHLY)
    for day in ("2023-02-01", "2023-02-01", "2023-02-20", "2023-03-01"):
        warehouse.book_close(store, snapshot(day))
    entries = [(1, "2023-02-01", 75.0), (1, "2023-02-20", 22.5), (2, "2023-02-01", 25.0), (2, "2023-02-20", 7.5), (3, "2023-02-01", 0.0)]
    assert rows(store.read(COST_JOURNAL), "contract_id", "close_on", "booked") == entries
    # A contract-month that lost its readings is booked back, and the other takes its share.
    store.overwrite(use((1, "30.00"), (3, "0.00")), USAGE_MONTHLY)
    warehouse.book_close(store, snapshot("2023-04-01"))
    total = store.read(COST_JOURNAL).groupBy("contract_id").agg(F.sum("booked").alias("booked"))
    assert rows(total) == [(1, 130.0), (2, 0.0), (3, 0.0)]
    store.drop()


def test_signed_months_stay_and_changes_are_reported(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "store"), prefix=f"s{abs(hash(tmp_path)) % 10**9}_")
    store.create([SIGNOFF_LOCK])
    mart = lambda *given: spark.createDataFrame(
        [(c, 1, date(2023, 1, 1), Decimal(kw), Decimal("5.00"), margin and Decimal(margin)) for c, kw, margin in given], store.read(SIGNOFF_LOCK).schema
    )
    first = mart((1, "10.00", "3.00"), (2, "20.00", "4.00"), (3, "1.00", None))
    for signed in (first, mart((1, "11.00", "3.00"), (4, "1.00", "1.00"))):
        warehouse.sign_off(store, signed)
    lock = store.read(SIGNOFF_LOCK)
    assert rows(lock, "contract_id", "total_kw") == [(1, 10.0), (2, 20.0), (3, 1.0), (4, 1.0)]
    rebuilt = mart((1, "10.00", "3.00"), (2, "20.00", "2.50"), (3, "1.00", None))
    assert rows(exceptions.lock_conflicts(lock, rebuilt), "contract_id", "rebuilt_gross_margin", "gross_margin_change") == [(2, 2.5, -1.5), (4, None, -1.0)]
    assert exceptions.lock_conflicts(lock.where("contract_id < 4"), first).isEmpty()
    store.drop()
