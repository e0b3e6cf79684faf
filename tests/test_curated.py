from datetime import date, timedelta

from conftest import rows

from pyspark.sql import functions as F

from wattledger.functions.expressions import surrogate_key
from wattledger.operators import calendar, dedupe, monthly, windows

TWO_VERSIONS = (
    {"effective_end": "2023-03-31"},
    {"contract_version": 2, "effective_start": "2023-04-01", "power_commit_kw": "22.00", "price_per_kw": "110.00"},
)


def test_later_arrival_wins(make):
    meter = make(
        "fact_meter_power_daily",
        {"used_kw": "1.00", "ingested_at": "2023-01-10 06:00:00"},
        {"used_kw": "2.00", "ingested_at": "2023-01-12 06:00:00"},
        {"used_kw": "9.00", "ingested_at": "2023-01-11 06:00:00"},
        {"reading_date": "2023-01-11", "used_kw": None},
    )
    assert rows(dedupe.latest_readings(meter), "reading_date", "used_kw") == [("2023-01-10", 2.0), ("2023-01-11", None)]


def test_copies_under_another_version_are_still_copies(make):
    meter = make(
        "fact_meter_power_daily",
        {"contract_version": 2, "ingested_at": "2023-01-10 05:00:00"},
        {"contract_version": 1, "ingested_at": "2023-01-10 06:00:00"},
    )
    assert rows(dedupe.latest_readings(meter), "contract_version") == [(1,)]


def test_winner_of_a_tie_does_not_depend_on_partitioning(make):
    meter = make("fact_meter_power_daily", *[{"used_kw": f"{n}.00"} for n in range(1, 40)])
    winners = {rows(dedupe.latest_readings(meter.repartition(n)), "used_kw")[0] for n in (1, 3, 7)}
    assert winners == {(39.0,)}


def test_window_ends_are_inclusive_and_rejects_are_the_complement(make):
    contracts = make("dim_contract", *TWO_VERSIONS)
    meter = make(
        "fact_meter_power_daily",
        {"reading_date": "2023-01-01"},
        {"reading_date": "2023-03-31"},
        {"reading_date": "2023-04-01"},
        {"reading_date": "2023-04-02", "contract_version": 2},
        {"reading_date": "2023-02-01", "contract_version": 2},
        {"reading_date": "2023-02-02", "contract_version": 3},
        {"reading_date": "2023-02-03", "contract_id": 999},
    )
    kept = windows.effective_meter(meter, contracts)
    rejected = windows.rejected_readings(meter, contracts)
    assert [r[0] for r in rows(kept, "reading_date")] == ["2023-01-01", "2023-03-31", "2023-04-02"]
    assert rows(rejected, "reading_date", "reject_reason") == [
        ("2023-02-01", windows.OUTSIDE_WINDOW),
        ("2023-02-02", windows.UNKNOWN_VERSION),
        ("2023-02-03", windows.UNKNOWN_VERSION),
        ("2023-04-01", windows.OUTSIDE_WINDOW),
    ]
    assert rows(kept.unionByName(rejected.drop("reject_reason"))) == rows(meter)


def test_reattribution_finds_the_version_in_force(make):
    contracts = make("dim_contract", *TWO_VERSIONS)
    meter = make(
        "fact_meter_power_daily",
        {"reading_date": "2023-02-01", "contract_version": 2},
        {"reading_date": "2023-05-01", "contract_version": 2},
        {"reading_date": "2022-05-01"},
    )
    out = windows.reattributed_readings(meter, contracts)
    assert rows(out, "reading_date", "stated_version", "in_force_version", "reattributed") == [
        ("2022-05-01", 1, None, True),
        ("2023-02-01", 2, 1, True),
        ("2023-05-01", 2, 2, False),
    ]


def test_version_windows_report_gap_overlap_and_contiguity(make):
    contracts = make(
        "dim_contract",
        {"contract_id": 1, "effective_end": "2023-03-31"},
        {"contract_id": 1, "contract_version": 2, "effective_start": "2023-04-01", "effective_end": "2023-06-30"},
        {"contract_id": 1, "contract_version": 3, "effective_start": "2023-07-03"},
        {"contract_id": 2, "effective_end": "2023-03-31"},
        {"contract_id": 2, "contract_version": 2, "effective_start": "2023-03-31"},
    )
    assert rows(windows.version_windows(contracts), "contract_id", "contract_version", "gap_days", "window_status") == [
        (1, 1, 0, "contiguous"),
        (1, 2, 2, "gap"),
        (1, 3, None, "last"),
        (2, 1, -1, "overlap"),
        (2, 2, None, "last"),
    ]


def test_version_windows_compare_with_all_that_still_run(make):
    """The first version outlasts the next two: no gap between them, and the third overlaps with the first."""
    spans = [("2020-01-01", "2025-12-31"), ("2020-02-01", "2020-02-28"), ("2020-03-01", "2020-12-31"), ("2026-01-05", "2026-12-31")]
    versions = [{"contract_version": v, "effective_start": a, "effective_end": b} for v, (a, b) in enumerate(spans, 1)]
    versions += [{"contract_id": 9, "contract_version": v, "effective_start": a, "effective_end": "2024-01-31"} for v, a in ((2, "2024-01-01"), (1, "2024-01-01"))]
    found = windows.version_windows(make("dim_contract", *versions))
    assert rows(found, "contract_id", "contract_version", "covered_until", "gap_days", "window_status") == [
        (101, 1, "2025-12-31", -2161, "overlap"),
        (101, 2, "2025-12-31", -2132, "overlap"),
        (101, 3, "2025-12-31", 4, "gap"),
        (101, 4, "2026-12-31", None, "last"),
        (9, 1, "2024-01-31", -31, "overlap"),
        (9, 2, "2024-01-31", None, "last"),
    ]


def test_usage_counts_a_null_reading_as_a_day_but_not_as_kw(make):
    meter = make(
        "fact_meter_power_daily",
        {"used_kw": "10.00"},
        {"reading_date": "2023-01-11", "used_kw": "5.01", "reading_status": "late"},
        {"reading_date": "2023-01-31", "used_kw": None, "reading_status": "estimated"},
        {"reading_date": "2023-02-01", "used_kw": "7.00"},
    )
    assert rows(monthly.usage_monthly(meter)) == [
        (101, 1, "2023-01-01", 15.01, 7.51, 10.0, 1, 1),
        (101, 1, "2023-02-01", 7.0, 7.0, 7.0, 0, 0),
    ]


def test_average_of_an_exact_half_cent_rounds_up(make):
    """1890.07 over 26 days is 72.695 exactly; as a double it lies just below."""
    days = [{"reading_date": f"2023-01-{d:02d}", "used_kw": "72.70"} for d in range(1, 26)]
    meter = make("fact_meter_power_daily", *days, {"reading_date": "2023-01-26", "used_kw": "72.57"})
    assert rows(monthly.usage_monthly(meter), "total_kw", "avg_daily_kw") == [(1890.07, 72.7)]


def test_late_and_estimated_share(make):
    meter = make(
        "fact_meter_power_daily",
        {"used_kw": "6.00"},
        {"reading_date": "2023-01-11", "used_kw": "3.00", "reading_status": "late"},
        {"reading_date": "2023-01-12", "used_kw": "1.00", "reading_status": "estimated"},
        {"reading_date": "2023-02-01", "used_kw": "0.00"},
    )
    out = monthly.usage_quality_monthly(meter)
    assert rows(out, "usage_month", "late_share", "estimated_share") == [
        ("2023-01-01", 0.3, 0.1),
        ("2023-02-01", None, None),
    ]


def test_erp_total_is_the_sum_of_its_kinds_and_credits_stay_negative(make):
    lines = make(
        "fact_invoice_line",
        {"amount": "100.00"},
        {"invoice_line_id": 2, "revenue_type": "credit", "amount": "-30.50"},
        {"invoice_line_id": 3, "revenue_type": "overage", "amount": "7.25"},
    )
    assert rows(monthly.erp_revenue_monthly(lines)) == [(101, 1, "2023-01-01", 76.75, 100.0, 7.25, -30.5)]


def test_two_sites_become_one_cost_row(make):
    cost = make(
        "fact_power_cost_monthly",
        {"total_power_cost": "100.00"},
        {"site_id": 2, "total_power_cost": "50.50", "true_up_flag": True},
    )
    assert rows(monthly.power_cost_monthly(cost)) == [("2023-01-01", 150.5, True)]


def test_missing_days_at_both_ends_between_and_without_any_reading(make):
    contracts = make(
        "dim_contract",
        {"effective_start": "2024-02-26", "effective_end": "2024-03-02"},
        {"contract_id": 102, "effective_start": "2024-02-28", "effective_end": "2024-03-01"},
        {"contract_id": 103, "effective_start": "2024-02-28", "effective_end": "2024-02-28"},
    )
    meter = make(
        "fact_meter_power_daily",
        {"reading_date": "2024-02-27"},
        {"reading_date": "2024-03-01"},
        {"contract_id": 103, "reading_date": "2024-02-28"},
    )
    assert rows(calendar.missing_readings(meter, contracts), "contract_id", "reading_date") == [
        (101, "2024-02-26"),
        (101, "2024-02-28"),
        (101, "2024-02-29"),
        (101, "2024-03-02"),
        (102, "2024-02-28"),
        (102, "2024-02-29"),
        (102, "2024-03-01"),
    ]


def test_lateness_is_judged_by_arrival(make):
    contracts = make("dim_contract", {"effective_start": "2023-01-01", "effective_end": "2023-01-05"})
    meter = make(
        "fact_meter_power_daily",
        {"reading_date": "2023-01-01", "ingested_at": "2023-01-01 23:59:59"},
        {"reading_date": "2023-01-02", "ingested_at": "2023-01-03 00:00:00"},
        {"reading_date": "2023-01-03", "ingested_at": "2023-01-10 00:00:00"},
        {"reading_date": "2023-01-04", "ingested_at": "2023-01-12 00:00:00"},
    )
    out = calendar.lateness_classes(meter, contracts)
    assert rows(out, "reading_date", "lateness_class") == [
        ("2023-01-01", "on_time"),
        ("2023-01-02", "late"),
        ("2023-01-03", "late"),
        ("2023-01-04", "estimated"),
        ("2023-01-05", "estimated"),
    ]


def test_backfill_replaces_only_what_arrived_later(make):
    existing = make(
        "fact_meter_power_daily",
        {"used_kw": "1.00", "ingested_at": "2023-01-10 06:00:00"},
        {"reading_date": "2023-01-11", "used_kw": "2.00", "ingested_at": "2023-01-15 06:00:00"},
    )
    late = make(
        "fact_meter_power_daily",
        {"used_kw": "5.00", "ingested_at": "2023-01-13 06:00:00"},
        {"reading_date": "2023-01-11", "used_kw": "6.00", "ingested_at": "2023-01-14 06:00:00"},
        {"reading_date": "2023-01-12", "used_kw": "7.00", "ingested_at": "2023-01-14 06:00:00"},
    )
    stamp = F.lit("2023-01-20 00:00:00")
    once = dedupe.backfill_merge(existing, late, stamp)
    expected = [("2023-01-10", 5.0, True), ("2023-01-11", 2.0, False), ("2023-01-12", 7.0, True)]
    seen = once.select("reading_date", "used_kw", F.col("reprocessed_at").isNotNull().alias("redone"))
    assert rows(seen) == expected
    again = dedupe.backfill_merge(once.drop("reprocessed_at"), late, stamp)
    assert rows(again, "reading_date", "used_kw") == [e[:2] for e in expected]


def test_overlapping_windows_give_every_reading_one_version(make):
    contracts = make(
        "dim_contract",
        {"effective_end": "2023-12-31"},
        {"contract_version": 2, "effective_start": "2023-06-01", "effective_end": "2023-12-31"},
        {"contract_version": 3, "effective_start": "2023-03-01", "effective_end": "2023-09-30"},
    )
    meter = make("fact_meter_power_daily", *[{"reading_date": f"2023-{m:02d}-10"} for m in (1, 4, 7, 11)])
    out = windows.reattributed_readings(meter, contracts)
    assert rows(out, "reading_date", "in_force_version") == [
        ("2023-01-10", 1), ("2023-04-10", 3), ("2023-07-10", 3), ("2023-11-10", None),
    ]


def test_surrogate_keys_are_unique_and_stable(make):
    contracts = make("dim_contract", {"contract_id": 1, "contract_version": 11}, {"contract_id": 11})
    first = rows(dedupe.with_surrogate_keys(contracts, F.lit("erp")))
    assert first == rows(dedupe.with_surrogate_keys(contracts.repartition(3), F.lit("erp")))
    assert len({r[0] for r in first}) == 2


def test_source_systems_with_equal_ids_get_keys_of_their_own(spark, make):
    contracts = make("dim_contract", {}, {"contract_id": 102})
    both = dedupe.with_surrogate_keys(contracts.withColumn("s", F.explode(F.array(F.lit("erp"), F.lit("crm")))), F.col("s"))
    assert both.select("contract_key").distinct().count() == 4 and both.select("customer_key").distinct().count() == 2
    facts = make("fact_invoice_line", {}, {"contract_id": 103}).withColumn("source_system", F.lit("crm"))
    keyed = rows(dedupe.keyed_facts(facts, both), "contract_id", "contract_key")
    assert keyed == [(101, rows(both.where("source_system = 'crm' AND contract_id = 101"), "contract_key")[0][0]), (103, None)]
    odd = spark.createDataFrame(
        [("a", None, "5"), ("a", "5", None), ("a", "", "5"), ("a", "1:5", "x"), ("a", "1", "5;1:x"), ("a|b", "c", "d"), ("a", "b|c", "d"), ("a", "null", "5")],
        "source string, x string, y string",
    )
    key = surrogate_key(F.col("source"), F.col("x"), F.col("y"))
    assert odd.select(key.alias("k")).distinct().count() == odd.count()


def test_active_months_and_mrr_without_proration(make):
    contracts = make("dim_contract", {"effective_start": "2023-11-15", "effective_end": "2024-01-01"})
    assert rows(calendar.contract_mrr(contracts), "month", "contract_mrr") == [
        ("2023-11-01", 2000.0),
        ("2023-12-01", 2000.0),
        ("2024-01-01", 2000.0),
    ]


def test_amendments_list_changed_terms(make):
    contracts = make("dim_contract", *TWO_VERSIONS, {"contract_id": 102})
    assert rows(windows.amendments(contracts)) == [(101, 2, 1, "2023-04-01", 0, 2.0, 10.0)]


def test_eight_contracts_over_two_years(spark, make):
    """Amendments on month starts leave the calendar whole: 8 x 731 days and 8 x 24 months."""
    amended = {101: "2024-03-01", 102: "2024-10-01", 104: "2024-09-01"}
    versions = []
    for contract in range(101, 109):
        start = amended.get(contract)
        first = {"contract_id": contract}
        if start:
            versions.append({**first, "contract_version": 2, "effective_start": start})
            first["effective_end"] = (date.fromisoformat(start) - timedelta(days=1)).isoformat()
        versions.append(first)
    contracts = make("dim_contract", *versions)
    none = make("fact_meter_power_daily", {}).limit(0)
    assert calendar.missing_readings(none, contracts).count() == 5848
    assert calendar.active_contract_months(contracts).count() == 192
    assert {r[0] for r in rows(windows.version_windows(contracts), "window_status")} == {"contiguous", "last"}
