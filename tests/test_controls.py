import pytest
from conftest import rows
from test_mart import tables

from pyspark.sql import functions as F

from wattledger.functions import expressions as e
from wattledger.operators import calendar, exceptions, integrity, leakage, monthly, reconciliation
from wattledger.plans.frames import Frames
from wattledger.schemas import FOREIGN_KEYS


@pytest.mark.parametrize(
    "expected, actual, status",
    [
        (100, 101, "Green"), (100, 99, "Green"), (100, 101.01, "Yellow"), (100, 95, "Yellow"),
        (100, 94.99, "Red"), (0, 1, "Red"), (0, 0, "Green"), (-100, -101, "Green"), (-100, -110, "Red"),
    ],
)
def test_control_status(spark, expected, actual, status):
    df = spark.createDataFrame([(float(expected), float(actual))], "expected double, actual double")
    assert df.select(e.control_status(F.col("expected"), F.col("actual"))).collect()[0][0] == status


def test_month_known_to_one_side_only_is_red(make):
    f = Frames(tables(make, invoices=({"invoice_month": "2023-02-01"},)))
    out = reconciliation.recon_erp_vs_mart_monthly(f.tables.invoices, f.mart)
    assert rows(out, "month", "variance_amount", "variance_pct", "variance_bucket", "control_status") == [
        ("2023-01-01", 0.0, None, "No Flag", "Red"),
        ("2023-02-01", -2000.0, -100.0, "No Flag", "Red"),
    ]


def test_recon_agrees_when_everything_reaches_the_mart(make):
    f = Frames(tables(make, meter=({"reading_status": "late"},)))
    stamp = F.lit("2023-02-01").cast("timestamp")
    out = reconciliation.recon_erp_vs_mart_monthly(f.tables.invoices, f.mart, stamp)
    assert reconciliation.controls_data_integrity(out).columns == out.columns
    assert rows(out.drop("last_reconciled_at")) == [
        ("2023-01-01", 2000.0, 2000.0, 0.0, 0.0, "Late Meter Data", "Green")
    ]


def flagged(make):
    """A row per mix of flags: late, estimated and true-up; estimated and true-up; true-up; nothing."""
    meter = (
        {"reading_status": "late"},
        {"reading_date": "2023-01-11", "reading_status": "estimated"},
        {"contract_id": 102, "reading_status": "estimated"},
        {"contract_id": 103},
        {"contract_id": 103, "reading_date": "2023-02-01"},
    )
    return Frames(
        tables(
            make,
            meter=meter,
            contracts=[{"contract_id": c} for c in (101, 102, 103)],
            cost=({"true_up_flag": True}, {"cost_month": "2023-02-01"}),
        )
    ).mart


def test_reason_ladder_and_counts(make):
    m = flagged(make)
    assert rows(exceptions.contract_exception_reason(m), "month", "contract_id", "exception_reason") == [
        ("2023-01-01", 101, "Late Meter Data"),
        ("2023-01-01", 102, "Estimated Usage"),
        ("2023-01-01", 103, "Power Cost True-Up"),
        ("2023-02-01", 103, "No Flag"),
    ]
    assert rows(exceptions.exception_counts(m))[0] == ("2023-01-01", "Estimated Usage", 1)
    assert rows(exceptions.controls_summary(m)) == [
        ("2023-01-01", 3, 1, 2, 3, 2),
        ("2023-02-01", 1, 0, 0, 0, 1),
    ]


def test_exceptions_are_the_rows_with_a_reason(make):
    m = flagged(make)
    reasons = exceptions.contract_exception_reason(m).where("exception_reason <> 'No Flag'")
    keys = ("month", "contract_id", "contract_version")
    assert rows(exceptions.exceptions_only(m), *keys) == rows(reasons, *keys)


def test_variance_view_keeps_both_true_up_columns(make):
    out = exceptions.contract_variance_monthly(flagged(make)).where("contract_id = 101")
    assert rows(out, "late_flag", "estimated_flag", "true_up_flag", "true_up_flag2") == [(1, 1, True, 1)]


def test_signoff_needs_a_reading_in_time_for_every_day(make):
    """Contract 101 has all of January; 102 misses a day, 103 has one late beyond the window, 104 one estimated."""
    days = [f"2023-01-{d:02d}" for d in range(1, 32)]
    readings = [
        {"contract_id": c, "reading_date": d, "ingested_at": f"{d} 06:00:00"}
        for c in (101, 102, 103, 104) for d in days if not (c == 102 and d == days[4])
    ]
    for r in readings:
        if r["contract_id"] == 103 and r["reading_date"] == days[9]:
            r["ingested_at"] = "2023-01-18 06:00:00"
        if r["contract_id"] == 104 and r["reading_date"] == days[9]:
            r["reading_status"] = "estimated"
        if r["contract_id"] == 101 and r["reading_date"] == days[9]:
            r["ingested_at"] = "2023-01-17 06:00:00"
    contracts = [{"contract_id": c, "effective_end": "2023-01-31"} for c in (101, 102, 103, 104)]
    f = Frames(tables(make, meter=readings, contracts=contracts))
    assert rows(exceptions.signoff_set(f.mart, f.lateness), "contract_id", "month") == [(101, "2023-01-01")]
    open_days = exceptions.open_days(f.lateness).where("missing_days + overdue_days > 0")
    assert rows(open_days, "contract_id", "missing_days", "overdue_days") == [(102, 1, 0), (103, 0, 1)]
    shares = exceptions.signoff_share(f.mart, f.lateness)
    assert rows(shares, "month", "contract_rows", "signed_rows", "signed_kw") == [("2023-01-01", 4, 1, 310.0)]


def test_top_rows_are_latest_first(make):
    m = flagged(make)
    top = exceptions.recent_contracts(m, 2).collect()
    assert [(r.month.isoformat(), r.contract_id) for r in top] == [("2023-02-01", 103), ("2023-01-01", 101)]
    assert [r.month.isoformat() for r in exceptions.latest_months(exceptions.controls_summary(m), 1).collect()] == ["2023-02-01"]


def test_negative_margin_and_null_risk(make):
    m = flagged(make)
    assert {r[0] for r in rows(exceptions.negative_margin(m), "contract_id")} == {102, 103}
    assert rows(integrity.null_risk(m)) == [(0, 0)]


def test_mrr_against_invoices(make):
    contracts = make(
        "dim_contract",
        {"effective_start": "2023-01-01", "effective_end": "2023-02-28"},
        {"contract_id": 102, "effective_start": "2023-01-01", "effective_end": "2023-01-31"},
    )
    lines = make(
        "fact_invoice_line",
        {"amount": "2000.00"},
        {"invoice_month": "2023-02-01", "amount": "1950.00"},
        {"contract_id": 103, "amount": "5.00"},
    )
    out = reconciliation.mrr_vs_invoiced(calendar.contract_mrr(contracts), monthly.erp_revenue_monthly(lines))
    assert rows(out, "contract_id", "month", "mrr_difference", "control_status") == [
        (101, "2023-01-01", 0.0, "Green"),
        (101, "2023-02-01", -50.0, "Yellow"),
        (102, "2023-01-01", -2000.0, "Red"),
        (103, "2023-01-01", 5.0, "Red"),
    ]


def test_root_causes_in_order(make):
    usage = monthly.usage_monthly(
        make(
            "fact_meter_power_daily",
            {"reading_status": "late"},
            {"contract_id": 102},
            {"contract_id": 103, "reading_status": "late"},
        )
    )
    contracts = make("dim_contract", *[{"contract_id": c} for c in (101, 102, 103, 104)])
    lines = make(
        "fact_invoice_line",
        {"contract_id": 101},
        {"contract_id": 102},
        {"contract_id": 103, "posting_date": "2023-02-03"},
        {"contract_id": 104},
        {"contract_id": 105},
    )
    out = reconciliation.variance_root_cause(lines, contracts, usage)
    assert rows(out, "contract_id", "root_cause") == [
        (101, "late data"), (102, "none"), (103, "timing"), (104, "missing data"), (105, "mapping"),
    ]


def test_lost_revenue_is_what_mapping_and_missing_data_explain(spark):
    """ERP total less mart total equals the revenue of groups without contract or usage."""
    f = Frames.from_dir(spark, "/root/testdata/sf0.001")
    causes = reconciliation.variance_root_cause(f.tables.invoices, f.tables.contracts, f.usage)
    lost = causes.where(F.col("root_cause").isin("mapping", "missing data")).agg(F.sum("erp_revenue_total"))
    gap = f.recon.agg(F.sum("erp_revenue_total") - F.sum("mart_revenue_total"))
    assert lost.collect()[0][0] == gap.collect()[0][0] != 0


def test_unbilled_spike_needs_permission_and_no_overage(make):
    contracts = [{"contract_id": 101}, {"contract_id": 102, "overage_allowed_flag": False}, {"contract_id": 103}]
    t = tables(
        make,
        meter=[{"contract_id": c, "used_kw": "20.01"} for c in (101, 102, 103)],
        contracts=contracts,
        invoices=({"contract_id": 103, "revenue_type": "overage", "amount": "9.00"},),
    )
    assert rows(leakage.unbilled_spikes(Frames(t).usage, Frames(t).erp_revenue, t.contracts), "contract_id", "kw_over_commit") == [(101, 0.01)]


def test_billing_under_a_version_no_longer_in_force(make):
    contracts = make(
        "dim_contract",
        {"effective_end": "2023-03-31"},
        {"contract_version": 2, "effective_start": "2023-04-01"},
    )
    lines = make(
        "fact_invoice_line",
        {},
        {"invoice_id": 2, "invoice_month": "2023-04-01"},
        {"invoice_id": 3, "invoice_month": "2023-04-01", "contract_version": 2},
        {"invoice_id": 4, "invoice_month": "2022-04-01"},
    )
    out = leakage.stale_version_billing(lines, contracts)
    assert rows(out, "invoice_id", "billed_version", "in_force_version", "stale_reason") == [
        (2, 1, 2, leakage.OTHER_VERSION),
        (4, 1, None, leakage.NO_VERSION),
    ]


def test_both_versions_may_be_billed_in_the_month_of_an_amendment(make):
    contracts = make(
        "dim_contract",
        {"effective_end": "2023-04-14"},
        {"contract_version": 2, "effective_start": "2023-04-15"},
    )
    lines = make(
        "fact_invoice_line",
        {"invoice_month": "2023-04-01"},
        {"invoice_id": 2, "invoice_month": "2023-04-01", "contract_version": 2},
        {"invoice_id": 3, "invoice_month": "2023-05-01"},
        {"invoice_id": 4, "invoice_month": "2023-03-01", "contract_version": 2},
    )
    out = leakage.stale_version_billing(lines, contracts)
    assert rows(out, "invoice_id", "billed_version", "in_force_version") == [(3, 1, 2), (4, 2, 1)]


def test_overage_without_permission(make):
    contracts = make("dim_contract", {}, {"contract_id": 102, "overage_allowed_flag": False})
    lines = make(
        "fact_invoice_line",
        {"revenue_type": "overage"},
        {"invoice_id": 2, "contract_id": 102, "revenue_type": "overage"},
        {"invoice_id": 3, "contract_id": 102},
    )
    assert rows(leakage.disallowed_overage(lines, contracts), "invoice_id") == [(2,)]


def test_declared_constraints(make):
    tabs = {
        "dim_customer": make("dim_customer", {}),
        "dim_contract": make("dim_contract", {}, {"contract_id": 102, "customer_id": 9}, {"contract_id": 102, "customer_id": 9}),
        "fact_invoice_line": make("fact_invoice_line", {}, {}, {"invoice_id": 2, "contract_id": 7}),
    }
    assert rows(integrity.primary_key_violations(tabs)) == [("dim_contract", "102|1", 2), ("fact_invoice_line", "1|1", 2)]
    keys = [k for k in FOREIGN_KEYS if k.child in tabs]
    assert rows(integrity.foreign_key_violations(tabs, keys)) == [
        ("dim_contract", "dim_customer", "9", 2),
        ("fact_invoice_line", "dim_contract", "7|1", 1),
    ]


def test_null_counts_cover_every_required_column(spark, make):
    loose = spark.createDataFrame([(1, None), (None, None)], "customer_id int, customer_name string")
    loose = loose.withColumn("start_date", F.current_date())
    assert rows(integrity.not_null_violations({"dim_customer": loose})) == [
        ("dim_customer", "customer_id", 1, 2),
        ("dim_customer", "customer_name", 2, 2),
        ("dim_customer", "start_date", 0, 2),
    ]


def test_row_counts_by_layer(make):
    assert rows(integrity.layer_row_counts({"a": make("dim_contract", {}, {}), "b": make("dim_customer", {})})) == [
        ("a", 2), ("b", 1),
    ]


def test_small_expressions(spark):
    row = spark.range(1).select(
        e.customer_label(F.lit(7)).alias("label"),
        e.clamp(F.lit(12), F.lit(0), F.lit(10)).alias("clamped"),
        e.month_end(F.lit("2024-02-10").cast("date")).alias("month_end"),
        e.day_sequence(F.lit("2024-02-28").cast("date"), F.lit("2024-03-01").cast("date")).alias("days"),
        e.day_sequence(F.lit("2024-03-02").cast("date"), F.lit("2024-03-01").cast("date")).alias("none"),
        e.month_sequence(F.lit("2023-12-31").cast("date"), F.lit("2024-01-01").cast("date")).alias("months"),
        e.ratio(F.lit(1), F.lit(0)).alias("ratio"),
    ).collect()[0]
    assert (row.label, row.clamped, row.month_end.isoformat(), row.ratio) == ("Customer_07", 10, "2024-02-29", None)
    assert [d.isoformat() for d in row.days] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert row.none == [] and [d.isoformat() for d in row.months] == ["2023-12-01", "2024-01-01"]
