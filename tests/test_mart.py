from conftest import rows

from pyspark.sql import functions as F

from wattledger.operators import allocation, mart, monthly
from wattledger.plans.frames import Frames
from wattledger.sources.driver_tables import SourceTables


def tables(make, meter=({},), contracts=({},), racks=({},), invoices=({},), cost=({},)):
    return SourceTables(
        customers=make("dim_customer", {}),
        contracts=make("dim_contract", *contracts),
        meter=make("fact_meter_power_daily", *meter),
        racks=make("fact_rack_utilization_daily", *racks),
        invoices=make("fact_invoice_line", *invoices),
        power_cost=make("fact_power_cost_monthly", *cost),
    )


PAIR = ({"contract_id": 101}, {"contract_id": 102})


def test_cost_follows_usage_share(make):
    t = tables(make, meter=({"used_kw": "30.00"}, {"contract_id": 102, "used_kw": "10.00"}), contracts=PAIR)
    out = Frames(t).mart
    assert rows(out, "contract_id", "allocated_power_cost", "erp_revenue_total", "gross_margin") == [
        (101, 375.0, 2000.0, 1625.0),
        (102, 125.0, 0.0, -125.0),
    ]


def test_mart_has_the_declared_columns_and_types(make):
    from wattledger.schemas import MART

    assert Frames(tables(make)).mart.dtypes == [(f.name, f.dataType.simpleString()) for f in MART.schema.fields]


def test_month_of_zero_usage_costs_nothing(make):
    assert rows(Frames(tables(make, meter=({"used_kw": "0.00"},))).mart, "total_kw", "allocated_power_cost") == [(0, 0)]


def test_month_of_unknown_usage_keeps_its_row_with_zero_cost(make):
    out = Frames(tables(make, meter=({"used_kw": None},))).mart
    assert rows(out, "total_kw", "allocated_power_cost", "gross_margin") == [(None, 0.0, 2000.0)]


def test_month_without_cost_is_dropped_from_allocation_but_not_from_the_mart(make):
    f = Frames(tables(make, cost=({"cost_month": "2023-02-01", "true_up_flag": True},)))
    assert rows(f.allocated_cost) == []
    assert rows(f.mart, "month", "allocated_power_cost", "true_up_flag") == [("2023-01-01", 0.0, False)]


def test_usage_without_racks_keeps_null_rack_columns(make):
    out = Frames(tables(make, racks=({"usage_date": "2023-02-10"},))).mart
    assert rows(out, "avg_racks_used", "max_racks_used") == [(None, None)]


def test_invoice_without_usage_stays_out(make):
    out = Frames(tables(make, invoices=({"invoice_month": "2023-02-01"},))).mart
    assert rows(out, "month", "erp_revenue_total", "gross_margin") == [("2023-01-01", 0.0, -500.0)]


def test_true_up_reaches_every_contract_of_the_month(make):
    t = tables(make, meter=({}, {"contract_id": 102}), contracts=PAIR, cost=({"true_up_flag": True},))
    assert rows(Frames(t).mart, "contract_id", "true_up_flag") == [(101, True), (102, True)]


def test_second_site_adds_cost_but_no_rows(make):
    out = Frames(tables(make, cost=({}, {"site_id": 2, "total_power_cost": "100.00"}))).mart
    assert rows(out, "allocated_power_cost") == [(600.0,)]


def test_allocated_cents_stay_within_rounding_of_the_cost(make):
    meter = [{"contract_id": c, "used_kw": f"{c}.37"} for c in range(1, 8)]
    t = tables(make, meter=meter, contracts=[{"contract_id": c} for c in range(1, 8)])
    total = sum(r[0] for r in rows(Frames(t).mart, "allocated_power_cost"))
    assert abs(total - 500) <= 0.01 * 7


def test_allocated_half_cent_rounds_up(make):
    """7 and 193 of 200 kW at 1.00 are exactly 0.035 and 0.965."""
    meter = ({"used_kw": "7.00"}, {"contract_id": 102, "used_kw": "193.00"})
    t = tables(make, meter=meter, contracts=PAIR, cost=({"total_power_cost": "1.00"},))
    assert rows(Frames(t).mart, "contract_id", "allocated_power_cost") == [(101, 0.04), (102, 0.97)]


def test_allocation_of_site_totals_beyond_declared_digits(spark, make):
    usage = monthly.usage_monthly(make("fact_meter_power_daily", {}, {"contract_id": 102}))
    out = usage.withColumns(
        {
            "total_power_cost": F.lit("300000000000000.00").cast("decimal(20,2)"),
            "total_site_kw": F.lit("1000000000000000.00").cast("decimal(22,2)"),
        }
    )
    out = out.select(allocation.allocated("total_kw", "total_site_kw", "total_power_cost").alias("share"))
    assert rows(out) == [(3.0,), (3.0,)]


def test_true_up_moves_only_what_changed(make):
    usage = monthly.usage_monthly(make("fact_meter_power_daily", {"used_kw": "3.00"}, {"contract_id": 102, "used_kw": "1.00"}))
    estimate = make("fact_power_cost_monthly", {"total_power_cost": "400.00"})
    actual = make("fact_power_cost_monthly", {"total_power_cost": "480.00"})
    out = allocation.true_up_delta(usage, estimate, actual)
    assert rows(out, "contract_id", "estimated_allocation", "actual_allocation", "true_up_amount") == [
        (101, 300.0, 360.0, 60.0),
        (102, 100.0, 120.0, 20.0),
    ]
    nothing_yet = make("fact_power_cost_monthly", {"cost_month": "2022-01-01"})
    assert rows(allocation.true_up_delta(usage, nothing_yet, actual), "true_up_amount") == [(120.0,), (360.0,)]


def test_customer_rollup_adds_contracts_and_versions(make):
    t = tables(make, meter=({}, {"contract_id": 102}), contracts=PAIR)
    out = mart.customer_monthly(Frames(t).mart, t.contracts, t.customers)
    assert rows(out, "customer_id", "customer_name", "month", "contract_rows", "total_kw", "gross_margin", "erp_overage") == [
        (1, "Customer_01", "2023-01-01", 2, 20.0, 1500.0, 0.0)
    ]
    unknown = mart.customer_monthly(Frames(t).mart, t.contracts, t.customers.where("false"))
    assert rows(unknown, "customer_id", "customer_name", "contract_rows") == [(1, None, 2)]


def test_clamped_utilization_stays_within_what_is_granted(make):
    t = tables(make, meter=({"used_kw": "25.00"}, {"contract_id": 102, "used_kw": "5.00"}), contracts=PAIR)
    out = mart.clamped_utilization(mart.contract_utilization(Frames(t).mart))
    assert rows(out, "contract_id", "power_utilization", "rack_utilization") == [(101, 1.0, 0.75), (102, 0.25, None)]


def test_utilization_against_entitlement(make):
    out = mart.contract_utilization(Frames(tables(make, meter=({"used_kw": "25.00"},))).mart)
    assert rows(out, "avg_power_utilization", "avg_rack_utilization", "over_commit_flag", "over_racks_flag") == [
        (1.25, 0.75, 1, 0)
    ]


def test_trend_compares_with_the_month_before(make):
    t = tables(make, meter=({}, {"reading_date": "2023-02-10", "used_kw": "12.00"}))
    assert rows(mart.monthly_trend(Frames(t).mart), "month", "usage_kw", "usage_kw_change") == [
        ("2023-01-01", 10.0, None),
        ("2023-02-01", 12.0, 2.0),
    ]
