"""The registered queries a second time, as SQL for an independent engine.

Named steps are written once below and prefixed to a query as common table expressions when it, or a
step it uses, mentions them.
"""

from __future__ import annotations

import re

_LINE_ORDER = "l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_quantity DESC, l_extendedprice DESC"


def _version(key: str, day: str) -> str:
    return f"CASE WHEN {key} % 5 < 3 AND {day} >= DATE '1998-04-01' THEN 2 ELSE 1 END"


def _invoices(version: str, month: str) -> str:
    return f"""
    SELECT l_orderkey AS invoice_id, l_linenumber AS invoice_line_id, posting_date,
           {month} AS invoice_month, l_suppkey AS contract_id, {version} AS contract_version,
           CASE l_returnflag WHEN 'N' THEN 'recurring' WHEN 'A' THEN 'overage' ELSE 'credit' END AS revenue_type,
           CASE WHEN l_returnflag = 'R'
                THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(-0.2 AS DECIMAL(2,1)) AS DECIMAL(12,2))
                ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS amount
    FROM (SELECT l.*, CAST(o_orderdate AS DATE) AS posting_date
          FROM lineitem l JOIN orders ON l_orderkey = o_orderkey) billed"""


_POSTED = _version("l_suppkey", "posting_date")
_POSTED_MONTH = "CAST(date_trunc('month', posting_date) AS DATE)"
_SHIPPED = _version("l_suppkey", "CAST(l_shipdate AS DATE)")

_STATUS = """CASE WHEN {expected} = 0 AND {actual} = 0 THEN 'Green'
                  WHEN {expected} = 0 THEN 'Red'
                  WHEN abs(100 * (CAST({actual} - {expected} AS DOUBLE) / CAST({expected} AS DOUBLE))) <= 1 THEN 'Green'
                  WHEN abs(100 * (CAST({actual} - {expected} AS DOUBLE) / CAST({expected} AS DOUBLE))) <= 5 THEN 'Yellow'
                  ELSE 'Red' END"""

_REASON = """CASE WHEN late_reading_days > 0 THEN 'Late Meter Data'
                  WHEN estimated_days > 0 THEN 'Estimated Usage'
                  WHEN true_up_flag THEN 'Power Cost True-Up'
                  ELSE 'No Flag' END"""


def _average(kw: str) -> str:
    """Average of a decimal with six digits, stored with two. Straight from the double, an exact half cent
    such as 1890.07 / 26 = 72.695 could fall to either side."""
    return f"CAST(CAST(avg({kw}) AS DECIMAL(14,6)) AS DECIMAL(12,2))"


def _share(kw: str, site: str, cost: str) -> str:
    """Six digits first, for the same reason as the average."""
    return f"""CASE WHEN {site} = 0 THEN 0
                    ELSE CAST(CAST(CAST({kw} AS DOUBLE) / CAST({site} AS DOUBLE) * CAST({cost} AS DOUBLE)
                                   AS DECIMAL(20,6)) AS DECIMAL(14,2)) END"""


def _reconciled(mart: str) -> str:
    return f"""
    SELECT month, billed AS erp_revenue_total, booked AS mart_revenue_total, booked - billed AS variance_amount,
           CASE WHEN billed <> 0
                THEN round(100 * (CAST(booked - billed AS DOUBLE) / CAST(billed AS DOUBLE)), 4) END AS variance_pct,
           variance_bucket,
           CASE WHEN one_sided THEN 'Red' ELSE {_STATUS.format(expected="billed", actual="booked")} END AS control_status
    FROM (SELECT coalesce(e.month, m.month) AS month, coalesce(e.erp_sum, 0) AS billed, coalesce(m.mart_sum, 0) AS booked,
                 e.month IS NULL OR m.month IS NULL AS one_sided, {_REASON} AS variance_bucket
          FROM (SELECT invoice_month AS month, sum(amount) AS erp_sum FROM invoice GROUP BY 1) e
          FULL OUTER JOIN (SELECT month, sum(erp_revenue_total) AS mart_sum, sum(late_reading_days) AS late_reading_days,
                                  sum(estimated_days) AS estimated_days, bool_or(true_up_flag) AS true_up_flag
                           FROM {mart} GROUP BY 1) m ON e.month = m.month) sides"""


_STEPS = {
    # source tables
    "dim_customer": """
    SELECT s_suppkey AS customer_id, s_name AS customer_name, n_name AS industry, DATE '1995-01-01' AS start_date
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "dim_contract": """
    SELECT s_suppkey AS contract_id, v AS contract_version, s_suppkey AS customer_id,
           CASE WHEN v = 2 THEN DATE '1998-04-01' ELSE DATE '1995-01-01' END AS effective_start,
           CASE WHEN v = 1 AND s_suppkey % 5 < 3 THEN DATE '1998-03-31' ELSE DATE '2001-12-31' END AS effective_end,
           1 + s_suppkey % 10 AS racks_entitled,
           CAST(CAST(20 + s_suppkey % 31 AS DECIMAL(10,2))
                * CASE WHEN v = 2 THEN CAST(1.1 AS DECIMAL(2,1)) ELSE 1 END AS DECIMAL(10,2)) AS power_commit_kw,
           CAST(CAST(180 + s_suppkey % 271 AS DECIMAL(10,2))
                * CASE WHEN v = 2 THEN CAST(1.05 AS DECIMAL(3,2)) ELSE 1 END AS DECIMAL(10,2)) AS price_per_kw,
           CASE WHEN s_suppkey % 2 = 1 THEN 'Premium' ELSE 'Standard' END AS sla_tier,
           s_suppkey % 2 = 1 AS overage_allowed_flag
    FROM supplier JOIN (VALUES (1), (2)) versions(v) ON v = 1 OR s_suppkey % 5 < 3""",
    "meter_raw": f"""
    SELECT CAST(l_shipdate AS DATE) AS reading_date, l_suppkey AS contract_id,
           CASE WHEN l_partkey % 33 = 0 THEN 3 - ({_SHIPPED}) ELSE {_SHIPPED} END AS contract_version,
           CAST(l_quantity AS DECIMAL(10,2)) AS used_kw,
           CASE WHEN l_orderkey % 100 < 8 THEN 'late' WHEN l_orderkey % 100 < 12 THEN 'estimated'
                ELSE 'on_time' END AS reading_status,
           l_shipdate + to_days(CAST(l_orderkey % 11 AS INTEGER)) AS ingested_at,
           l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
    FROM lineitem""",
    "rack_raw": f"""
    SELECT CAST(l_shipdate AS DATE) AS usage_date, l_suppkey AS contract_id, {_SHIPPED} AS contract_version,
           l_linenumber AS racks_used, l_shipdate + to_days(CAST(l_orderkey % 11 AS INTEGER)) AS ingested_at,
           l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
    FROM lineitem""",
    "invoice": _invoices(_POSTED, _POSTED_MONTH),
    "invoice_misfiled": _invoices(
        f"CASE WHEN l_partkey % 47 = 0 THEN 3 - ({_POSTED}) ELSE {_POSTED} END",
        f"CASE WHEN l_partkey % 53 = 0 THEN CAST({_POSTED_MONTH} + INTERVAL '1' MONTH AS DATE) ELSE {_POSTED_MONTH} END",
    ),
    "power_cost": """
    SELECT cost_month, 1 AS site_id, 'kw_share' AS allocation_method,
           CAST(ordered * CAST(0.35 AS DECIMAL(2,2)) AS DECIMAL(20,2)) AS total_power_cost,
           month(cost_month) % 8 = 0 AS true_up_flag
    FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS cost_month,
                 CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS ordered
          FROM orders GROUP BY 1) monthly""",
    # curated
    "meter": f"""
    SELECT reading_date, contract_id, contract_version, used_kw, reading_status, ingested_at
    FROM (SELECT *, row_number() OVER (PARTITION BY contract_id, reading_date
                                       ORDER BY ingested_at DESC, {_LINE_ORDER}) AS pos
          FROM meter_raw) ranked
    WHERE pos = 1""",
    "rack": f"""
    SELECT usage_date, contract_id, contract_version, racks_used, ingested_at
    FROM (SELECT *, row_number() OVER (PARTITION BY contract_id, usage_date
                                       ORDER BY ingested_at DESC, {_LINE_ORDER}) AS pos
          FROM rack_raw) ranked
    WHERE pos = 1""",
    "meter_effective": """
    SELECT m.* FROM meter m JOIN dim_contract c
      ON m.contract_id = c.contract_id AND m.contract_version = c.contract_version
     AND m.reading_date BETWEEN c.effective_start AND c.effective_end""",
    "rack_effective": """
    SELECT r.* FROM rack r JOIN dim_contract c
      ON r.contract_id = c.contract_id AND r.contract_version = c.contract_version
     AND r.usage_date BETWEEN c.effective_start AND c.effective_end""",
    "usage": f"""
    SELECT contract_id, contract_version, CAST(date_trunc('month', reading_date) AS DATE) AS usage_month,
           CAST(sum(used_kw) AS DECIMAL(12,2)) AS total_kw,
           {_average("used_kw")} AS avg_daily_kw,
           CAST(max(used_kw) AS DECIMAL(12,2)) AS peak_kw,
           count(*) FILTER (WHERE reading_status = 'late') AS late_reading_days,
           count(*) FILTER (WHERE reading_status = 'estimated') AS estimated_days
    FROM meter_effective GROUP BY 1, 2, 3""",
    "rack_usage": """
    SELECT contract_id, contract_version, CAST(date_trunc('month', usage_date) AS DATE) AS usage_month,
           CAST(round(avg(racks_used), 2) AS DECIMAL(10,2)) AS avg_racks_used, max(racks_used) AS max_racks_used
    FROM rack_effective GROUP BY 1, 2, 3""",
    "erp": """
    SELECT contract_id, contract_version, invoice_month, sum(amount) AS erp_revenue_total,
           sum(CASE WHEN revenue_type = 'recurring' THEN amount ELSE 0 END) AS erp_mrr,
           sum(CASE WHEN revenue_type = 'overage' THEN amount ELSE 0 END) AS erp_overage,
           sum(CASE WHEN revenue_type = 'credit' THEN amount ELSE 0 END) AS erp_credits
    FROM invoice GROUP BY 1, 2, 3""",
    "cost": """
    SELECT cost_month, sum(total_power_cost) AS total_power_cost, bool_or(true_up_flag) AS true_up_flag
    FROM power_cost GROUP BY 1""",
    "calendar_days": """
    SELECT c.contract_id, c.contract_version, CAST(day AS DATE) AS reading_date, m.ingested_at,
           m.contract_id IS NULL AS missing
    FROM (SELECT contract_id, contract_version,
                 unnest(generate_series(effective_start, effective_end, INTERVAL '1' DAY)) AS day
          FROM dim_contract) c
    LEFT JOIN meter_effective m
      ON m.contract_id = c.contract_id AND m.contract_version = c.contract_version
     AND m.reading_date = CAST(c.day AS DATE)""",
    "active_months": """
    SELECT c.*, CAST(unnest(generate_series(date_trunc('month', effective_start), CAST(effective_end AS TIMESTAMP),
                                            INTERVAL '1' MONTH)) AS DATE) AS month
    FROM dim_contract c""",
    "mrr": """
    SELECT contract_id, contract_version, customer_id, month, round(power_commit_kw * price_per_kw, 2) AS contract_mrr
    FROM active_months""",
    # mart
    "site": "SELECT usage_month, sum(total_kw) AS total_site_kw FROM usage GROUP BY 1",
    "allocation": f"""
    SELECT u.*, t.total_site_kw, p.total_power_cost, p.true_up_flag,
           {_share("u.total_kw", "t.total_site_kw", "p.total_power_cost")} AS allocated_power_cost
    FROM usage u JOIN site t ON u.usage_month = t.usage_month JOIN cost p ON u.usage_month = p.cost_month""",
    "mart": """
    SELECT c.contract_id, c.contract_version, u.usage_month AS month, c.racks_entitled, c.power_commit_kw,
           u.total_kw, u.avg_daily_kw, u.peak_kw, r.avg_racks_used, r.max_racks_used,
           coalesce(e.erp_revenue_total, 0) AS erp_revenue_total, coalesce(e.erp_mrr, 0) AS erp_mrr,
           coalesce(e.erp_overage, 0) AS erp_overage, coalesce(e.erp_credits, 0) AS erp_credits,
           coalesce(p.allocated_power_cost, 0) AS allocated_power_cost,
           coalesce(e.erp_revenue_total, 0) - coalesce(p.allocated_power_cost, 0) AS gross_margin,
           u.late_reading_days, u.estimated_days, coalesce(p.true_up_flag, false) AS true_up_flag
    FROM usage u
    JOIN dim_contract c ON u.contract_id = c.contract_id AND u.contract_version = c.contract_version
    LEFT JOIN rack_usage r ON u.contract_id = r.contract_id AND u.contract_version = r.contract_version
                          AND u.usage_month = r.usage_month
    LEFT JOIN erp e ON u.contract_id = e.contract_id AND u.contract_version = e.contract_version
                   AND u.usage_month = e.invoice_month
    LEFT JOIN allocation p ON u.contract_id = p.contract_id AND u.contract_version = p.contract_version
                          AND u.usage_month = p.usage_month""",
    # controls
    "recon": _reconciled("mart"),
    "mart_altered": """
    SELECT * REPLACE (CASE WHEN month(month) = 7 THEN erp_revenue_total + 99 ELSE erp_revenue_total END AS erp_revenue_total)
    FROM (SELECT * FROM mart UNION ALL SELECT * FROM mart WHERE month(month) = 5) copied
    WHERE month(month) <> 2 OR contract_id % 3 <> 0""",
    "recon_altered": _reconciled("mart_altered"),
    "exceptions": "SELECT * FROM mart WHERE late_reading_days > 0 OR estimated_days > 0 OR true_up_flag",
    "summary": """
    SELECT month, count(*) AS contract_rows,
           sum(CASE WHEN late_reading_days > 0 THEN 1 ELSE 0 END) AS contracts_with_late_data,
           sum(CASE WHEN estimated_days > 0 THEN 1 ELSE 0 END) AS contracts_with_estimated_data,
           sum(CASE WHEN true_up_flag THEN 1 ELSE 0 END) AS contracts_with_trueups,
           sum(CASE WHEN gross_margin < 0 THEN 1 ELSE 0 END) AS contracts_negative_margin
    FROM mart GROUP BY 1""",
    "reading_taken": """
    SELECT event_id AS reading_id, user_id AS contract_id, CAST(ts AS DATE) AS reading_date,
           CAST(value AS DECIMAL(10,2)) AS used_kw, event_id % 11 <= 7 AS in_time
    FROM events""",
    "event_days": """
    SELECT reading_date AS usage_date, contract_id, count(*) AS readings, sum(used_kw) AS total_kw, max(used_kw) AS peak_kw
    FROM reading_taken
    WHERE in_time AND reading_date + INTERVAL '1' DAY
                      <= (SELECT max(reading_date) - INTERVAL '7' DAY FROM reading_taken WHERE in_time)
    GROUP BY 1, 2""",
    "event_spans": """
    SELECT user_id, min(CAST(ts AS DATE)) AS first_day,
           max(CAST(ts AS DATE)) - CASE WHEN user_id % 5 = 0 THEN 7 ELSE 0 END AS last_day
    FROM events GROUP BY user_id""",
    "event_held": """
    SELECT e.event_id, e.user_id AS contract_id, e.ts, CAST(e.ts AS DATE) AS day, CAST(e.value AS DECIMAL(10,2)) AS kw,
           coalesce(CAST(e.ts AS DATE) BETWEEN s.first_day AND s.last_day, false) AS held
    FROM events e LEFT JOIN event_spans s ON e.user_id = s.user_id""",
    "dim_contract_overlapping": """
    SELECT contract_id, contract_version,
           CASE WHEN contract_version = 2 THEN DATE '1998-04-15' ELSE effective_start END AS effective_start,
           CASE WHEN effective_end = DATE '1998-03-31' THEN DATE '1998-06-30' ELSE effective_end END AS effective_end
    FROM dim_contract""",
    "dim_contract_tangled": "\n    UNION ALL ".join(
        f"SELECT s_suppkey AS contract_id, {v} AS contract_version, DATE '{a}' AS effective_start, DATE '{b}' AS effective_end "
        f"FROM supplier WHERE s_suppkey % 4 = {kind}"
        for kind, windows in enumerate(
            (
                (("1995-01-01", "2001-12-31"), ("1998-04-01", "1998-06-30"), ("1998-07-01", "2001-12-31")),
                (("1995-01-01", "1996-12-31"), ("1997-02-01", "2001-12-31")),
                (("1997-01-01", "2001-12-31"), ("1995-01-01", "1996-12-31")),
                (("1995-01-01", "1999-12-31"), ("1996-01-01", "1996-12-31"), ("1999-06-01", "2000-12-31"), ("2001-03-01", "2001-12-31")),
            )
        )
        for v, (a, b) in enumerate(windows, 1)
    ),
    "signed": """
    SELECT m.*, m.estimated_days = 0 AND coalesce(d.open_days, 1) = 0 AS signed
    FROM mart m LEFT JOIN (
      SELECT contract_id, contract_version, CAST(date_trunc('month', reading_date) AS DATE) AS month,
             count(*) FILTER (WHERE missing OR date_diff('day', reading_date, CAST(ingested_at AS DATE)) > 7) AS open_days
      FROM calendar_days GROUP BY 1, 2, 3) d
      ON m.contract_id = d.contract_id AND m.contract_version = d.contract_version AND m.month = d.month""",
    "meter_backfilled": f"""
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY contract_id, reading_date
                                   ORDER BY ingested_at DESC, {_LINE_ORDER}) AS pos
      FROM (SELECT *, CASE WHEN CAST(ingested_at AS DATE) > reading_date
                           THEN TIMESTAMP '2002-01-01 00:00:00' END AS reprocessed_at
            FROM meter_raw) marked) ranked
    WHERE pos = 1""",
}

# Stored tables keep the declared columns alone: equal arrivals are told apart by the readings' own values.
_STEPS["meter_stored"] = """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY contract_id, reading_date ORDER BY ingested_at DESC,
                             contract_version DESC, used_kw DESC, reading_status DESC) AS pos FROM meter_raw) ranked
    WHERE pos = 1"""
_STEPS["rack_stored"] = """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY contract_id, usage_date ORDER BY ingested_at DESC,
                             contract_version DESC, racks_used DESC) AS pos FROM rack_raw) ranked
    WHERE pos = 1"""
_ON_STORED = ("meter_effective", "rack_effective", "usage", "rack_usage", "site", "allocation", "mart")
for _step in _ON_STORED:
    _STEPS[f"{_step}_stored"] = re.sub(
        rf"\b(FROM|JOIN) (meter|rack|{'|'.join(_ON_STORED)})\b", r"\1 \2_stored", _STEPS[_step]
    )



def _carried(correction: str) -> str:
    """Readings of every tenth contract on every day: a reading counts until the next one."""
    return f"""
    SELECT CAST(day AS DATE) AS reading_date, contract_id,
           CASE WHEN own THEN contract_version ELSE {_version("contract_id", "CAST(day AS DATE)")} END AS contract_version,
           CAST(used_kw + {correction} AS DECIMAL(10,2)) AS used_kw,
           CASE WHEN own THEN reading_status ELSE 'on_time' END AS reading_status,
           CASE WHEN own THEN ingested_at ELSE day + INTERVAL '6' HOUR END AS ingested_at
    FROM (SELECT *, CAST(day AS DATE) = reading_date AS own
          FROM (SELECT *, unnest(generate_series(CAST(reading_date AS TIMESTAMP), CAST(until AS TIMESTAMP), INTERVAL '1' DAY)) AS day
                FROM (SELECT *, coalesce(lead(reading_date) OVER (PARTITION BY contract_id ORDER BY reading_date) - 1,
                                         DATE '2001-12-31') AS until
                      FROM meter WHERE contract_id % 10 = 0) spans) listed) days"""


_STEPS["meter_dense"] = _carried("0")
_STEPS["meter_corrected"] = _carried("CASE WHEN contract_id % 20 = 0 AND month(day) IN (3, 6, 9) THEN 1 ELSE 0 END")
_ON_DENSE = ("meter_effective", "usage", "site", "allocation", "mart", "calendar_days", "signed")
for _kind in ("dense", "corrected"):
    for _step in _ON_DENSE:
        _STEPS[f"{_step}_{_kind}"] = re.sub(rf"\b(FROM|JOIN) (meter|{'|'.join(_ON_DENSE)})\b", rf"\1 \2_{_kind}", _STEPS[_step])
# What each close knows of a month's cost, straight from the orders known by then.
_STEPS["closed_cost"] = """
    SELECT cost_month, close_on, CAST(ordered * CAST(0.35 AS DECIMAL(2,2)) AS DECIMAL(20,2)) AS total_power_cost
    FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS cost_month,
                 CAST(last_day(CAST(o_orderdate AS DATE)) + days AS DATE) AS close_on,
                 CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS ordered
          FROM orders, (VALUES (5), (20), (60)) closes(days)
          WHERE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45 AS INTEGER) <= last_day(CAST(o_orderdate AS DATE)) + days
          GROUP BY 1, 2) known"""

_DOUBLES = """booked signed_total_kw signed_erp_revenue_total signed_gross_margin rebuilt_total_kw rebuilt_erp_revenue_total
    rebuilt_gross_margin gross_margin_change used_kw total_kw avg_daily_kw peak_kw avg_racks_used erp_revenue_total erp_mrr erp_overage erp_credits
    allocated_power_cost gross_margin power_commit_kw price_per_kw total_site_kw total_power_cost contract_mrr
    mart_revenue_total variance_amount variance_pct contract_erp_revenue amount kw_over_commit invoiced_mrr
    mrr_difference late_kw estimated_kw late_share estimated_share estimated_allocation actual_allocation
    true_up_amount revenue power_cost margin usage_kw revenue_change power_cost_change margin_change
    usage_kw_change margin_ratio avg_power_utilization peak_power_utilization avg_rack_utilization
    peak_rack_utilization signed_kw signed_row_share signed_kw_share power_commit_kw_change
    price_per_kw_change recorded_sum stored_sum""".split()
_INTS = """contract_id contract_version customer_id racks_entitled max_racks_used racks_used late_reading_days
    estimated_days true_up_flag late_flag estimated_flag true_up_flag2 contract_rows contracts_with_late_data
    contracts_with_estimated_data contracts_with_trueups contracts_negative_margin gap_days next_version
    stated_version in_force_version billed_version reattributed missing previous_version racks_entitled_change
    over_commit_flag over_racks_flag invoice_id invoice_line_id row_count null_count null_revenue_rows
    null_cost_rows cnt signed_rows readings overage_allowed_flag days_to_close reading_id
    recorded_rows stored_rows copies natural_id key""".split()
_TEXTS = ["ingested_at", "reprocessed_at"]


def _emit(columns: str, source: str) -> str:
    """SELECT of plain result types, matching ``frames.presented``."""

    def plain(name: str) -> str:
        for names, kind in ((_DOUBLES, "DOUBLE"), (_INTS, "BIGINT"), (_TEXTS, "VARCHAR")):
            if name in names:
                return f"CAST({name} AS {kind}) AS {name}"
        return name

    return f"SELECT {', '.join(plain(c) for c in columns.split())}\nFROM {source}"


_MART_COLUMNS = """contract_id contract_version month racks_entitled power_commit_kw total_kw avg_daily_kw peak_kw
    avg_racks_used max_racks_used erp_revenue_total erp_mrr erp_overage erp_credits allocated_power_cost
    gross_margin late_reading_days estimated_days true_up_flag"""
_METER_COLUMNS = "reading_date contract_id contract_version used_kw reading_status ingested_at"
_RECON_COLUMNS = """month erp_revenue_total mart_revenue_total variance_amount variance_pct variance_bucket
    control_status"""
_SUMMARY_COLUMNS = """month contract_rows contracts_with_late_data contracts_with_estimated_data
    contracts_with_trueups contracts_negative_margin"""

_SOURCE_STEPS = {
    "dim_customer": "dim_customer",
    "dim_contract": "dim_contract",
    "fact_meter_power_daily": "meter_raw",
    "fact_rack_utilization_daily": "rack_raw",
    "fact_invoice_line": "invoice",
    "fact_power_cost_monthly": "power_cost",
}
_KEYS = {
    "dim_customer": "customer_id",
    "dim_contract": "contract_id contract_version",
    "fact_meter_power_daily": "reading_date contract_id contract_version",
    "fact_rack_utilization_daily": "usage_date contract_id contract_version",
    "fact_invoice_line": "invoice_id invoice_line_id",
    "fact_power_cost_monthly": "cost_month site_id",
}
_REQUIRED = {
    "dim_customer": "customer_id customer_name start_date",
    "dim_contract": """contract_id contract_version customer_id effective_start effective_end racks_entitled
        power_commit_kw price_per_kw sla_tier overage_allowed_flag""",
    "fact_meter_power_daily": "reading_date contract_id contract_version reading_status ingested_at",
    "fact_rack_utilization_daily": "usage_date contract_id contract_version ingested_at",
    "fact_invoice_line": """invoice_id invoice_line_id posting_date invoice_month contract_id contract_version
        revenue_type amount""",
    "fact_power_cost_monthly": "cost_month site_id allocation_method true_up_flag",
}
_REFERENCES = (
    ("dim_contract", "customer_id", "dim_customer"),
    ("fact_meter_power_daily", "contract_id contract_version", "dim_contract"),
    ("fact_rack_utilization_daily", "contract_id contract_version", "dim_contract"),
    ("fact_invoice_line", "contract_id contract_version", "dim_contract"),
)


def _duplicates(table: str) -> str:
    key = ", ".join(_KEYS[table].split())
    return f"""SELECT '{table}' AS table_name, concat_ws('|', {key}) AS key_value, count(*) AS row_count
    FROM {_SOURCE_STEPS[table]} GROUP BY {key} HAVING count(*) > 1"""


def _orphans(child: str, columns: str, parent: str) -> str:
    names = columns.split()
    match = " AND ".join(f"p.{c} = a.{c}" for c in names)
    return f"""SELECT '{child}' AS table_name, '{parent}' AS references_table,
           concat_ws('|', {", ".join("a." + c for c in names)}) AS key_value, count(*) AS row_count
    FROM {_SOURCE_STEPS[child]} a WHERE NOT EXISTS (SELECT 1 FROM {_SOURCE_STEPS[parent]} p WHERE {match})
    GROUP BY {", ".join("a." + c for c in names)}"""


def _nulls(table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count,"
        f" count(*) AS row_count FROM {_SOURCE_STEPS[table]}"
        for c in _REQUIRED[table].split()
    )


def _marked(*parts: str) -> str:
    """Parts with their lengths, as the surrogate keys take them."""
    texts = [f"CAST({p} AS VARCHAR)" for p in parts]
    return "concat_ws(';', " + ", ".join(f"coalesce(length({t}) || ':' || {t}, 'null')" for t in texts) + ")"


def _stale(contracts: str) -> str:
    return _emit(
        """invoice_id invoice_line_id contract_id invoice_month billed_version in_force_version stale_reason
        revenue_type amount""",
        f"""(SELECT i.*, i.contract_version AS billed_version, n.in_force_version,
             CASE WHEN n.in_force_version IS NULL THEN 'no version in force' ELSE 'other version in force' END AS stale_reason
      FROM invoice_misfiled i
      LEFT JOIN (SELECT j.invoice_id, j.invoice_line_id, j.contract_id, j.invoice_month, j.contract_version,
                        max(c.contract_version) AS in_force_version,
                        bool_or(c.contract_version = j.contract_version) AS billable
                 FROM (SELECT DISTINCT invoice_id, invoice_line_id, contract_id, invoice_month, contract_version
                       FROM invoice_misfiled) j
                 JOIN {contracts} c ON j.contract_id = c.contract_id AND c.effective_start <= last_day(j.invoice_month)
                  AND c.effective_end >= j.invoice_month
                 GROUP BY 1, 2, 3, 4, 5) n
        ON i.invoice_id = n.invoice_id AND i.invoice_line_id = n.invoice_line_id AND i.contract_id = n.contract_id
       AND i.invoice_month = n.invoice_month AND i.contract_version = n.contract_version
      WHERE n.billable IS DISTINCT FROM true) stale""",
    )


def _swept(contracts: str) -> str:
    """Every version against all others of its contract: the ends of those that start no later, the first of
    those that start later."""
    before = "(b.effective_start < a.effective_start OR b.effective_start = a.effective_start AND b.contract_version <= a.contract_version)"
    return _emit(
        "contract_id contract_version effective_start effective_end covered_until next_start gap_days window_status",
        f"""(SELECT *, CASE WHEN next_start IS NULL THEN 'last' WHEN next_start <= covered_until THEN 'overlap'
                     WHEN next_start > covered_until + INTERVAL '1' DAY THEN 'gap' ELSE 'contiguous' END AS window_status,
             date_diff('day', covered_until, next_start) - 1 AS gap_days
      FROM (SELECT a.contract_id, a.contract_version, a.effective_start, a.effective_end,
                   max(b.effective_end) FILTER (WHERE {before}) AS covered_until,
                   min(b.effective_start) FILTER (WHERE NOT {before}) AS next_start
            FROM {contracts} a JOIN {contracts} b ON a.contract_id = b.contract_id
            GROUP BY 1, 2, 3, 4) paired) checked""",
    )


_COUNTED = {
    "v_meter_power_daily_effective": "meter_effective",
    "v_rack_utilization_daily_effective": "rack_effective",
    "v_usage_monthly": "usage",
    "v_rack_monthly": "rack_usage",
    "v_erp_revenue_monthly": "erp",
    "v_power_cost_monthly": "cost",
    "mart_contract_monthly": "mart",
}

_INVOICE_COLUMNS = """invoice_id invoice_line_id posting_date invoice_month contract_id contract_version revenue_type
    amount"""
_LINE = " || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in _INVOICE_COLUMNS.split())
#: Lines whose number leaves 0 of 97 have no amount, those that leave 1 end after four values.
_DAMAGED = f"""
    SELECT {", ".join(f"CASE WHEN kind > 1 THEN {c} END AS {c}" for c in _INVOICE_COLUMNS.split())},
           CASE kind WHEN 0 THEN regexp_replace({_LINE}, ',[^,]*$', ',n/a')
                     WHEN 1 THEN array_to_string(string_split({_LINE}, ',')[1:4], ',') END AS damaged_line
    FROM (SELECT *, invoice_id % 97 AS kind FROM invoice) numbered"""

#: Tables of the ledger check with their month, their control amounts, and what is stored where that differs.
_LEDGERED = (
    ("dim_contract", "dim_contract", "NULL", "0"),
    ("fact_power_cost_monthly", "power_cost", "NULL", "total_power_cost"),
    ("usage_monthly", "usage", "usage_month", "total_kw"),
    ("rack_monthly", "rack_usage", "usage_month", "0"),
    ("erp_revenue_monthly", "erp", "invoice_month", "erp_revenue_total"),
    ("mart_contract_monthly", "mart", "month", "erp_revenue_total + allocated_power_cost + total_kw", "mart_altered"),
)


def _ledgered(table: str, source: str, month: str, control: str, stored: str | None = None) -> str:
    totals = "SELECT CAST({month} AS DATE) AS month, count(*) AS n, CAST(sum({control}) AS DECIMAL(38,2)) AS total FROM {of} GROUP BY 1"
    recorded, holds = (totals.format(month=month, control=control, of=of) for of in (source, stored or source))
    return f"""SELECT '{table}' AS table_name, coalesce(r.month, s.month) AS month, coalesce(r.n, 0) AS recorded_rows,
             coalesce(s.n, 0) AS stored_rows, coalesce(r.total, 0) AS recorded_sum, coalesce(s.total, 0) AS stored_sum
      FROM ({recorded}) r FULL OUTER JOIN ({holds}) s ON r.month IS NOT DISTINCT FROM s.month"""


_QUERIES = {
    "latest_reading": _emit(_METER_COLUMNS, "meter"),
    "effective_meter": _emit(_METER_COLUMNS, "meter_effective"),
    "effective_rack": _emit("usage_date contract_id contract_version racks_used ingested_at", "rack_effective"),
    "rejected_readings": _emit(
        _METER_COLUMNS + " reject_reason",
        """(SELECT m.*, CASE WHEN c.contract_id IS NULL THEN 'unknown version' ELSE 'outside window' END AS reject_reason
      FROM meter m LEFT JOIN dim_contract c
        ON m.contract_id = c.contract_id AND m.contract_version = c.contract_version
      WHERE c.contract_id IS NULL OR m.reading_date < c.effective_start OR m.reading_date > c.effective_end) rejected""",
    ),
    "version_reattribution": _emit(
        "reading_date contract_id stated_version in_force_version used_kw reattributed",
        """(SELECT m.reading_date, m.contract_id, m.contract_version AS stated_version,
             c.contract_version AS in_force_version, m.used_kw,
             m.contract_version IS DISTINCT FROM c.contract_version AS reattributed
      FROM meter m LEFT JOIN dim_contract c
        ON m.contract_id = c.contract_id AND m.reading_date BETWEEN c.effective_start AND c.effective_end) moved""",
    ),
    "version_windows": _swept("dim_contract"),
    "version_windows_tangled": _swept("dim_contract_tangled"),
    "missing_readings": _emit("contract_id contract_version reading_date", "calendar_days WHERE missing"),
    "lateness_class": _emit(
        "contract_id contract_version reading_date missing lateness_class",
        """(SELECT *, CASE WHEN missing OR date_diff('day', reading_date, CAST(ingested_at AS DATE)) > 7 THEN 'estimated'
                     WHEN date_diff('day', reading_date, CAST(ingested_at AS DATE)) > 0 THEN 'late'
                     ELSE 'on_time' END AS lateness_class
      FROM calendar_days) classed""",
    ),
    "backfill_merge": _emit(_METER_COLUMNS + " reprocessed_at", "meter_backfilled"),
    "surrogate_keys": _emit(
        "contract_key customer_key source_system contract_id contract_version customer_id",
        f"""(SELECT *, md5({_marked("source_system", "contract_id", "contract_version")}) AS contract_key,
             md5({_marked("source_system", "customer_id")}) AS customer_key
      FROM dim_contract, (VALUES ('erp'), ('crm')) systems(source_system)) keyed""",
    ),
    "customer_labels": """SELECT customer_id, printf('Customer_%02d', customer_id) AS customer_label, industry
    FROM dim_customer""",
    "active_contract_months": _emit("contract_id contract_version customer_id month", "active_months"),
    "usage_monthly": _emit(
        """contract_id contract_version usage_month total_kw avg_daily_kw peak_kw late_reading_days
        estimated_days""",
        "usage",
    ),
    "rack_monthly": _emit("contract_id contract_version usage_month avg_racks_used max_racks_used", "rack_usage"),
    "erp_revenue_monthly": _emit(
        "contract_id contract_version invoice_month erp_revenue_total erp_mrr erp_overage erp_credits", "erp"
    ),
    "power_cost_monthly": _emit("cost_month total_power_cost true_up_flag", "cost"),
    "total_usage_monthly": _emit("usage_month total_site_kw", "site"),
    "power_cost_allocated": _emit(
        """usage_month contract_id contract_version total_kw avg_daily_kw peak_kw late_reading_days estimated_days
        total_site_kw total_power_cost true_up_flag allocated_power_cost""",
        "allocation",
    ),
    "mart_contract_monthly": _emit(_MART_COLUMNS, "mart"),
    "contract_mrr": _emit("contract_id contract_version customer_id month contract_mrr", "mrr"),
    "customer_monthly": _emit(
        """customer_id month contract_rows total_kw erp_revenue_total erp_mrr erp_overage erp_credits
        allocated_power_cost gross_margin customer_name industry""",
        """(SELECT owned.*, d.customer_name, d.industry FROM (SELECT c.customer_id, m.month, count(*) AS contract_rows, sum(m.total_kw) AS total_kw,
             sum(m.erp_revenue_total) AS erp_revenue_total, sum(m.erp_mrr) AS erp_mrr,
             sum(m.erp_overage) AS erp_overage, sum(m.erp_credits) AS erp_credits,
             sum(m.allocated_power_cost) AS allocated_power_cost, sum(m.gross_margin) AS gross_margin
      FROM mart m JOIN dim_contract c ON m.contract_id = c.contract_id AND m.contract_version = c.contract_version
      GROUP BY 1, 2) owned LEFT JOIN dim_customer d ON owned.customer_id = d.customer_id) named""",
    ),
    "clamped_utilization": """
    SELECT CAST(contract_id AS BIGINT) AS contract_id, CAST(contract_version AS BIGINT) AS contract_version, month,
           CASE WHEN power IS NOT NULL THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, power)) END AS power_utilization,
           CASE WHEN racks IS NOT NULL THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, racks)) END AS rack_utilization
    FROM (SELECT *, CAST(avg_daily_kw AS DOUBLE) / nullif(CAST(power_commit_kw AS DOUBLE), 0) AS power,
                 CAST(avg_racks_used AS DOUBLE) / nullif(CAST(racks_entitled AS DOUBLE), 0) AS racks
          FROM mart) used""",
    "posting_month_end": _emit(
        "invoice_id invoice_line_id posting_date closes_on days_to_close",
        """(SELECT *, date_diff('day', posting_date, closes_on) AS days_to_close
      FROM (SELECT *, last_day(invoice_month) AS closes_on FROM invoice) dated) timed""",
    ),
    "contract_utilization": _emit(
        """contract_id contract_version month avg_power_utilization peak_power_utilization avg_rack_utilization
        peak_rack_utilization over_commit_flag over_racks_flag""",
        """(SELECT contract_id, contract_version, month,
             CAST(avg_daily_kw AS DOUBLE) / nullif(CAST(power_commit_kw AS DOUBLE), 0) AS avg_power_utilization,
             CAST(peak_kw AS DOUBLE) / nullif(CAST(power_commit_kw AS DOUBLE), 0) AS peak_power_utilization,
             CAST(avg_racks_used AS DOUBLE) / nullif(CAST(racks_entitled AS DOUBLE), 0) AS avg_rack_utilization,
             CAST(max_racks_used AS DOUBLE) / nullif(CAST(racks_entitled AS DOUBLE), 0) AS peak_rack_utilization,
             CASE WHEN peak_kw > power_commit_kw THEN 1 ELSE 0 END AS over_commit_flag,
             CASE WHEN max_racks_used > racks_entitled THEN 1 ELSE 0 END AS over_racks_flag
      FROM mart) used""",
    ),
    "monthly_trend": _emit(
        """month revenue power_cost margin usage_kw revenue_change power_cost_change margin_change
        usage_kw_change margin_ratio""",
        """(SELECT *, revenue - lag(revenue) OVER (ORDER BY month) AS revenue_change,
             power_cost - lag(power_cost) OVER (ORDER BY month) AS power_cost_change,
             margin - lag(margin) OVER (ORDER BY month) AS margin_change,
             usage_kw - lag(usage_kw) OVER (ORDER BY month) AS usage_kw_change,
             CAST(margin AS DOUBLE) / nullif(CAST(revenue AS DOUBLE), 0) AS margin_ratio
      FROM (SELECT month, sum(erp_revenue_total) AS revenue, sum(allocated_power_cost) AS power_cost,
                   sum(gross_margin) AS margin, sum(total_kw) AS usage_kw FROM mart GROUP BY 1) totals) trend""",
    ),
    "true_up_delta": _emit(
        "contract_id contract_version usage_month estimated_allocation actual_allocation true_up_amount",
        f"""(SELECT *, actual_allocation - estimated_allocation AS true_up_amount
      FROM (SELECT contract_id, contract_version, usage_month, allocated_power_cost AS actual_allocation,
                   {_share("total_kw", "total_site_kw",
                           "CASE WHEN true_up_flag THEN CAST(CAST(total_power_cost AS DECIMAL(20,2)) "
                           "* CAST(0.95 AS DECIMAL(3,2)) AS DECIMAL(20,2)) ELSE total_power_cost END")}
                     AS estimated_allocation
            FROM allocation) snapshots) delta""",
    ),
    "estimated_share": _emit(
        "contract_id contract_version usage_month total_kw late_kw estimated_kw late_share estimated_share",
        """(SELECT *, CAST(late_kw AS DOUBLE) / nullif(CAST(total_kw AS DOUBLE), 0) AS late_share,
             CAST(estimated_kw AS DOUBLE) / nullif(CAST(total_kw AS DOUBLE), 0) AS estimated_share
      FROM (SELECT contract_id, contract_version, CAST(date_trunc('month', reading_date) AS DATE) AS usage_month,
                   sum(used_kw) AS total_kw,
                   sum(CASE WHEN reading_status = 'late' THEN used_kw ELSE 0 END) AS late_kw,
                   sum(CASE WHEN reading_status = 'estimated' THEN used_kw ELSE 0 END) AS estimated_kw
            FROM meter_effective GROUP BY 1, 2, 3) sums) quality""",
    ),
    "controls_data_integrity": _emit(_RECON_COLUMNS, "recon"),
    "controls_of_altered_mart": _emit(_RECON_COLUMNS, "recon_altered"),
    "layer_ledger_check": _emit(
        "table_name month recorded_rows stored_rows recorded_sum stored_sum ledger_status",
        """(SELECT *, CASE WHEN recorded_rows = stored_rows AND recorded_sum = stored_sum THEN 'Green' ELSE 'Red' END AS ledger_status
      FROM ("""
        + " UNION ALL ".join(_ledgered(*t) for t in _LEDGERED)
        + """) totals) checked""",
    ),
    "contract_variance_monthly": _emit(
        """month contract_id contract_version contract_erp_revenue allocated_power_cost gross_margin
        late_reading_days estimated_days true_up_flag total_kw avg_daily_kw peak_kw late_flag estimated_flag
        true_up_flag2""",
        """(SELECT *, erp_revenue_total AS contract_erp_revenue,
             CASE WHEN late_reading_days > 0 THEN 1 ELSE 0 END AS late_flag,
             CASE WHEN estimated_days > 0 THEN 1 ELSE 0 END AS estimated_flag,
             CASE WHEN true_up_flag THEN 1 ELSE 0 END AS true_up_flag2 FROM mart) flagged""",
    ),
    "contract_exception_reason": _emit(
        "month contract_id contract_version exception_reason",
        f"(SELECT *, {_REASON} AS exception_reason FROM mart) reasoned",
    ),
    "exception_counts": _emit(
        "month exception_reason contract_rows",
        f"(SELECT month, {_REASON} AS exception_reason, count(*) AS contract_rows FROM mart GROUP BY 1, 2) counted",
    ),
    "exceptions_only": _emit(_MART_COLUMNS, "exceptions"),
    "controls_summary": _emit(_SUMMARY_COLUMNS, "summary"),
    "negative_margin": _emit(_MART_COLUMNS, "mart WHERE gross_margin < 0"),
    "signoff_set": _emit(
        "contract_id contract_version month total_kw erp_revenue_total gross_margin", "signed WHERE signed"
    ),
    "signoff_share": _emit(
        "month contract_rows signed_rows total_kw signed_kw signed_row_share signed_kw_share",
        """(SELECT *, CAST(signed_rows AS DOUBLE) / CAST(contract_rows AS DOUBLE) AS signed_row_share,
             CAST(signed_kw AS DOUBLE) / nullif(CAST(total_kw AS DOUBLE), 0) AS signed_kw_share
      FROM (SELECT month, count(*) AS contract_rows, count(*) FILTER (WHERE signed) AS signed_rows,
                   sum(total_kw) AS total_kw,
                   sum(CASE WHEN signed THEN total_kw ELSE 0 END) AS signed_kw
            FROM signed GROUP BY 1) sums) shares""",
    ),
    "top_recent_contracts": _emit(
        _MART_COLUMNS, "mart ORDER BY mart.month DESC, mart.contract_id, mart.contract_version LIMIT 10"
    ),
    "top_exceptions": _emit(
        _MART_COLUMNS,
        "exceptions ORDER BY exceptions.month DESC, exceptions.contract_id, exceptions.contract_version LIMIT 20",
    ),
    "top_controls_integrity": _emit(_RECON_COLUMNS, "recon ORDER BY month DESC LIMIT 12"),
    "top_controls_summary": _emit(_SUMMARY_COLUMNS, "summary ORDER BY month DESC LIMIT 12"),
    "mrr_vs_invoiced": _emit(
        "contract_id contract_version month contract_mrr invoiced_mrr mrr_difference control_status",
        f"""(SELECT *, invoiced_mrr - contract_mrr AS mrr_difference,
             {_STATUS.format(expected="contract_mrr", actual="invoiced_mrr")} AS control_status
      FROM (SELECT coalesce(d.contract_id, e.contract_id) AS contract_id,
                   coalesce(d.contract_version, e.contract_version) AS contract_version,
                   coalesce(d.month, e.invoice_month) AS month,
                   coalesce(d.contract_mrr, 0) AS contract_mrr, coalesce(e.erp_mrr, 0) AS invoiced_mrr
            FROM mrr d FULL OUTER JOIN erp e ON d.contract_id = e.contract_id
             AND d.contract_version = e.contract_version AND d.month = e.invoice_month) paired) checked""",
    ),
    "variance_root_cause": _emit(
        "contract_id contract_version invoice_month erp_revenue_total root_cause",
        """(SELECT b.contract_id, b.contract_version, b.invoice_month, b.erp_revenue_total,
             CASE WHEN c.contract_id IS NULL THEN 'mapping' WHEN u.contract_id IS NULL THEN 'missing data'
                  WHEN b.off_month THEN 'timing' WHEN u.late_reading_days > 0 THEN 'late data' ELSE 'none' END AS root_cause
      FROM (SELECT contract_id, contract_version, invoice_month, sum(amount) AS erp_revenue_total,
                   bool_or(CAST(date_trunc('month', posting_date) AS DATE) <> invoice_month) AS off_month
            FROM invoice_misfiled GROUP BY 1, 2, 3) b
      LEFT JOIN dim_contract c ON b.contract_id = c.contract_id AND b.contract_version = c.contract_version
      LEFT JOIN usage u ON b.contract_id = u.contract_id AND b.contract_version = u.contract_version
                       AND b.invoice_month = u.usage_month) causes""",
    ),
    "stale_version_billing": _stale("dim_contract"),
    "stale_version_mid_month": _stale("dim_contract_overlapping"),
    "version_reattribution_overlap": _emit(
        "reading_date contract_id stated_version in_force_version used_kw reattributed",
        """(SELECT m.reading_date, m.contract_id, m.contract_version AS stated_version, m.used_kw, c.in_force_version,
             m.contract_version IS DISTINCT FROM c.in_force_version AS reattributed
      FROM meter m LEFT JOIN (
        SELECT r.contract_id, r.reading_date, max(c.contract_version) AS in_force_version
        FROM meter r JOIN dim_contract_overlapping c
          ON r.contract_id = c.contract_id AND r.reading_date BETWEEN c.effective_start AND c.effective_end
        GROUP BY 1, 2) c ON m.contract_id = c.contract_id AND m.reading_date = c.reading_date) moved""",
    ),
    "amendments": _emit(
        """contract_id contract_version previous_version amended_from racks_entitled_change power_commit_kw_change
        price_per_kw_change""",
        """(SELECT b.contract_id, b.contract_version, a.contract_version AS previous_version,
             b.effective_start AS amended_from, b.racks_entitled - a.racks_entitled AS racks_entitled_change,
             b.power_commit_kw - a.power_commit_kw AS power_commit_kw_change,
             b.price_per_kw - a.price_per_kw AS price_per_kw_change
      FROM dim_contract b JOIN dim_contract a
        ON a.contract_id = b.contract_id AND a.contract_version = b.contract_version - 1) changed""",
    ),
    "unbilled_spikes": _emit(
        "contract_id contract_version month peak_kw power_commit_kw kw_over_commit",
        """(SELECT m.*, m.peak_kw - m.power_commit_kw AS kw_over_commit
      FROM mart m JOIN dim_contract c ON m.contract_id = c.contract_id AND m.contract_version = c.contract_version
      WHERE m.peak_kw > m.power_commit_kw AND m.erp_overage = 0 AND c.overage_allowed_flag) spikes""",
    ),
    "disallowed_overage": _emit(
        "invoice_id invoice_line_id contract_id contract_version invoice_month amount",
        """(SELECT i.* FROM invoice i JOIN dim_contract c
        ON i.contract_id = c.contract_id AND i.contract_version = c.contract_version
      WHERE i.revenue_type = 'overage' AND NOT c.overage_allowed_flag) barred""",
    ),
    "pk_violations": _emit(
        "table_name key_value row_count",
        "(" + "\n UNION ALL ".join(_duplicates(t) for t in _SOURCE_STEPS) + ") duplicates",
    ),
    "fk_violations": _emit(
        "table_name references_table key_value row_count",
        "(" + "\n UNION ALL ".join(_orphans(*r) for r in _REFERENCES) + ") orphans",
    ),
    "not_null_violations": _emit(
        "table_name column_name null_count row_count",
        "(" + "\n UNION ALL ".join(_nulls(t) for t in _SOURCE_STEPS) + ") nulls",
    ),
    "null_risk": _emit(
        "null_revenue_rows null_cost_rows",
        """(SELECT count(*) FILTER (WHERE erp_revenue_total IS NULL) AS null_revenue_rows,
             count(*) FILTER (WHERE allocated_power_cost IS NULL) AS null_cost_rows FROM mart) risk""",
    ),
    "csv_contracts": _emit(
        """contract_id contract_version customer_id effective_start effective_end racks_entitled power_commit_kw
        price_per_kw sla_tier overage_allowed_flag""",
        "dim_contract",
    ),
    "csv_invoice_lines": _emit(
        """invoice_id invoice_line_id posting_date invoice_month contract_id contract_version revenue_type
        amount""",
        "invoice",
    ),
    "table_append_load": _emit(_METER_COLUMNS, "meter_raw"),
    "load_audit": _emit(
        f"{_INVOICE_COLUMNS} reason copies",
        f"""(SELECT {', '.join(_INVOICE_COLUMNS.split())}, CASE WHEN part > 1 THEN coalesce(fault, 'duplicate key') END AS reason, count(*) AS copies
      FROM (SELECT *, CASE WHEN fault IS NOT NULL THEN 2
                           ELSE row_number() OVER (PARTITION BY invoice_id, invoice_line_id, fault ORDER BY posting_date DESC,
                                invoice_month DESC, contract_id DESC, contract_version DESC, revenue_type DESC, amount DESC) END AS part
            FROM (SELECT i.*, CASE WHEN i.amount IS NULL THEN 'missing amount'
                                   WHEN c.contract_id IS NULL THEN 'no dim_contract for contract_id contract_version' END AS fault
                  FROM (SELECT * REPLACE (CASE WHEN invoice_id % 89 <> 0 THEN amount END AS amount,
                                          contract_id + CASE WHEN invoice_id % 101 = 0 THEN 1000000000 ELSE 0 END AS contract_id)
                        FROM invoice) i
                  LEFT JOIN dim_contract c ON i.contract_id = c.contract_id AND i.contract_version = c.contract_version) judged) ranked
      GROUP BY ALL) counted""",
    ),
    "csv_damaged_lines": _emit(f"{_INVOICE_COLUMNS} damaged_line", f"({_DAMAGED}) lines"),
    "folder_load": _emit(f"{_INVOICE_COLUMNS} damaged_line", f"({_DAMAGED}) lines"),
    "key_registry": _emit(
        "source_system natural_id key",
        """(SELECT source_system, natural_id, row_number() OVER (ORDER BY load, source_system, natural_id) AS key
      FROM (SELECT DISTINCT system AS source_system, contract_id AS natural_id,
                   CASE WHEN system = 'erp' AND contract_id % 3 <> 0 THEN 1 ELSE 2 END AS load
            FROM dim_contract, (VALUES ('erp'), ('crm')) systems(system)) loads) keyed""",
    ),
    "true_up_journal": _emit(
        "contract_id contract_version usage_month close_on booked",
        f"""(SELECT *, share - coalesce(earlier, 0) AS booked
      FROM (SELECT *, lag(share) OVER (PARTITION BY contract_id, contract_version, usage_month ORDER BY close_on) AS earlier
            FROM (SELECT u.contract_id, u.contract_version, u.usage_month, c.close_on,
                         {_share("u.total_kw", "t.total_site_kw", "c.total_power_cost")} AS share
                  FROM usage u JOIN site t ON u.usage_month = t.usage_month
                  JOIN closed_cost c ON u.usage_month = c.cost_month) shares) stepped
      WHERE earlier IS NULL OR share <> earlier) journal""",
    ),
    "signoff_dense": _emit("contract_id contract_version month total_kw erp_revenue_total gross_margin", "signed_dense WHERE signed"),
    "signoff_changes": _emit(
        """contract_id contract_version month signed_total_kw signed_erp_revenue_total signed_gross_margin rebuilt_total_kw
        rebuilt_erp_revenue_total rebuilt_gross_margin gross_margin_change""",
        """(SELECT s.contract_id, s.contract_version, s.month, s.total_kw AS signed_total_kw,
             s.erp_revenue_total AS signed_erp_revenue_total, s.gross_margin AS signed_gross_margin, m.total_kw AS rebuilt_total_kw,
             m.erp_revenue_total AS rebuilt_erp_revenue_total, m.gross_margin AS rebuilt_gross_margin,
             m.gross_margin - s.gross_margin AS gross_margin_change
      FROM signed_dense s JOIN mart_corrected m
        ON s.contract_id = m.contract_id AND s.contract_version = m.contract_version AND s.month = m.month
      WHERE s.signed AND (s.total_kw <> m.total_kw OR s.erp_revenue_total <> m.erp_revenue_total OR s.gross_margin <> m.gross_margin)) changed""",
    ),
    "mart_partition_overwrite": _emit(_MART_COLUMNS, "mart"),
    "mart_full_rebuild": _emit(_MART_COLUMNS, "mart_stored"),
    "sql_over_views": _emit(
        "month contract_rows contracts_negative_margin total_site_kw total_power_cost",
        """(SELECT s.*, t.total_site_kw, c.total_power_cost
      FROM summary s JOIN site t ON s.month = t.usage_month LEFT JOIN cost c ON s.month = c.cost_month) joined""",
    ),
    "stream_intake": _emit(
        "reading_id contract_id reading_date used_kw outcome",
        """(SELECT *, 'accepted' AS outcome FROM reading_taken WHERE in_time
      UNION ALL SELECT *, 'too late' AS outcome FROM reading_taken WHERE NOT in_time
      UNION ALL SELECT *, 'too late' AS outcome FROM reading_taken WHERE NOT in_time AND reading_id % 7 = 0) taken""",
    ),
    "stream_usage_daily": _emit(
        "usage_date contract_id readings total_kw peak_kw outcome",
        """(SELECT *, 'closed' AS outcome FROM event_days
      UNION ALL
      SELECT reading_date, contract_id, count(*), sum(used_kw), max(used_kw), 'too late'
      FROM reading_taken WHERE NOT in_time GROUP BY 1, 2) taken""",
    ),
    "stream_day_status": _emit(
        "contract_id contract_version reading_date missing lateness_class",
        """(SELECT d.user_id AS contract_id, 1 AS contract_version, d.day AS reading_date, t.delay IS NULL AS missing,
             CASE WHEN t.delay IS NULL THEN 'estimated' WHEN t.delay > 0 THEN 'late' ELSE 'on_time' END AS lateness_class
      FROM (SELECT user_id, CAST(unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL '1' DAY)) AS DATE) AS day
            FROM event_spans WHERE first_day <= last_day) d
      LEFT JOIN (SELECT contract_id, reading_date, max(reading_id % 11) AS delay FROM reading_taken WHERE in_time GROUP BY 1, 2) t
        ON d.user_id = t.contract_id AND d.day = t.reading_date
      WHERE d.day + INTERVAL '1' DAY <= (SELECT max(reading_date) - INTERVAL '7' DAY FROM reading_taken WHERE in_time)) closed""",
    ),
    "stream_usage_monthly": _emit(
        "contract_id contract_version usage_month total_kw avg_daily_kw peak_kw",
        f"""(SELECT contract_id, 1 AS contract_version, CAST(date_trunc('month', day) AS DATE) AS usage_month,
             sum(kw) AS total_kw, {_average("kw")} AS avg_daily_kw, max(kw) AS peak_kw
      FROM (SELECT *, row_number() OVER (PARTITION BY contract_id, day ORDER BY ts DESC, kw DESC, event_id DESC) AS pos
            FROM event_held WHERE held) ranked
      WHERE pos = 1
      GROUP BY 1, 2, 3) upserted""",
    ),
    "stream_usage_monthly_events": _emit(
        "contract_id contract_version usage_month total_kw avg_daily_kw peak_kw unheld_readings",
        f"""(SELECT contract_id, 1 AS contract_version, CAST(date_trunc('month', day) AS DATE) AS usage_month,
             sum(kw) AS total_kw, {_average("kw")} AS avg_daily_kw, max(kw) AS peak_kw, 0 AS unheld_readings
      FROM (SELECT *, row_number() OVER (PARTITION BY contract_id, day ORDER BY ts DESC, kw DESC, event_id DESC) AS pos
            FROM event_held WHERE held) ranked
      WHERE pos = 1
      GROUP BY 1, 2, 3
      UNION ALL
      SELECT contract_id, NULL, CAST(date_trunc('month', day) AS DATE), NULL, NULL, NULL, count(*)
      FROM event_held WHERE NOT held
      GROUP BY 1, 3) upserted""",
    ),
    "layer_row_counts": _emit(
        "table_name cnt",
        "("
        + " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS cnt FROM {s}" for n, s in _COUNTED.items())
        + ") counts",
    ),
}


def _steps_of(text: str) -> list[str]:
    """Steps the text mentions, each after the ones it needs itself."""
    found: list[str] = []
    for name, body in _STEPS.items():
        if re.search(rf"(?:FROM|JOIN)\s+{name}\b", text):
            for step in (*_steps_of(body), name):
                if step not in found:
                    found.append(step)
    return found


def oracle_sql() -> dict[str, str]:
    statements = {}
    for name, body in _QUERIES.items():
        steps = ",\n".join(f"{step} AS ({_STEPS[step]})" for step in _steps_of(body))
        statements[name] = f"WITH {steps}\n{body}" if steps else body
    return statements
