"""Every registered query: its name and the plan behind it, over the tables of one directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions.expressions import customer_label, month_end, month_floor
from wattledger.operators import (
    allocation,
    calendar,
    dedupe,
    exceptions,
    integrity,
    leakage,
    mart,
    monthly,
    reconciliation,
    windows,
)
from wattledger.plans import warehouse
from wattledger.plans.frames import Frames, presented
from wattledger.schemas import (
    COST_JOURNAL,
    DIM_CONTRACT,
    ERP_REVENUE_MONTHLY,
    FACT_COST,
    FACT_INVOICE,
    FACT_METER,
    MART,
    RACK_MONTHLY,
    SIGNOFF_LOCK,
    USAGE_MONTHLY,
    Table,
)
from wattledger.session import bound_tasks, split_hot_keys
from wattledger.sources import admission, arrivals, driver_tables
from wattledger.sources.files import own_dir, read_csv, size_of, write_csv
from wattledger.sources.layers import LayerStore, touched_months
from wattledger.sources.ledger import LedgerStore
from wattledger.sources.registry import KeyRegistry
from wattledger.streaming import intake

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of two queries, repeated in their SQL: the rerun's time and the share of cost known early.
REPROCESSED_AT = "2002-01-01 00:00:00"
ESTIMATED_COST_SHARE = "0.95"


def _source_frames(f: Frames) -> dict[str, DataFrame]:
    t = f.tables
    return {
        "dim_customer": t.customers,
        "dim_contract": t.contracts,
        "fact_meter_power_daily": t.meter,
        "fact_rack_utilization_daily": t.racks,
        "fact_invoice_line": t.invoices,
        "fact_power_cost_monthly": t.power_cost,
    }


def _layer_counts(f: Frames) -> DataFrame:
    return integrity.layer_row_counts(
        {
            "v_meter_power_daily_effective": f.effective_meter,
            "v_rack_utilization_daily_effective": f.effective_racks,
            "v_usage_monthly": f.usage,
            "v_rack_monthly": f.rack_usage,
            "v_erp_revenue_monthly": f.erp_revenue,
            "v_power_cost_monthly": f.power_cost,
            "mart_contract_monthly": f.mart,
        }
    )


def _altered(rows: DataFrame) -> DataFrame:
    """A mart as faults leave it: every third contract lost in February, May doubled, July priced up."""
    month = F.month("month")
    kept = rows.where((month != 2) | (F.col("contract_id") % 3 != 0))
    priced = kept.withColumn("erp_revenue_total", F.col("erp_revenue_total") + F.when(month == 7, F.lit("99.00").cast("decimal(4,2)")).otherwise(F.lit(0).cast("decimal(4,2)")))
    copies = F.explode(F.sequence(F.lit(1), F.when(month == 5, 2).otherwise(1)))
    return priced.withColumn("copy", copies).drop("copy")


def _altered_controls(f: Frames) -> DataFrame:
    """The reconciliation of a mart with faults: their months leave the tolerance."""
    return reconciliation.recon_erp_vs_mart_monthly(f.tables.invoices, _altered(f.mart)).drop("last_reconciled_at")


def _ledger_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored layers against the ledger of their writes, after the mart was altered behind its back."""
    f, query = Frames.from_dir(spark, sf_dir), "layer_ledger_check"
    store = LedgerStore(spark, own_dir(spark, query), prefix=f"run_{query}_", wide=True)
    store.drop()
    written = {DIM_CONTRACT: f.tables.contracts, FACT_COST: f.tables.power_cost, USAGE_MONTHLY: f.usage, RACK_MONTHLY: f.rack_usage, ERP_REVENUE_MONTHLY: f.erp_revenue}
    store.create([*written, MART])
    for table, rows in written.items():
        store.overwrite(rows, table)
    warehouse.build_mart(store)
    behind = LayerStore(spark, store.root, prefix=store.prefix, wide=True)
    touched = [m for m in touched_months(store.read(MART), "month") if m.month in (2, 5, 7)]
    behind.overwrite(_altered(warehouse.mart_rows(store, touched)), MART, touched)
    return presented(store.check([*written, MART]))


def _surrogate_keys(f: Frames) -> DataFrame:
    """Two source systems that use the same contract and customer ids."""
    contracts = f.tables.contracts
    both = contracts.withColumn("system", F.explode(F.array(F.lit("erp"), F.lit("crm"))))
    return dedupe.with_surrogate_keys(both, F.col("system"))


def _posting_against_month_end(f: Frames) -> DataFrame:
    """Lines by the days from their posting to the end of the month they are booked in."""
    closes = month_end(F.col("invoice_month"))
    return f.tables.invoices.select(
        "invoice_id", "invoice_line_id", "posting_date", closes.alias("closes_on"), F.datediff(closes, "posting_date").alias("days_to_close")
    )


def _backfill(f: Frames) -> DataFrame:
    """Readings that came on time, with the ones that came late merged in."""
    came_late = F.col("ingested_at").cast("date") > F.col("reading_date")
    return dedupe.backfill_merge(
        f.tables.meter.where(~came_late), f.tables.meter.where(came_late), F.lit(REPROCESSED_AT)
    )


def _true_up(f: Frames) -> DataFrame:
    """Flagged months were first booked at part of their actual cost."""
    actual = f.tables.power_cost
    early = (F.col("total_power_cost") * F.lit(ESTIMATED_COST_SHARE).cast("decimal(3,2)")).cast("decimal(20,2)")
    estimated = actual.withColumn(
        "total_power_cost", F.when(F.col("true_up_flag"), early).otherwise(F.col("total_power_cost"))
    )
    return allocation.true_up_delta(f.usage, estimated, actual)


def _recon(f: Frames) -> DataFrame:
    return reconciliation.controls_data_integrity(f.recon).drop("last_reconciled_at")


def _misfiled(spark: SparkSession, sf_dir: str) -> tuple[Frames, DataFrame]:
    return Frames.from_dir(spark, sf_dir), driver_tables.invoices(spark, sf_dir, misfiled=True)


def _root_cause(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, lines = _misfiled(spark, sf_dir)
    return presented(reconciliation.variance_root_cause(lines, f.tables.contracts, f.usage))


def _stale_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, lines = _misfiled(spark, sf_dir)
    return presented(leakage.stale_version_billing(lines, f.tables.contracts))


def _through_csv(df: DataFrame, table: Table, spark: SparkSession) -> DataFrame:
    path = f"{own_dir(spark, f'csv_{table.name}')}/{table.name}.csv"
    write_csv(df, path)
    return read_csv(spark, path, table)


def _csv_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract dimension, bits included, written as CSV and read back."""
    return presented(_through_csv(driver_tables.contracts(spark, sf_dir), DIM_CONTRACT, spark))


def _csv_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(_through_csv(driver_tables.invoices(spark, sf_dir), FACT_INVOICE, spark))


def _overlapping(spark: SparkSession, sf_dir: str) -> tuple[Frames, DataFrame]:
    return Frames.from_dir(spark, sf_dir), driver_tables.contracts(spark, sf_dir, overlapping=True)


def _tangled_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(windows.version_windows(driver_tables.tangled_windows(spark, sf_dir)))


def _reattribution_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, contracts = _overlapping(spark, sf_dir)
    return presented(windows.reattributed_readings(f.latest_meter, contracts))


def _stale_mid_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both versions are billable in the month of the amendment, and while they overlap."""
    _, contracts = _overlapping(spark, sf_dir)
    return presented(leakage.stale_version_billing(driver_tables.invoices(spark, sf_dir, misfiled=True), contracts))


def _store(spark: SparkSession, query: str) -> LayerStore:
    """A store of the query's own, in a folder and databases that its next run replaces."""
    store = LayerStore(spark, own_dir(spark, query), prefix=f"run_{query}_", wide=True)
    store.drop()
    return store


def _table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meter readings appended to their typed table in two loads, the late ones second."""
    store, meter = _store(spark, "table_append_load"), driver_tables.meter(spark, sf_dir)
    store.create([FACT_METER])
    came_late = F.col("ingested_at").cast("date") > F.col("reading_date")
    store.append(meter.where(~came_late), FACT_METER)
    store.append(meter.where(came_late), FACT_METER)
    return presented(store.read(FACT_METER))


def _faulty_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines, some without an amount, some of a contract nobody knows; many share a key as they come."""
    lines = driver_tables.invoices(spark, sf_dir)
    return lines.withColumns(
        {
            "amount": F.when(F.col("invoice_id") % 89 != 0, F.col("amount")),
            "contract_id": F.col("contract_id") + F.when(F.col("invoice_id") % 101 == 0, 1_000_000_000).otherwise(0),
        }
    )


def _load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of faulty lines: those published, without a reason, and those refused, with one."""
    root = own_dir(spark, "load_audit")
    store = LayerStore(spark, f"{root}/store", prefix="run_load_audit_", wide=True)
    store.drop()
    store.create([FACT_INVOICE])
    contracts = driver_tables.contracts(spark, sf_dir)
    admission.admit(store, _faulty_invoices(spark, sf_dir), FACT_INVOICE, {"dim_contract": contracts}, f"{root}/staged")
    published = store.read(FACT_INVOICE).withColumn("copies", F.lit(1).cast("long")).withColumn("reason", F.lit(None).cast("string"))
    return presented(published.unionByName(admission.quarantine(store, f"{root}/staged")))


def _damaged_lines(lines: DataFrame) -> DataFrame:
    """Invoice lines as text, some with an amount that is none, some cut short."""
    whole = F.concat_ws(",", *[F.col(c).cast("string") for c in FACT_INVOICE.schema.names])
    spoilt = F.concat(F.substring_index(whole, ",", 7), F.lit(",n/a"))
    kind = F.col("invoice_id") % 97
    return lines.select(F.when(kind == 0, spoilt).when(kind == 1, F.substring_index(whole, ",", 4)).otherwise(whole).alias("value"))


def _dropped(lines: DataFrame, path: str) -> None:
    """Files with a header, as another system drops them."""
    header = ",".join(FACT_INVOICE.schema.names)
    # Another separator, which no line holds, writes a line as it is.
    lines.select(F.col("value").alias(header)).write.option("header", True).option("sep", "\x01").csv(path)


def _csv_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed lines, and the text of those that are damaged."""
    path = f"{own_dir(spark, 'csv_damaged_lines')}/lines"
    _dropped(_damaged_lines(driver_tables.invoices(spark, sf_dir)), path)
    return presented(arrivals.read_lines(spark, path, FACT_INVOICE, wide=True))


def _folder_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files loaded as they are dropped: two folders, a load after each, and one that finds nothing new."""
    root = own_dir(spark, "folder_load")
    lines = driver_tables.invoices(spark, sf_dir)
    for name, part in (("first", lines.where("invoice_id % 2 = 0")), ("second", lines.where("invoice_id % 2 = 1"))):
        _dropped(_damaged_lines(part), f"{root}/dropped/{name}")
        for _ in range(2 if name == "second" else 1):
            arrivals.load_new_files(spark, f"{root}/dropped/*", FACT_INVOICE, f"{root}/loaded", wide=True)
    return presented(arrivals.loaded(spark, f"{root}/loaded"))


def _key_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of two loads, the second with all pairs of the first and those of another system."""
    registry = KeyRegistry(spark, own_dir(spark, "key_registry"))
    ids = driver_tables.contracts(spark, sf_dir).select(F.col("contract_id").alias("natural_id"))
    registry.register(ids.where("natural_id % 3 <> 0").withColumn("source_system", F.lit("erp")))
    registry.register(ids.withColumn("source_system", F.explode(F.array(F.lit("erp"), F.lit("crm")))))
    return presented(registry.keys())


#: Days after the end of a month at which its cost is closed; the last one knows all of it.
CLOSES = (5, 20, 60)


def _cost_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost booked at three closes as it became known, the second of them run twice."""
    store, f = _store(spark, "true_up_journal"), Frames.from_dir(spark, sf_dir)
    store.create([USAGE_MONTHLY, COST_JOURNAL])
    store.overwrite(f.usage, USAGE_MONTHLY)
    known = driver_tables.cost_versions(spark, sf_dir)
    for days in (CLOSES[0], CLOSES[1], CLOSES[1], CLOSES[2]):
        warehouse.book_close(store, allocation.cost_as_of(known, driver_tables.closes(spark, sf_dir, days)))
    return presented(store.read(COST_JOURNAL))


def _dense(spark: SparkSession, sf_dir: str, corrected: bool = False) -> Frames:
    """Frames over readings of every day for every tenth contract."""
    t = Frames.from_dir(spark, sf_dir).tables
    meter = driver_tables.dense_meter(spark, sf_dir, corrected)
    return Frames(driver_tables.SourceTables(t.customers, t.contracts, meter, t.racks, t.invoices, t.power_cost))


def _signoff_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _dense(spark, sf_dir)
    return presented(exceptions.signoff_set(f.mart, f.lateness))


def _signoff_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readings corrected after the sign-off would change in contract-months that are signed."""
    store, f = _store(spark, "signoff_changes"), _dense(spark, sf_dir)
    store.create([SIGNOFF_LOCK])
    warehouse.sign_off(store, exceptions.signoff_set(f.mart, f.lateness))
    return presented(exceptions.lock_conflicts(store.read(SIGNOFF_LOCK), _dense(spark, sf_dir, corrected=True).mart))


def _mart_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart built from stored months and written twice, the second time month by month over the first."""
    store, f = _store(spark, "mart_partition_overwrite"), Frames.from_dir(spark, sf_dir)
    store.create([DIM_CONTRACT, FACT_COST, USAGE_MONTHLY, RACK_MONTHLY, ERP_REVENUE_MONTHLY, MART])
    monthly_frames = {USAGE_MONTHLY: f.usage, RACK_MONTHLY: f.rack_usage, ERP_REVENUE_MONTHLY: f.erp_revenue}
    for table, rows in {DIM_CONTRACT: f.tables.contracts, FACT_COST: f.tables.power_cost, **monthly_frames}.items():
        store.overwrite(rows, table)
    warehouse.build_mart(store)
    warehouse.build_mart(store, touched_months(store.read(MART), "month"))
    return presented(store.read(MART))


def _mart_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart of a store that held ten more years before: a full load and build leave nothing of them."""
    store, t = _store(spark, "mart_full_rebuild"), Frames.from_dir(spark, sf_dir).tables
    later = lambda day: F.add_months(day, 120).alias(day)
    shifted = t.meter.select(*[later(c) if c == "reading_date" else c for c in t.meter.columns])
    larger = driver_tables.SourceTables(
        customers=t.customers,
        contracts=t.contracts.withColumn("effective_end", F.add_months("effective_end", 120)),
        meter=t.meter.unionByName(shifted),
        racks=t.racks,
        invoices=t.invoices,
        power_cost=t.power_cost,
    )
    for tables in (larger, t):
        warehouse.load_sources(store, tables)
        warehouse.build(store)
    return presented(store.read(MART))


def _sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The named views queried as SQL."""
    Frames.from_dir(spark, sf_dir).register_views()
    return presented(
        spark.sql(
            """
            SELECT s.month, s.contract_rows, s.contracts_negative_margin, t.total_site_kw, c.total_power_cost
            FROM v_controls_summary s
            JOIN v_total_usage_monthly t ON s.month = t.usage_month
            LEFT JOIN v_power_cost_monthly c ON s.month = c.cost_month
            """
        )
    )


def _stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily usage as the stream closes it, with what came too late for its day; days inside the last week of
    the input are still open."""
    root = own_dir(spark, "stream_usage_daily")
    readings = intake.as_readings(intake.event_stream(spark, sf_dir), arriving_late=True)
    intake.run_daily_usage(readings, f"{root}/daily", f"{root}/late", f"{root}/state")
    closed = spark.read.schema(intake.DAILY_USAGE).parquet(f"{root}/daily").withColumn("outcome", F.lit("closed"))
    late = (
        spark.read.schema(intake.READINGS).parquet(f"{root}/late")
        .groupBy(F.col("reading_date").alias("usage_date"), "contract_id")
        .agg(F.count("*").alias("readings"), F.sum("used_kw").alias("total_kw"), F.max("used_kw").alias("peak_kw"))
    )
    return presented(closed.unionByName(late.withColumn("outcome", F.lit("too late"))))


def _stream_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the events' contracts that the stream has closed: on time, late, or estimated for want of a reading."""
    root = own_dir(spark, "stream_day_status")
    readings = intake.as_readings(intake.event_stream(spark, sf_dir), arriving_late=True)
    intake.run_closed_days(readings, intake.event_versions(_events(spark, sf_dir)), f"{root}/days", f"{root}/late", f"{root}/state")
    return presented(spark.read.schema(intake.DAY_STATUS).parquet(f"{root}/days"))


def _stream_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as the intake takes them, every seventh delivered twice, with those that came too late."""
    root = own_dir(spark, "stream_intake")
    events = intake.event_stream(spark, sf_dir)
    twice = events.unionByName(events.where("event_id % 7 = 0"))
    intake.run_intake(intake.as_readings(twice, arriving_late=True), f"{root}/in", f"{root}/late", f"{root}/state")
    kept = {name: spark.read.schema(intake.READINGS).parquet(f"{root}/{name}") for name in ("in", "late")}
    # The side table holds deliveries as they came, the intake each reading once.
    return presented(
        kept["in"].withColumn("outcome", F.lit("accepted")).unionByName(kept["late"].withColumn("outcome", F.lit("too late")))
        .select("reading_id", "contract_id", "reading_date", "used_kw", "outcome")
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(intake.EVENTS).option("pathGlobFilter", "events*.parquet").parquet(sf_dir)


def _upserted(spark: SparkSession, sf_dir: str, query: str) -> str:
    """The folder of the months that two feeds keep current, one after the other: the second corrects days
    and months that the first has already published."""
    root = own_dir(spark, query)
    contracts = intake.event_versions(_events(spark, sf_dir))
    for feed, part in (("odd", "event_id % 2 = 1"), ("even", "event_id % 2 = 0 OR event_id IS NULL")):
        readings = intake.as_readings(intake.event_stream(spark, sf_dir).where(part))
        intake.run_month_upsert(readings, contracts, f"{root}/months", f"{root}/state_{feed}", feed).awaitTermination()
    return f"{root}/months"


_MONTHS = ("contract_id", "contract_version", "usage_month", "total_kw", "avg_daily_kw", "peak_kw")


def _stream_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly usage of all users and years of the events, kept current by the stream's upsert."""
    return presented(intake.usage_months(spark, _upserted(spark, sf_dir, "stream_usage_monthly")).select(*_MONTHS))


def _stream_months_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a count for each contract-month of the readings no version holds."""
    root = _upserted(spark, sf_dir, "stream_usage_monthly_events")
    held = intake.usage_months(spark, root).select(*_MONTHS, F.lit(0).cast("long").alias("unheld_readings"))
    unheld = (
        intake.unheld_readings(spark, root)
        .groupBy("contract_id", month_floor(F.col("reading_date")).alias("usage_month"))
        .agg(F.count(F.lit(1)).alias("unheld_readings"))
    )
    return presented(held.unionByName(unheld, allowMissingColumns=True))


# Queries over the composed frames of one directory.
_PLANS: dict[str, Callable[[Frames], DataFrame]] = {
    # curated
    "latest_reading": lambda f: f.latest_meter,
    "effective_meter": lambda f: f.effective_meter,
    "effective_rack": lambda f: f.effective_racks,
    "rejected_readings": lambda f: windows.rejected_readings(f.latest_meter, f.tables.contracts),
    "version_reattribution": lambda f: windows.reattributed_readings(f.latest_meter, f.tables.contracts),
    "version_windows": lambda f: windows.version_windows(f.tables.contracts),
    "missing_readings": lambda f: calendar.missing_readings(f.effective_meter, f.tables.contracts),
    "lateness_class": lambda f: f.lateness,
    "backfill_merge": _backfill,
    "surrogate_keys": _surrogate_keys,
    "customer_labels": lambda f: f.tables.customers.select(
        "customer_id", customer_label(F.col("customer_id")).alias("customer_label"), "industry"
    ),
    "active_contract_months": lambda f: calendar.active_contract_months(f.tables.contracts).select(
        "contract_id", "contract_version", "customer_id", "month"
    ),
    "usage_monthly": lambda f: f.usage,
    "rack_monthly": lambda f: f.rack_usage,
    "erp_revenue_monthly": lambda f: f.erp_revenue,
    "power_cost_monthly": lambda f: f.power_cost,
    # mart
    "total_usage_monthly": lambda f: f.total_usage,
    "power_cost_allocated": lambda f: f.allocated_cost,
    "mart_contract_monthly": lambda f: f.mart,
    "contract_mrr": lambda f: f.contract_mrr,
    "customer_monthly": lambda f: mart.customer_monthly(f.mart, f.tables.contracts, f.tables.customers),
    "contract_utilization": lambda f: mart.contract_utilization(f.mart),
    "clamped_utilization": lambda f: mart.clamped_utilization(mart.contract_utilization(f.mart)),
    "monthly_trend": lambda f: mart.monthly_trend(f.mart),
    "true_up_delta": _true_up,
    "estimated_share": lambda f: monthly.usage_quality_monthly(f.effective_meter),
    # controls
    "controls_data_integrity": _recon,
    "contract_variance_monthly": lambda f: exceptions.contract_variance_monthly(f.mart),
    "contract_exception_reason": lambda f: exceptions.contract_exception_reason(f.mart),
    "exception_counts": lambda f: exceptions.exception_counts(f.mart),
    "exceptions_only": lambda f: exceptions.exceptions_only(f.mart),
    "controls_summary": lambda f: exceptions.controls_summary(f.mart),
    "negative_margin": lambda f: exceptions.negative_margin(f.mart),
    "signoff_set": lambda f: exceptions.signoff_set(f.mart, f.lateness),
    "signoff_share": lambda f: exceptions.signoff_share(f.mart, f.lateness),
    "top_recent_contracts": lambda f: exceptions.recent_contracts(f.mart, 10),
    "top_exceptions": lambda f: exceptions.recent_contracts(exceptions.exceptions_only(f.mart), 20),
    "top_controls_integrity": lambda f: exceptions.latest_months(_recon(f), 12),
    "top_controls_summary": lambda f: exceptions.latest_months(exceptions.controls_summary(f.mart), 12),
    "mrr_vs_invoiced": lambda f: reconciliation.mrr_vs_invoiced(f.contract_mrr, f.erp_revenue),
    "amendments": lambda f: windows.amendments(f.tables.contracts),
    "unbilled_spikes": lambda f: leakage.unbilled_spikes(f.usage, f.erp_revenue, f.tables.contracts),
    "disallowed_overage": lambda f: leakage.disallowed_overage(f.tables.invoices, f.tables.contracts),
    # integrity
    "pk_violations": lambda f: integrity.primary_key_violations(_source_frames(f)),
    "fk_violations": lambda f: integrity.foreign_key_violations(_source_frames(f)),
    "not_null_violations": lambda f: integrity.not_null_violations(_source_frames(f)),
    "null_risk": lambda f: integrity.null_risk(f.mart),
    "layer_row_counts": _layer_counts,
    "controls_of_altered_mart": _altered_controls,
    "posting_month_end": _posting_against_month_end,
}


def _over_frames(plan: Callable[[Frames], DataFrame]) -> Query:
    return lambda spark, sf_dir: presented(plan(Frames.from_dir(spark, sf_dir)))


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        split_hot_keys(spark)
        bound_tasks(spark, size_of(spark, sf_dir))
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    registered = {name: _over_frames(plan) for name, plan in _PLANS.items()}
    registered["variance_root_cause"] = _root_cause
    registered["stale_version_billing"] = _stale_versions
    registered["stale_version_mid_month"] = _stale_mid_month
    registered["version_reattribution_overlap"] = _reattribution_overlap
    registered["version_windows_tangled"] = _tangled_windows
    # files, tables and views
    registered["csv_contracts"] = _csv_contracts
    registered["csv_invoice_lines"] = _csv_invoices
    registered["table_append_load"] = _table_append
    registered["load_audit"] = _load_audit
    registered["csv_damaged_lines"] = _csv_damaged
    registered["folder_load"] = _folder_load
    registered["key_registry"] = _key_registry
    registered["true_up_journal"] = _cost_journal
    registered["signoff_dense"] = _signoff_dense
    registered["signoff_changes"] = _signoff_changes
    registered["mart_partition_overwrite"] = _mart_overwrite
    registered["mart_full_rebuild"] = _mart_rebuild
    registered["layer_ledger_check"] = _ledger_check
    registered["sql_over_views"] = _sql_over_views
    # streams
    registered["stream_intake"] = _stream_intake
    registered["stream_usage_daily"] = _stream_daily
    registered["stream_day_status"] = _stream_days
    registered["stream_usage_monthly"] = _stream_months
    registered["stream_usage_monthly_events"] = _stream_months_events
    return {name: _prepared(query) for name, query in registered.items()}
