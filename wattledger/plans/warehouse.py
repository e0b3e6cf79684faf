"""The stored build: sources to curated months to mart to reconciliation, and reruns of single months.

Every step is local to a month, so late data is handled by rebuilding the months it touches. Each fact
is scanned once per build: the mart and the controls read the small monthly tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.operators import allocation, dedupe, exceptions, monthly, reconciliation, windows
from wattledger.operators.mart import mart_contract_monthly
from wattledger.plans.frames import Frames
from wattledger.schemas import (
    COST_JOURNAL,
    DIM_CONTRACT,
    DIM_CUSTOMER,
    ERP_REVENUE_MONTHLY,
    FACT_COST,
    FACT_INVOICE,
    FACT_METER,
    FACT_RACK,
    MART,
    RACK_MONTHLY,
    RECON,
    REPROCESSED,
    SIGNOFF_LOCK,
    USAGE_MONTHLY,
)
from wattledger.sources.driver_tables import DerivedTables, SourceTables
from wattledger.sources.layers import LayerStore, touched_months


def load_sources(store: LayerStore, tables: SourceTables | DerivedTables) -> None:
    """First load. It replaces what it writes, so a load that failed half way is simply run again; appending
    invoice lines twice would bill them twice.

    Only declared columns are stored, so equal arrival times are told apart by the readings' own values.
    """
    store.create()
    store.overwrite(tables.customers, DIM_CUSTOMER)
    store.overwrite(tables.contracts, DIM_CONTRACT)
    store.overwrite(tables.power_cost, FACT_COST)
    store.overwrite(tables.meter, FACT_METER, dealt=False)
    store.overwrite(tables.racks, FACT_RACK, dealt=False)
    store.overwrite(tables.invoices, FACT_INVOICE, dealt=False)


def build_usage(store: LayerStore, months: Sequence[date] | None = None) -> None:
    meter = dedupe.latest_in_months(store.read(FACT_METER, months), "reading_date")
    effective = windows.effective_meter(meter, store.read(DIM_CONTRACT))
    store.overwrite(monthly.usage_monthly(effective), USAGE_MONTHLY, months)


def build_rack_usage(store: LayerStore, months: Sequence[date] | None = None) -> None:
    racks = dedupe.latest_in_months(store.read(FACT_RACK, months), "usage_date")
    effective = windows.effective_racks(racks, store.read(DIM_CONTRACT))
    store.overwrite(monthly.rack_monthly(effective), RACK_MONTHLY, months)


def build_revenue(store: LayerStore, months: Sequence[date] | None = None) -> None:
    store.overwrite(monthly.erp_revenue_monthly(store.read(FACT_INVOICE, months)), ERP_REVENUE_MONTHLY, months)


def mart_rows(store: LayerStore, months: Sequence[date] | None = None) -> DataFrame:
    """The mart as the stored months make it."""
    return mart_contract_monthly(
        store.read(USAGE_MONTHLY, months),
        store.read(DIM_CONTRACT),
        store.read(RACK_MONTHLY, months),
        store.read(ERP_REVENUE_MONTHLY, months),
        store.read(FACT_COST),
    )


def build_mart(store: LayerStore, months: Sequence[date] | None = None) -> None:
    store.overwrite(mart_rows(store, months), MART, months)


def build_recon(store: LayerStore, reconciled_at: Column | None = None) -> None:
    """Billed months come from the stored contract-months, whose sums are those of the lines."""
    billed = store.read(ERP_REVENUE_MONTHLY).withColumnRenamed("erp_revenue_total", "amount")
    recon = reconciliation.recon_erp_vs_mart_monthly(billed, store.read(MART), reconciled_at)
    store.overwrite(recon, RECON)


def build(store: LayerStore, reconciled_at: Column | None = None) -> None:
    build_usage(store)
    build_rack_usage(store)
    build_revenue(store)
    build_mart(store)
    build_recon(store, reconciled_at)


def _stamped(rows: DataFrame, reprocessed_at: Column | None) -> DataFrame:
    at = F.current_timestamp() if reprocessed_at is None else reprocessed_at
    return rows.withColumn(REPROCESSED, at.cast("timestamp_ntz"))


def backfill(
    store: LayerStore,
    late_readings: DataFrame,
    reconciled_at: Column | None = None,
    reprocessed_at: Column | None = None,
) -> list[date]:
    """Takes in late readings, stamped with the time of the rerun, and rebuilds the months they touch.

    The raw table only grows. A rerun after a failure may append the same readings again; the latest
    record per day absorbs copies, so the rebuilt months are the same. The months are those that were
    written: a source that grows meanwhile cannot leave one out.
    """
    months = store.append(_stamped(late_readings, reprocessed_at), FACT_METER)
    if months:
        build_usage(store, months)
        build_mart(store, months)
        build_recon(store, reconciled_at)
    return months


def backfill_racks(
    store: LayerStore, late_counts: DataFrame, reconciled_at: Column | None = None, reprocessed_at: Column | None = None
) -> list[date]:
    """The same for rack counts."""
    months = store.append(_stamped(late_counts, reprocessed_at), FACT_RACK)
    if months:
        build_rack_usage(store, months)
        build_mart(store, months)
        build_recon(store, reconciled_at)
    return months


def backfill_invoices(
    store: LayerStore, lines: DataFrame, reconciled_at: Column | None = None, reprocessed_at: Column | None = None
) -> list[date]:
    """Takes in late and corrected invoice lines and rebuilds the months they touch.

    A line replaces the stored one of its key, also where it moved to another month; appending it would
    bill it twice. Only months that hold such lines, before or after, are read and written again. A line
    given twice counts once.
    """
    key = list(FACT_INVOICE.key)
    lines = _stamped(lines.dropDuplicates(key), reprocessed_at)
    stored = store.read(FACT_INVOICE, audit=True)
    moved = stored.join(lines.select(*key), key, "left_semi")
    months = sorted(touched_months(moved.select("invoice_month").unionByName(lines.select("invoice_month")), "invoice_month"))
    if months:
        kept = store.read(FACT_INVOICE, months, audit=True).join(lines.select(*key), key, "left_anti")
        store.overwrite(kept.unionByName(lines.select(*kept.columns)), FACT_INVOICE, months)
        build_revenue(store, months)
        build_mart(store, months)
        build_recon(store, reconciled_at)
    return months


def book_close(store: LayerStore, snapshot: DataFrame) -> None:
    """Books what the cost known at a close changes in the journal; run again it books nothing."""
    store.append(allocation.journal_entries(store.read(USAGE_MONTHLY), snapshot, store.read(COST_JOURNAL)), COST_JOURNAL)


def sign_off(store: LayerStore, signed: DataFrame) -> None:
    """Locks the contract-months that may be signed off and are not yet."""
    store.append(exceptions.newly_signed(signed, store.read(SIGNOFF_LOCK)), SIGNOFF_LOCK)


class StoredFrames(Frames):
    """The layers as read back from a store: reports and views over it scan stored months, not raw facts."""

    def __init__(self, store: LayerStore):
        self.store = store
        super().__init__(
            SourceTables(
                customers=store.read(DIM_CUSTOMER),
                contracts=store.read(DIM_CONTRACT),
                meter=store.read(FACT_METER),
                racks=store.read(FACT_RACK),
                invoices=store.read(FACT_INVOICE),
                power_cost=store.read(FACT_COST),
            )
        )

    @cached_property
    def usage(self) -> DataFrame:
        return self.store.read(USAGE_MONTHLY)

    @cached_property
    def rack_usage(self) -> DataFrame:
        return self.store.read(RACK_MONTHLY)

    @cached_property
    def erp_revenue(self) -> DataFrame:
        return self.store.read(ERP_REVENUE_MONTHLY)

    @cached_property
    def mart(self) -> DataFrame:
        return self.store.read(MART)

    @cached_property
    def recon(self) -> DataFrame:
        return self.store.read(RECON)
