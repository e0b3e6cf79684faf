"""The layers as lazy frames: source tables in, every curated, mart and control frame on demand."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.operators import allocation, calendar, dedupe, exceptions, mart, monthly, reconciliation, windows
from wattledger.sources.driver_tables import DerivedTables, SourceTables


class Frames:
    """Composes the operators over one set of source tables.

    Nothing is computed here. Usage feeds both the rows and the site totals of the mart; the two share
    one deduplication shuffle, as long as a plan reads the same columns of both.
    """

    def __init__(self, tables: SourceTables | DerivedTables):
        self.tables = tables

    @classmethod
    def from_dir(cls, spark: SparkSession, sf_dir: str) -> Frames:
        return cls(DerivedTables(spark, sf_dir))

    @cached_property
    def latest_meter(self) -> DataFrame:
        return dedupe.latest_readings(self.tables.meter)

    @cached_property
    def effective_meter(self) -> DataFrame:
        return windows.effective_meter(self.latest_meter, self.tables.contracts)

    @cached_property
    def effective_racks(self) -> DataFrame:
        return windows.effective_racks(dedupe.latest_rack_counts(self.tables.racks), self.tables.contracts)

    @cached_property
    def usage(self) -> DataFrame:
        return monthly.usage_monthly(self.effective_meter)

    @cached_property
    def rack_usage(self) -> DataFrame:
        return monthly.rack_monthly(self.effective_racks)

    @cached_property
    def erp_revenue(self) -> DataFrame:
        return monthly.erp_revenue_monthly(self.tables.invoices)

    @cached_property
    def power_cost(self) -> DataFrame:
        return monthly.power_cost_monthly(self.tables.power_cost)

    @cached_property
    def total_usage(self) -> DataFrame:
        return allocation.total_usage_monthly(self.usage)

    @cached_property
    def allocated_cost(self) -> DataFrame:
        return allocation.power_cost_allocated(self.usage, self.tables.power_cost)

    @cached_property
    def mart(self) -> DataFrame:
        return mart.mart_contract_monthly(
            self.usage, self.tables.contracts, self.rack_usage, self.erp_revenue, self.tables.power_cost
        )

    @cached_property
    def contract_mrr(self) -> DataFrame:
        return calendar.contract_mrr(self.tables.contracts)

    @cached_property
    def recon(self) -> DataFrame:
        """The invoice lines against the mart. The lines are read by themselves, so that no step between them
        and the mart can hide its own faults; grouped by month they are a few rows for each task."""
        return reconciliation.recon_erp_vs_mart_monthly(self.tables.invoices, self.mart)

    @cached_property
    def lateness(self) -> DataFrame:
        return calendar.lateness_classes(self.effective_meter, self.tables.contracts)

    def named_views(self) -> dict[str, DataFrame]:
        """The published view names and what stands behind them."""
        return {
            "v_meter_power_daily_effective": self.effective_meter,
            "v_rack_utilization_daily_effective": self.effective_racks,
            "v_usage_monthly": self.usage,
            "v_rack_monthly": self.rack_usage,
            "v_erp_revenue_monthly": self.erp_revenue,
            "v_power_cost_monthly": self.power_cost,
            "v_total_usage_monthly": self.total_usage,
            "v_power_cost_allocated": self.allocated_cost,
            "v_controls_data_integrity": reconciliation.controls_data_integrity(self.recon),
            "v_contract_variance_monthly": exceptions.contract_variance_monthly(self.mart),
            "v_contract_exception_reason": exceptions.contract_exception_reason(self.mart),
            "v_contract_exceptions_only": exceptions.exceptions_only(self.mart),
            "v_controls_summary": exceptions.controls_summary(self.mart),
        }

    def register_views(self) -> list[str]:
        """Makes every view available to ``spark.sql``; Catalyst inlines them as usual.

        Temporary views of the same names in this session are replaced; ``spark.newSession()`` keeps them apart.
        """
        views = self.named_views()
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return list(views)


def presented(df: DataFrame) -> DataFrame:
    """Plain result types for readers outside Spark: money as double, counts and flags as bigint."""

    def plain(name: str, kind: str):
        column = F.col(name)
        if kind.startswith("decimal"):
            return column.cast("double").alias(name)
        if kind in ("int", "smallint", "tinyint", "boolean"):
            return column.cast("bigint").alias(name)
        if kind.startswith("timestamp"):
            return column.cast("string").alias(name)
        return column

    return df.select(*[plain(name, kind) for name, kind in df.dtypes])
