"""A store that keeps a ledger of its writes, and checks its layers against it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.operators.integrity import control_sum, control_totals, ledger_check
from wattledger.schemas import ALL_TABLES, LAYER_LEDGER, Table
from wattledger.sources.layers import LayerStore

_Totals = dict[date | None, tuple[int, Decimal]]


class WriteMismatch(RuntimeError):
    """A table does not hold what was written to it."""


class LedgerStore(LayerStore):
    """Tables whose rows and control sums are counted as they are written, and recorded by month.

    Rows are observed on their way into a table. The months that were written are read back at once and must
    hold what was observed, for an append on top of what was recorded (``WriteMismatch`` otherwise); then they
    are entered in ``recon.layer_ledger``, where the last entry of a month counts. What changes a table behind
    the store's back, such as a lost file, a load run twice by hand or an amount edited in place, shows in
    ``check``.

    An entry is a row for each month of a write, so the ledger is bounded by the calendar and not by the data.
    Tables without control columns are checked by their rows. A store has one writer at a time.
    """

    def create(self, tables: Sequence[Table] = ALL_TABLES) -> None:
        super().create([*tables, *([] if LAYER_LEDGER in tables else [LAYER_LEDGER])])

    def _metrics(self, table: Table) -> list[Column]:
        return [*super()._metrics(table), control_sum(table.control).alias("total")]

    def _wrote(self, table: Table, seen: dict, months: Sequence[date] | None, replaced: bool) -> None:
        if table is LAYER_LEDGER:
            return
        recorded = self._by_month(self.recorded().where(F.col("table_name") == table.name))
        whole = replaced and months is None
        touched = None if whole or not table.month_column else sorted({*(months or ()), *seen["months"]})
        holds = self._by_month(self._totals(table, touched))
        entered: _Totals = {m: holds.get(m, (0, Decimal(0))) for m in (touched if touched is not None else {*holds, *(recorded if whole else ())})}
        before = [] if replaced else [recorded[m] for m in entered if m in recorded]
        for part, name in enumerate(("rows", "total")):
            expected = (seen[name] or 0) + sum(t[part] for t in before)
            if sum(t[part] for t in entered.values()) != expected:
                raise WriteMismatch(f"{table.name}: {name} of the months written are not {expected}")
        number = (self.read(LAYER_LEDGER).agg(F.max("write_id")).first()[0] or 0) + 1
        rows = [(table.name, m, n, total, number) for m, (n, total) in entered.items()]
        self.append(self.spark.createDataFrame(rows, LAYER_LEDGER.schema).coalesce(1), LAYER_LEDGER)

    def _totals(self, table: Table, months: Sequence[date] | None = None) -> DataFrame:
        stored = self.spark.table(self.name(table))
        if months is not None:
            stored = stored.where(F.col(table.month_column).isin(list(months)))
        return control_totals(stored, table.name, table.month_column, table.control)

    @staticmethod
    def _by_month(totals: DataFrame) -> _Totals:
        """One row for each month comes to the driver."""
        return {r["month"]: (r["row_count"], r["control_sum"] or Decimal(0)) for r in totals.collect()}

    def recorded(self) -> DataFrame:
        """The last entry of each table and month."""
        last = F.max(F.struct("write_id", "row_count", "control_sum")).alias("last")
        return self.read(LAYER_LEDGER).groupBy("table_name", "month").agg(last).select("table_name", "month", "last.row_count", "last.control_sum")

    def check(self, tables: Sequence[Table]) -> DataFrame:
        """Recorded against stored, by table and month (``integrity.ledger_check``); empty months are left out."""
        names = [t.name for t in tables]
        stored = reduce(DataFrame.unionByName, [self._totals(t) for t in tables])
        found = ledger_check(self.recorded().where(F.col("table_name").isin(names)), stored)
        return found.where("recorded_rows > 0 OR stored_rows > 0")
