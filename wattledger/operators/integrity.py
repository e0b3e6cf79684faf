"""Declared constraints as queries: keys, references, NOT NULL, and counts per layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.expressions import GREEN, RED, count_where, key_text
from wattledger.schemas import BY_NAME, FOREIGN_KEYS, ForeignKey


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def key_violations(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once. Counted before the shuffle, so a hot key costs one row per task."""
    return (
        df.groupBy(*key)
        .agg(F.count("*").alias("row_count"))
        .where("row_count > 1")
        .select(F.lit(table).alias("table_name"), key_text(key).alias("key_value"), "row_count")
    )


def primary_key_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([key_violations(df, name, BY_NAME[name].key) for name, df in tables.items()])


def reference_violations(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """Referenced keys the parent lacks, with the number of rows that use each.

    The child is grouped first: the anti join sees one row per distinct key and cannot be skewed.
    """
    used = child.groupBy(*fk.columns).agg(F.count("*").alias("row_count"))
    return used.join(parent.select(*fk.columns), list(fk.columns), "left_anti").select(
        F.lit(fk.child).alias("table_name"),
        F.lit(fk.parent).alias("references_table"),
        key_text(fk.columns).alias("key_value"),
        "row_count",
    )


def foreign_key_violations(
    tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey] = FOREIGN_KEYS
) -> DataFrame:
    return _union([reference_violations(tables[k.child], tables[k.parent], k) for k in keys])


def null_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all counted in one pass over the table."""
    counts = df.agg(F.count("*").alias("row_count"), *[count_where(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot("row_count", list(columns), "column_name", "null_count").select(
        F.lit(table).alias("table_name"),
        "column_name",
        F.coalesce("null_count", F.lit(0)).alias("null_count"),
        "row_count",
    )


def not_null_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """NULL count of every column that is declared NOT NULL; zero rows are listed, so silence is proven."""
    return _union([null_counts(df, name, BY_NAME[name].required) for name, df in tables.items()])


def null_risk(mart: DataFrame) -> DataFrame:
    return mart.agg(
        count_where(F.col("erp_revenue_total").isNull()).alias("null_revenue_rows"),
        count_where(F.col("allocated_power_cost").isNull()).alias("null_cost_rows"),
    )


def layer_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of every layer, each counted from what the layer itself gives."""
    return _union([df.agg(F.count("*").alias("cnt")).select(F.lit(name).alias("table_name"), "cnt")
                   for name, df in tables.items()])


LEDGER_KEY = ("table_name", "month")


def control_sum(control: Sequence[str]) -> Column:
    """The exact sum of the control columns over all rows; NULL amounts count as nothing."""
    none = F.lit(0).cast("decimal(28,2)")
    return F.sum(reduce(Column.__add__, [F.coalesce(F.col(c).cast("decimal(28,2)"), none) for c in control], none)).cast("decimal(38,2)")


def control_totals(df: DataFrame, table: str, month: str | None, control: Sequence[str]) -> DataFrame:
    """Rows and the exact sum of the control columns, for each month of a table, or for all of it."""
    by = F.col(month) if month else F.lit(None).cast("date")
    return (
        df.groupBy(by.alias("month"))
        .agg(F.count("*").alias("row_count"), control_sum(control).alias("control_sum"))
        .select(F.lit(table).alias("table_name"), "month", "row_count", "control_sum")
    )


def ledger_check(recorded: DataFrame, stored: DataFrame) -> DataFrame:
    """What was recorded as written against what a layer holds, by table and month; Red where they differ.

    A month that only one side knows counts as nothing on the other, so lost and foreign months are Red too.
    Both sides have a row for each table and month of the calendar.
    """
    zero = F.lit(0).cast("decimal(38,2)")
    left = recorded.select(*LEDGER_KEY, F.col("row_count").alias("recorded_rows"), F.col("control_sum").alias("recorded_sum")).alias("r")
    right = stored.select(*LEDGER_KEY, F.col("row_count").alias("stored_rows"), F.col("control_sum").alias("stored_sum")).alias("s")
    same = (F.col("r.table_name") == F.col("s.table_name")) & F.col("r.month").eqNullSafe(F.col("s.month"))
    amounts = {f"{side}_{what}": F.coalesce(F.col(f"{side}_{what}"), none) for what, none in (("rows", F.lit(0).cast("long")), ("sum", zero)) for side in ("recorded", "stored")}
    both = left.join(right, same, "full_outer").select(
        F.coalesce("r.table_name", "s.table_name").alias("table_name"), F.coalesce("r.month", "s.month").alias("month"), *[v.alias(n) for n, v in amounts.items()]
    )
    agrees = (F.col("recorded_rows") == F.col("stored_rows")) & (F.col("recorded_sum") == F.col("stored_sum"))
    return both.withColumn("ledger_status", F.when(agrees, GREEN).otherwise(RED))
