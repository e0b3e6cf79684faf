"""Layered storage: a database per layer, typed Parquet tables, appends and partition overwrites."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.functions.expressions import month_floor
from wattledger.schemas import ALL_TABLES, LAYERS, Table
from wattledger.sources.files import conform, stored_type

# Bytes of input files or of a shuffle that a task takes where it writes rows that are not dealt by month: smaller tasks
# mean more and smaller files, larger ones more rows to sort by month.
LOAD_BYTES = 64 << 20
LOAD_SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")

# What a file counts beside its bytes where stored months are read for the next layer: with Spark's 4 MB a task takes
# seven small files, and many tasks make short runs that compress badly.
OPEN_BYTES = 1 << 20


class LayerStore:
    """Tables of the raw, curated, mart and recon layers under one root folder.

    ``prefix`` keeps several stores apart in one catalog. ``wide`` stores integers as BIGINT and amounts
    with 20 digits, for sources that outgrow the declared types.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", wide: bool = False):
        self.spark, self.root, self.prefix, self.wide = spark, root.rstrip("/"), prefix, wide

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, table: Table) -> str:
        return f"{self.database(table.layer)}.{table.name}"

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.layer}/{table.name}"

    def create(self, tables: Sequence[Table] = ALL_TABLES) -> None:
        """Creates what is missing; running it again changes nothing."""
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} LOCATION '{self.root}/{layer}'")
        for table in tables:
            partitions = f"PARTITIONED BY ({table.month_column})" if table.month_column else ""
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._stored(table).fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet OPTIONS (compression 'zstd') {partitions} "
                f"LOCATION '{self.path(table)}'"
            )

    def _stored(self, table: Table) -> T.StructType:
        fields = [T.StructField(f.name, stored_type(f, self.wide)) for f in table.schema.fields]
        fields += [T.StructField(name, T.TimestampNTZType()) for name in table.audit]
        if table.month_column and table.month_column not in table.schema.names:
            fields.append(T.StructField(table.month_column, T.DateType()))
        return T.StructType(fields)

    def _shaped(self, df: DataFrame, table: Table, dealt: bool = True) -> DataFrame:
        """Declared columns and types, in the positional order the stored table has."""
        given = {c: F.col(c) if c in df.columns else F.lit(None) for c in table.audit}
        kept = {c: v.cast("timestamp_ntz").alias(c) for c, v in given.items()}
        rows = conform(df.select(*[c for c in df.columns if c not in kept], *kept.values()), table, self.wide, tuple(kept))
        month = table.month_column
        if month and month not in rows.columns:
            rows = rows.withColumn(month, month_floor(F.col(table.dated_by)))
        if month and dealt:
            # Whole months per file, without gathering a large month in one task: adaptive execution
            # splits the partitions of a rebalance that come out too big.
            rows = rows.hint("rebalance", month)
        return rows.select(*self.spark.table(self.name(table)).columns)

    def _metrics(self, table: Table) -> list[Column]:
        """What is observed of the rows of a write as they pass."""
        months = F.collect_set(table.month_column) if table.month_column else F.collect_set(F.lit(None).cast("date"))
        return [F.count(F.lit(1)).alias("rows"), months.alias("months")]

    def _wrote(self, table: Table, seen: dict, months: Sequence[date] | None, replaced: bool) -> None:
        """Called after each write with what was observed; for stores that keep account of it."""

    def append(self, df: DataFrame, table: Table) -> list[date]:
        """Adds rows; returns the months they went to, as they were written."""
        seen = Observation()
        self._shaped(df, table).observe(seen, *self._metrics(table)).write.mode("append").insertInto(self.name(table))
        self._wrote(table, seen.get, None, replaced=False)
        return sorted(seen.get["months"])

    def overwrite(self, df: DataFrame, table: Table, months: Sequence[date] | None = None, dealt: bool = True) -> None:
        """Replaces the whole table, or with ``months`` those months and no other.

        ``months`` are the ones that were rebuilt: those the rows no longer mention are emptied, which an
        overwrite of written partitions alone would leave as they were.

        Without ``dealt`` rows are not dealt by month first, which spares a shuffle of them all: each task writes a
        file for each of its months. Tasks are larger for it (``LOAD_BYTES``), so that files are fewer.
        """
        seen = Observation()
        rows = self._shaped(df, table, dealt).observe(seen, *self._metrics(table))
        by_month = months is not None and table.month_column is not None
        settings = {"spark.sql.sources.partitionOverwriteMode": "dynamic" if by_month else "static"}
        if not dealt:
            settings |= dict.fromkeys(LOAD_SIZES, str(LOAD_BYTES))
        else:
            settings["spark.sql.files.openCostInBytes"] = str(OPEN_BYTES)
        self._replace(rows, table, settings)
        for gone in set(months) - set(seen.get["months"]) if by_month else ():
            self._empty(table, gone)
        self._wrote(table, seen.get, months if by_month else None, replaced=True)

    def _replace(self, rows: DataFrame, table: Table, settings: dict[str, str]) -> None:
        """Static replaces the table, dynamic the months written. A catalog table takes the mode from the
        session alone, which gets its own settings back when the write is done."""
        before = {key: self.spark.conf.get(key) for key in settings}
        try:
            for key, value in settings.items():
                self.spark.conf.set(key, value)
            rows.write.insertInto(self.name(table), overwrite=True)
        finally:
            for key, value in before.items():
                self.spark.conf.set(key, value)

    def _empty(self, table: Table, month: date) -> None:
        """Removes a month's files; an overwrite of one named partition does so even without rows."""
        fields = [f for f in self._stored(table).fields if f.name != table.month_column]
        columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields)
        self.spark.sql(
            f"INSERT OVERWRITE {self.name(table)} PARTITION ({table.month_column} = DATE'{month}') "
            f"SELECT {columns} WHERE false"
        )

    def read(self, table: Table, months: Sequence[date] | None = None, audit: bool = False) -> DataFrame:
        """The declared columns, restricted to whole months by partition pruning; on demand those for audit."""
        rows = self.spark.table(self.name(table))
        if months is not None and table.month_column:
            rows = rows.where(F.col(table.month_column).isin(list(months)))
        return rows.select(*table.schema.names, *(table.audit if audit else ()))

    def drop(self) -> None:
        """Forgets the tables; their files stay."""
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.database(layer)} CASCADE")


def touched_months(df: DataFrame, day: str) -> list[date]:
    """Months the rows fall into. One small row per calendar month reaches the driver."""
    return [r[0] for r in df.select(month_floor(F.col(day)).alias("month")).distinct().collect()]
