"""Meter readings as a stream: bounded lateness, daily usage, and months kept current by upsert."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from wattledger.functions.expressions import BACKFILL_DAYS, ESTIMATED, LATE, ON_TIME, month_floor
from wattledger.operators.dedupe import latest_readings
from wattledger.operators.monthly import usage_monthly
from wattledger.operators.windows import version_in_force
from wattledger.sources.layers import touched_months

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)

READINGS = T.StructType(
    [
        T.StructField("reading_date", T.DateType()),
        T.StructField("contract_id", T.LongType()),
        T.StructField("contract_version", T.IntegerType()),
        T.StructField("used_kw", T.DecimalType(10, 2)),
        T.StructField("reading_status", T.StringType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
        T.StructField("reading_id", T.LongType()),
    ]
)

#: Readings as the monthly upsert keeps them, and the months it has staged and not yet published.
STORED = T.StructType([*READINGS.fields, T.StructField("reading_month", T.DateType())])
PENDING = T.StructType([T.StructField("reading_month", T.DateType())])

DAILY_USAGE = T.StructType(
    [
        T.StructField("usage_date", T.DateType()),
        T.StructField("contract_id", T.LongType()),
        T.StructField("readings", T.LongType()),
        T.StructField("total_kw", T.DecimalType(20, 2)),
        T.StructField("peak_kw", T.DecimalType(10, 2)),
    ]
)


def event_stream(spark: SparkSession, folder: str, name_glob: str = "events*.parquet", **options) -> DataFrame:
    reader = spark.readStream.schema(EVENTS).option("pathGlobFilter", name_glob)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.parquet(folder)


def as_readings(events: DataFrame, arriving_late: bool = False) -> DataFrame:
    """Events as meter readings: the user is the contract, the value its kW, the event's day the reading date.

    The event time is the arrival; with ``arriving_late`` readings arrive up to ten days after it.
    """
    delay = (F.col("event_id") % 11).cast("int") if arriving_late else F.lit(0)
    return events.select(
        F.col("ts").cast("date").alias("reading_date"),
        F.col("user_id").alias("contract_id"),
        F.lit(1).alias("contract_version"),
        F.col("value").cast("decimal(10,2)").alias("used_kw"),
        F.lit(ON_TIME).alias("reading_status"),
        (F.col("ts") + F.make_dt_interval(delay)).alias("ingested_at"),
        F.col("event_id").alias("reading_id"),
    )


def event_versions(events: DataFrame) -> DataFrame:
    """Contracts for the readings made from events, by the events alone: one version for each user, from its
    first day to its last. Every fifth user's version ends a week early, so that some days have none."""
    day = F.col("ts").cast("date")
    last = F.date_sub(F.max(day), F.when(F.col("user_id") % 5 == 0, 7).otherwise(0))
    return events.groupBy("user_id").agg(F.min(day).alias("effective_start"), last.alias("effective_end")).select(
        F.col("user_id").alias("contract_id"), F.lit(1).alias("contract_version"), "effective_start", "effective_end"
    )


def _days_late() -> Column:
    return F.datediff(F.col("ingested_at").cast("date"), F.col("reading_date"))


def intake(
    readings: DataFrame, key: Sequence[str] = ("reading_id",), lateness_days: int = BACKFILL_DAYS
) -> DataFrame:
    """Readings that arrived within the backfill window, each delivered once.

    The reading's own day is the event time: it decides on lateness, on the day usage is booked and on
    when state is let go. State holds one entry per key for the length of the window. What came later is
    in ``too_late``. Input is taken in the order of arrival; a reading in time is then never behind the
    watermark. The watermark needs a timestamp with time zone: build this under UTC, as the runs below do.
    """
    return (
        readings.where(_days_late() <= lateness_days)
        .withColumn("reading_ts", F.col("reading_date").cast("timestamp"))
        .withWatermark("reading_ts", f"{lateness_days} days")
        .dropDuplicatesWithinWatermark(list(key))
    )


def too_late(readings: DataFrame, lateness_days: int = BACKFILL_DAYS) -> DataFrame:
    """All that ``intake`` does not take, as it came: readings beyond the window, and those without a day or an
    arrival, whose lateness nobody knows. They are there for the next backfill."""
    return readings.where(F.coalesce(_days_late() > lateness_days, F.lit(True)))


def daily_usage(accepted: DataFrame) -> DataFrame:
    """Usage per contract and reading day; in append mode a day appears once, when the watermark has closed it.

    Months differ in length, so they cannot be a tumbling window; ``MonthUpsert`` builds those.
    """
    return (
        accepted.groupBy(F.window("reading_ts", "1 day"), "contract_id")
        .agg(
            F.count("*").alias("readings"),
            F.sum("used_kw").alias("total_kw"),
            F.max("used_kw").alias("peak_kw"),
        )
        .select(F.col("window.start").cast("date").alias("usage_date"), "contract_id", "readings", "total_kw", "peak_kw")
    )


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _settings(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Settings for streams that are started meanwhile, which keep them.

    They are changed while streams are started and set back at once: do not plan other queries of the same
    session in another thread at that moment.
    """
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _utc(spark: SparkSession):
    """Days are UTC days whatever the session's zone."""
    return _settings(spark, **{"spark.sql.session.timeZone": "UTC"})


def _append(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _finished(*queries: StreamingQuery) -> None:
    for query in queries:
        query.awaitTermination()


def run_daily_usage(readings: DataFrame, out: str, late_out: str, checkpoint: str) -> None:
    """Daily usage of whatever input is there; readings the intake does not take go to the other table."""
    with _utc(readings.sparkSession):
        closed = _append(daily_usage(intake(readings)), out, f"{checkpoint}/daily")
        late = _append(too_late(readings), late_out, f"{checkpoint}/late")
    _finished(closed, late)


def run_intake(readings: DataFrame, out: str, late_out: str, checkpoint: str) -> None:
    """Takes in what is there: accepted readings to one table, those beyond the window to the other."""
    with _utc(readings.sparkSession):
        accepted = _append(intake(readings).drop("reading_ts"), out, f"{checkpoint}/accepted")
        late = _append(too_late(readings), late_out, f"{checkpoint}/late")
    _finished(accepted, late)


DAY_STATUS = T.StructType(
    [
        T.StructField("contract_id", T.LongType()),
        T.StructField("contract_version", T.IntegerType()),
        T.StructField("reading_date", T.DateType()),
        T.StructField("missing", T.BooleanType()),
        T.StructField("lateness_class", T.StringType()),
    ]
)

_EPOCH = date(1970, 1, 1)
_DAY_MS = 86_400_000


class DayCloser(StatefulProcessor):
    """Closes the days of a contract's versions as event time passes them, with or without a reading.

    Days are numbered from 1970. State is what the contract's open days need: its versions, the longest delay
    of the readings of each open day, and the first open day, on whose end a timer stands. When the watermark
    is past it, every day that ended is emitted once and forgotten, so state does not grow with history; past
    the last day nothing stays.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getListState("versions", "version int, first int, last int")
        self.delays = handle.getMapState("delays", "day int", "days int")
        self.first_open = handle.getValueState("first_open", "day int")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        versions = sorted({(int(v), int(a), int(b)) for v, a, b in initialState[["version", "first", "last"]].itertuples(index=False)})
        if versions:
            self.versions.put(versions)
            self._open_from(min(v[1] for v in versions))

    def _open_from(self, day: int) -> None:
        self.first_open.update((day,))
        self.handle.registerTimer((day + 1) * _DAY_MS - 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.first_open.exists():
            (first,) = self.first_open.get()
            for some in rows:
                for day, days in some.groupby("day")["days"].max().items():
                    known = self.delays.getValue((int(day),)) if self.delays.containsKey((int(day),)) else None
                    if day >= first and (known is None or known[0] < days):
                        self.delays.updateValue((int(day),), (int(days),))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        versions = list(self.versions.get())
        (day,) = self.first_open.get()
        last = max(v[2] for v in versions)
        ended = min(timerValues.getCurrentWatermarkInMs() // _DAY_MS - 1, last)
        closed = []
        while day <= ended:
            found = self.delays.getValue((day,)) if self.delays.containsKey((day,)) else None
            held = [v[0] for v in versions if v[1] <= day <= v[2]]
            if held:
                status = ESTIMATED if found is None else ON_TIME if found[0] <= 0 else LATE
                closed.append((key[0], max(held), _EPOCH + timedelta(days=day), found is None, status))
            if found is not None:
                self.delays.removeKey((day,))
            day += 1
        if day > last:
            for state in (self.versions, self.delays, self.first_open):
                state.clear()
        else:
            self._open_from(day)
        yield pd.DataFrame(closed, columns=DAY_STATUS.names)

    def close(self) -> None:
        pass


def closed_days(readings: DataFrame, contracts: DataFrame, lateness_days: int = BACKFILL_DAYS) -> DataFrame:
    """Every day of every contract version once, when its lateness bound has passed: on time or late by the
    longest delay among its readings in time, estimated where there is none.

    The stream's form of ``calendar.lateness_classes`` over the readings ``intake`` takes. Days are those of
    ``contracts`` as they were when the stream first started; where versions overlap, the later one counts.
    A reading for a day outside them closes none. Needs Spark's RocksDB state store (``run_closed_days``).
    """
    day = lambda column: F.datediff(F.col(column), F.lit(_EPOCH))
    spans = contracts.select(
        F.col("contract_id").cast("long").alias("contract_id"),
        F.col("contract_version").cast("int").alias("version"),
        day("effective_start").alias("first"),
        day("effective_end").alias("last"),
    ).where("first <= last AND contract_id IS NOT NULL")
    timely = (
        readings.where((_days_late() <= lateness_days) & F.col("contract_id").isNotNull())
        .withColumn("reading_ts", F.col("reading_date").cast("timestamp"))
        .withWatermark("reading_ts", f"{lateness_days} days")
        .select("reading_ts", F.col("contract_id").cast("long").alias("contract_id"), day("reading_date").alias("day"), _days_late().alias("days"))
    )
    return timely.groupBy("contract_id").transformWithStateInPandas(
        statefulProcessor=DayCloser(),
        outputStructType=DAY_STATUS,
        outputMode="Append",
        timeMode="EventTime",
        initialState=spans.groupBy("contract_id"),
    )


def run_closed_days(readings: DataFrame, contracts: DataFrame, out: str, late_out: str, checkpoint: str) -> None:
    """Closes the days that the input at hand brings to an end; what is not in time goes to the other table."""
    spark = readings.sparkSession
    with _utc(spark), _settings(spark, **{"spark.sql.streaming.stateStore.providerClass": ROCKSDB}):
        closed = _append(closed_days(readings, contracts), out, f"{checkpoint}/closed")
    with _utc(spark):
        late = _append(too_late(readings), late_out, f"{checkpoint}/late")
    _finished(closed, late)


class MonthUpsert:
    """Batch function of a stream: keeps the latest reading of each contract-day and the months they add up to.

    Everything is tables under ``root``, partitioned by month and written by Spark alone: ``readings`` holds
    the latest reading of each day, ``usage`` the months under the contract version in force, ``unheld`` the
    readings that no version holds or that have no day, as they came, partitioned by batch as well.

    A batch touches some months. Their readings are merged with the batch into ``staged``, their list is
    written to ``pending``, then both tables' months are replaced from what is staged, and the list is
    emptied. Interrupted before the list is written, nothing was published and the replay starts from the
    tables as they were. Interrupted later, the next call first publishes what is staged: months that a
    half-done replacement emptied come back. As the latest reading wins, a batch that is given again, in
    part or whole, changes nothing.

    Readings count as published with the versions in ``contracts``; a version withdrawn later asks for a
    rebuild of its months. ``source`` tells apart the batches of several streams that share a root.
    """

    def __init__(self, contracts: DataFrame, root: str, source: str = "stream"):
        self.contracts, self.root, self.source = contracts, root.rstrip("/"), source

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self._publish(spark)
        touched = touched_months(batch, "reading_date")
        stamped = batch.withColumn("reading_month", month_floor(F.col("reading_date")))
        labelled = stamped.withColumn("source", F.lit(self.source)).withColumn("batch_id", F.lit(batch_id))
        unheld = version_in_force(labelled, self.contracts, "reading_date").where("in_force_version IS NULL")
        self._write(unheld.drop("in_force_version"), "unheld", "reading_month", "source", "batch_id")
        months = [m for m in touched if m is not None]
        if not months:
            return
        before = self._read(spark, "readings", STORED).where(F.col("reading_month").isin(months))
        merged = latest_readings(before.unionByName(stamped.where("reading_date IS NOT NULL")).select(*STORED.names))
        self._replace(merged, "staged")
        self._replace(spark.createDataFrame([(m,) for m in months], PENDING).coalesce(1), "pending")
        self._publish(spark)

    def _publish(self, spark: SparkSession) -> None:
        """Replaces the months that are pending by what is staged for them."""
        if self._read(spark, "pending", PENDING).isEmpty():
            return
        staged = self._read(spark, "staged", STORED)
        self._write(staged, "readings", "reading_month")
        latest = version_in_force(staged.drop("reading_month"), self.contracts, "reading_date")
        held = latest.where("in_force_version IS NOT NULL").withColumn("contract_version", F.col("in_force_version"))
        self._write(usage_monthly(held.drop("in_force_version")), "usage", "usage_month")
        self._replace(spark.createDataFrame([], PENDING).coalesce(1), "pending")

    def _read(self, spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
        """A table, which is made empty where it is not there yet."""
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.root}/{table}")
        return spark.read.schema(schema).parquet(f"{self.root}/{table}")

    def _replace(self, rows: DataFrame, table: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.root}/{table}")

    def _write(self, rows: DataFrame, table: str, *partitions: str) -> None:
        """Replaces the partitions the rows are in, and no other."""
        writer = rows.hint("rebalance", partitions[0]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partitions).parquet(f"{self.root}/{table}")


def usage_months(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/usage")


def unheld_readings(spark: SparkSession, root: str) -> DataFrame:
    """What the upsert's contracts did not hold; an empty frame where they held everything."""
    return spark.read.schema(READINGS).option("recursiveFileLookup", True).parquet(f"{root}/unheld")


def run_month_upsert(readings: DataFrame, contracts: DataFrame, root: str, checkpoint: str, source: str = "stream") -> StreamingQuery:
    return (
        readings.writeStream.foreachBatch(MonthUpsert(contracts, root, source))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
