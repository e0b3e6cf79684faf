from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import rows

from pyspark.sql import functions as F

from wattledger.operators import calendar, dedupe, monthly, windows
from wattledger.streaming import intake


def drop(spark, folder, name, *events):
    """One input file of (event_id, ts, user_id, value)."""
    data = [(i, datetime.fromisoformat(ts), user, value) for i, ts, user, value in events]
    spark.createDataFrame(data, intake.EVENTS).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def stream(spark, folder):
    return intake.event_stream(spark, f"{folder}/*", "*.parquet", maxFilesPerTrigger=1)


READING = "reading_date date, contract_id long, contract_version int, used_kw decimal(10,2), reading_status string, ingested_at timestamp_ntz, reading_id long"


def deliver(spark, folder, name, *readings):
    """One input file of (reading_id, reading_date, arrival, contract, kW)."""
    data = [
        (date.fromisoformat(day), contract, 1, Decimal(str(kw)), "on_time", datetime.fromisoformat(arrival), i)
        for i, day, arrival, contract, kw in readings
    ]
    spark.createDataFrame(data, READING).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def readings(spark, folder):
    return spark.readStream.schema(intake.READINGS).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/*")


def run_daily(spark, tmp_path):
    intake.run_daily_usage(readings(spark, tmp_path / "in"), *[str(tmp_path / name) for name in ("out", "too_late", "state")])
    return rows(spark.read.schema(intake.DAILY_USAGE).parquet(str(tmp_path / "out")), "usage_date", "contract_id", "readings", "total_kw")


def test_days_close_once_the_lateness_bound_has_passed(spark, tmp_path):
    folder = tmp_path / "in"
    deliver(spark, folder, "a", (1, "2024-01-01", "2024-01-01 01:00:00", 7, 1.5), (2, "2024-01-01", "2024-01-01 02:00:00", 7, 2.0))
    assert run_daily(spark, tmp_path) == []
    # A copy of reading 1, and one five days late: the first is dropped, the second counts on its own day.
    deliver(spark, folder, "b", (1, "2024-01-01", "2024-01-01 01:00:00", 7, 1.5), (3, "2024-01-06", "2024-01-06 00:00:00", 7, 9.0))
    deliver(spark, folder, "c", (4, "2024-01-01", "2024-01-06 03:00:00", 7, 0.5))
    assert run_daily(spark, tmp_path) == []
    deliver(spark, folder, "d", (5, "2024-01-09", "2024-01-09 00:00:00", 7, 1.0))
    assert run_daily(spark, tmp_path) == [("2024-01-01", 7, 3, 4.0)]
    # Thirty days late: the day stays as it was closed, and the day of arrival gets nothing.
    deliver(spark, folder, "e", (6, "2024-01-01", "2024-01-31 05:00:00", 7, 100.0))
    deliver(spark, folder, "f", (7, "2024-02-20", "2024-02-20 05:00:00", 7, 1.0))
    # It is in the side table instead, as is a reading without a day.
    spark.createDataFrame([(None, 7, 1, Decimal(3), "on_time", datetime(2024, 2, 20), 8)], READING).coalesce(1).write.parquet(str(folder / "g"))
    assert [r for r in run_daily(spark, tmp_path) if r[3] >= 100] == []
    assert run_daily(spark, tmp_path)[0] == ("2024-01-01", 7, 3, 4.0)
    aside = spark.read.schema(intake.READINGS).parquet(str(tmp_path / "too_late"))
    assert rows(aside, "reading_id", "used_kw") == [(6, 100.0), (8, 3.0)]


def test_readings_beyond_the_bound_go_to_the_side_table(spark, tmp_path):
    folder = tmp_path / "in"
    deliver(spark, folder, "a", (1, "2024-01-01", "2024-01-06 01:00:00", 7, 1.5), (1, "2024-01-01", "2024-01-06 01:00:00", 7, 1.5))
    deliver(spark, folder, "b", (2, "2024-01-01", "2024-01-31 01:00:00", 7, 2.0), (3, "2024-01-30", "2024-01-31 01:00:00", 7, 3.0))
    intake.run_intake(readings(spark, folder), str(tmp_path / "ok"), str(tmp_path / "late"), str(tmp_path / "state"))
    taken = {n: rows(spark.read.schema(intake.READINGS).parquet(str(tmp_path / n)), "reading_id", "reading_date") for n in ("ok", "late")}
    assert taken == {"ok": [(1, "2024-01-01"), (3, "2024-01-30")], "late": [(2, "2024-01-01")]}


def contracts(make):
    return make(
        "dim_contract",
        *[{"contract_id": c, "effective_start": "2024-01-01", "effective_end": "2024-01-31"} for c in (7, 8)],
        {"contract_id": 7, "contract_version": 2, "effective_start": "2024-02-01", "effective_end": "2024-12-31"},
    )


def run_months(spark, tmp_path, held):
    feed = intake.as_readings(stream(spark, tmp_path / "in"))
    intake.run_month_upsert(feed, held, str(tmp_path / "months"), str(tmp_path / "state")).awaitTermination()
    return usage_rows(spark, tmp_path / "months")


def usage_rows(spark, root):
    return rows(intake.usage_months(spark, str(root)), "usage_month", "contract_id", "contract_version", "total_kw")


def test_months_follow_the_latest_reading_under_the_version_in_force(spark, make, tmp_path):
    held = contracts(make)
    drop(spark, tmp_path / "in", "a", (1, "2024-01-31 01:00:00", 7, 1.0), (2, "2024-02-01 01:00:00", 7, 2.0), (9, "2024-02-01 01:00:00", 8, 3.0))
    assert run_months(spark, tmp_path, held) == [("2024-01-01", 7, 1, 1.0), ("2024-02-01", 7, 2, 2.0)]
    drop(spark, tmp_path / "in", "b", (3, "2024-01-31 09:00:00", 7, 5.0), (4, "2024-01-30 09:00:00", 8, 4.0))
    after = [("2024-01-01", 7, 1, 5.0), ("2024-01-01", 8, 1, 4.0), ("2024-02-01", 7, 2, 2.0)]
    assert run_months(spark, tmp_path, held) == after
    # The batch operators say the same of the same readings.
    given = intake.as_readings(spark.read.schema(intake.EVENTS).parquet(str(tmp_path / "in" / "a"), str(tmp_path / "in" / "b")))
    latest = windows.version_in_force(dedupe.latest_readings(given), held, "reading_date").where("in_force_version IS NOT NULL")
    batch = monthly.usage_monthly(latest.withColumn("contract_version", F.col("in_force_version")))
    assert rows(batch, "usage_month", "contract_id", "contract_version", "total_kw") == after


def batches(spark):
    """Three batches over two months: new days, a correction that came late, an older copy, readings nobody holds."""
    given = [
        [(1, datetime(2024, 1, 5, 1), 7, 1.0), (2, datetime(2024, 2, 5, 1), 7, 2.0), (3, datetime(2024, 1, 5, 1), 99, 9.0)],
        [(4, datetime(2024, 1, 5, 9), 7, 5.0), (5, datetime(2024, 1, 6, 1), 8, 4.0), (6, None, 7, 7.0)],
        [(7, datetime(2024, 1, 5, 0), 7, 0.5), (8, datetime(2024, 2, 6, 1), 7, 3.0)],
    ]
    return [intake.as_readings(spark.createDataFrame(b, intake.EVENTS)) for b in given]


EXPECTED = [("2024-01-01", 7, 1, 5.0), ("2024-01-01", 8, 1, 4.0), ("2024-02-01", 7, 2, 5.0)]


class Killed(Exception):
    pass


class DyingUpsert(intake.MonthUpsert):
    """Dies at its nth write and leaves the January it was about to replace empty, as a committer does that
    has deleted the old files and not yet moved the new ones."""

    def __init__(self, *args, dies_at, **kw):
        super().__init__(*args, **kw)
        self.left = dies_at

    def _step(self, write, rows, table, *partitions):
        self.left -= 1
        if self.left == 0:
            for file in Path(self.root, table).glob("*_month=2024-01-01/*.parquet") if table != "unheld" else ():
                file.unlink()
            raise Killed(table)
        write(rows, table, *partitions)

    def _write(self, rows, table, *partitions):
        self._step(super()._write, rows, table, *partitions)

    def _replace(self, rows, table):
        self._step(super()._replace, rows, table)


def test_a_batch_killed_at_any_step_is_repaired_by_its_replay(spark, make, tmp_path):
    held = contracts(make)
    given = batches(spark)
    survived = []
    for step in range(1, 20):
        root = str(tmp_path / f"{step}")
        upsert = intake.MonthUpsert(held, root)
        upsert(given[0], 0)
        try:
            DyingUpsert(held, root, dies_at=step)(given[1], 1)
            survived.append(step)
        except Killed:
            upsert(given[1], 1)
        upsert(given[2], 2)
        assert usage_rows(spark, root) == EXPECTED, step
        assert rows(intake.unheld_readings(spark, root), "reading_id") == [(3,), (6,)]
        if survived:
            break
    assert survived == [7]


def test_replayed_and_repeated_batches_change_nothing(spark, make, tmp_path):
    root = str(tmp_path / "months")
    upsert = intake.MonthUpsert(contracts(make), root)
    given = batches(spark)
    for k in (0, 1, 1, 2, 2):
        upsert(given[k], k)
    assert usage_rows(spark, root) == EXPECTED
    upsert(given[1], 7)
    assert usage_rows(spark, root) == EXPECTED
    assert rows(spark.read.parquet(f"{root}/readings"), "contract_id", "reading_date", "reading_id") == [
        (7, "2024-01-05", 4), (7, "2024-02-05", 2), (7, "2024-02-06", 8), (8, "2024-01-06", 5), (99, "2024-01-05", 3),
    ]


def test_files_of_a_month_do_not_grow_with_the_batches(spark, make, tmp_path):
    upsert = intake.MonthUpsert(contracts(make), str(tmp_path / "months"))
    for k in range(12):
        events = spark.createDataFrame([(k, datetime(2024, 1, 1 + k % 5, 1, k), 7, float(k))], intake.EVENTS)
        upsert(intake.as_readings(events), k)
    assert usage_rows(spark, tmp_path / "months") == [("2024-01-01", 7, 1, float(sum(range(7, 12))))]
    for table in ("readings/reading_month=2024-01-01", "usage/usage_month=2024-01-01", "staged"):
        assert len(list((tmp_path / "months" / table).glob("*.parquet"))) <= 4


def test_readings_no_version_holds_go_to_a_side_table(spark, make, tmp_path):
    """Days outside the window, an unknown contract and a reading without a day; a replay writes none twice."""
    events = [(1, datetime(2024, 1, 5), 7, 1.0), (2, datetime(2025, 3, 1), 7, 2.0), (3, datetime(2024, 1, 5), 99, 3.0), (4, None, 7, 4.0)]
    batch = intake.as_readings(spark.createDataFrame(events, intake.EVENTS))
    root = str(tmp_path / "months")
    for source in ("a", "a", "b"):
        intake.MonthUpsert(contracts(make), root, source)(batch, 0)
    assert rows(intake.usage_months(spark, root), "contract_id", "total_kw") == [(7, 1.0)]
    assert rows(intake.unheld_readings(spark, root), "reading_id", "contract_id") == [(2, 7)] * 2 + [(3, 99)] * 2 + [(4, 7)] * 2


def test_contracts_of_all_users_and_years_of_the_events(spark):
    events = [(1, datetime(2019, 1, 5), 7, 1.0), (2, datetime(2025, 3, 1), 7, 2.0), (3, datetime(2023, 6, 30), 10, 3.0)]
    held = intake.event_versions(spark.createDataFrame(events, intake.EVENTS))
    assert rows(held) == [(10, 1, "2023-06-30", "2023-06-23"), (7, 1, "2019-01-05", "2025-03-01")]


def run_status(spark, tmp_path, held):
    intake.run_closed_days(readings(spark, tmp_path / "in"), held, *[str(tmp_path / name) for name in ("days", "too_late", "state")])
    return spark.read.schema(intake.DAY_STATUS).parquet(str(tmp_path / "days"))


def test_days_close_as_read_late_or_estimated(spark, make, tmp_path):
    folder = tmp_path / "in"
    held = make(
        "dim_contract",
        {"contract_id": 7, "effective_start": "2024-01-01", "effective_end": "2024-01-03"},
        {"contract_id": 7, "contract_version": 2, "effective_start": "2024-01-03", "effective_end": "2024-01-05"},
        {"contract_id": 8, "effective_start": "2024-01-02", "effective_end": "2024-12-31"},
    )
    deliver(spark, folder, "a", (1, "2024-01-01", "2024-01-01 01:00:00", 7, 1.5), (2, "2024-01-02", "2024-01-02 01:00:00", 7, 1.0), (3, "2024-01-02", "2024-01-02 02:00:00", 99, 1.0))
    assert rows(run_status(spark, tmp_path, held)) == []
    # A second reading of the second day, four days late, and one for the fourth day that comes too late to count.
    deliver(spark, folder, "b", (4, "2024-01-02", "2024-01-06 01:00:00", 7, 2.0), (5, "2024-01-04", "2024-01-30 01:00:00", 7, 2.0))
    deliver(spark, folder, "c", (6, "2024-01-11", "2024-01-11 01:00:00", 7, 2.0))
    first = [(7, 1, "2024-01-01", False, "on_time"), (7, 1, "2024-01-02", False, "late"), (7, 2, "2024-01-03", True, "estimated"), (8, 1, "2024-01-02", True, "estimated"), (8, 1, "2024-01-03", True, "estimated")]
    assert rows(run_status(spark, tmp_path, held)) == first
    deliver(spark, folder, "d", (7, "2024-01-14", "2024-01-15 01:00:00", 8, 2.0))
    done = run_status(spark, tmp_path, held)
    later = [(7, 2, "2024-01-04", True, "estimated"), (7, 2, "2024-01-05", True, "estimated")]
    later += [(8, 1, f"2024-01-0{d}", True, "estimated") for d in (4, 5, 6)]
    assert rows(done) == sorted(first + later)
    assert rows(spark.read.schema(intake.READINGS).parquet(str(tmp_path / "too_late")), "reading_id") == [(5,)]
    # The batch operators say the same of the readings in time, for the days that are closed.
    taken = spark.read.schema(intake.READINGS).parquet(*[str(folder / n) for n in "abcd"]).where("reading_id <> 5")
    latest = windows.version_in_force(dedupe.latest_readings(taken), held, "reading_date")
    owned = latest.withColumn("contract_version", F.coalesce("in_force_version", "contract_version"))
    batch = calendar.lateness_classes(windows.effective_meter(owned.drop("in_force_version"), windows.disjoint_windows(held)), windows.disjoint_windows(held))
    assert rows(batch.where("reading_date < '2024-01-07'").select(*done.columns)) == rows(done)
