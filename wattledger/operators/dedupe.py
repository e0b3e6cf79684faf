"""Latest record per key, and merging of late arrivals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.expressions import month_floor, surrogate_key

READING_KEY = ("contract_id", "reading_date")
RACK_KEY = ("contract_id", "usage_date")


def latest_record(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ("ingested_at",)) -> DataFrame:
    """The row of each key that ranks highest by ``order_by``; NULLs rank lowest.

    Columns not named in ``order_by`` break the remaining ties, so the winner never depends on how the
    rows were partitioned. The maximum is combined before the shuffle: however many copies a key has,
    each map task sends one row for it, so a key holding a third of the table is no hot spot. Leading
    the grouping with a hash lets the sort decide most comparisons on an eight-byte prefix.
    """
    ranked = list(order_by) + [c for c in df.columns if c not in keys and c not in order_by]
    return (
        df.groupBy(F.xxhash64(*keys).alias("key_hash"), *keys)
        .agg(F.max(F.struct(*ranked)).alias("latest"))
        .select(*[c if c in keys else F.col("latest").getField(c).alias(c) for c in df.columns])
    )


def arrival_order(df: DataFrame) -> list[str]:
    """Arrival time first, then the source's own order where the source has one."""
    return ["ingested_at"] + [c for c in ("source_order",) if c in df.columns]


def latest_readings(meter: DataFrame) -> DataFrame:
    """One meter reading per contract and day.

    The version is left out of the key on purpose: a contract has one meter reading a day, and a copy
    labelled with the wrong version is still a copy.
    """
    return latest_record(meter, READING_KEY, arrival_order(meter)).drop("source_order")


def latest_rack_counts(racks: DataFrame) -> DataFrame:
    return latest_record(racks, RACK_KEY, arrival_order(racks)).drop("source_order")


def latest_in_months(daily: DataFrame, day: str) -> DataFrame:
    """The latest record of each contract and day with its ``usage_month``, dealt by contract and month: sums of
    contract-months need no second shuffle, and a contract with a third of all rows is spread over its months.

    Copies are not combined before the shuffle, so those of one contract-month meet in one task. How long after its day a
    record came in stands for ``ingested_at``: the order is the same, and a few values repeat where times do not, which
    shortens the shuffle. Records without a day have no such lag; no month counts them.
    """
    month = month_floor(F.col(day))
    lag = F.col("ingested_at") - F.col(day).cast("timestamp_ntz")
    dealt = daily.withColumn("arrival_lag", lag).drop("ingested_at").repartition("contract_id", month)
    keys = ("contract_id", day, "usage_month")
    payload = [c for c in daily.columns if c not in (*keys, "ingested_at")]
    return (
        dealt.withColumn("usage_month", month)
        .groupBy(*keys)
        .agg(F.max(F.struct("arrival_lag", *payload)).alias("latest"))
        .select(*keys, *[F.col("latest").getField(c).alias(c) for c in payload])
    )


def backfill_merge(existing: DataFrame, late: DataFrame, reprocessed_at: Column) -> DataFrame:
    """Existing and late readings merged: the latest arrival wins, late winners carry the rerun's time."""
    marked = existing.withColumn("reprocessed_at", F.lit(None).cast("timestamp_ntz")).unionByName(
        late.withColumn("reprocessed_at", reprocessed_at.cast("timestamp_ntz"))
    )
    return latest_record(marked, READING_KEY, arrival_order(existing)).drop("source_order")


def keyed_facts(facts: DataFrame, keyed_contracts: DataFrame) -> DataFrame:
    """Facts with a source_system and the keys of their contract; NULL where the mapping has none."""
    mapping = keyed_contracts.select("source_system", "contract_id", "contract_version", "contract_key", "customer_key")
    return facts.join(mapping, ["source_system", "contract_id", "contract_version"], "left")


def with_surrogate_keys(contracts: DataFrame, source: Column) -> DataFrame:
    """Contracts with keys that stay unique when source systems reuse contract or customer ids.

    ``source`` names the system a row came from. The result is also the mapping: joined on source system,
    contract and version it gives facts of several systems their contract's key.
    """
    return contracts.select(
        surrogate_key(source, F.col("contract_id"), F.col("contract_version")).alias("contract_key"),
        surrogate_key(source, F.col("customer_id")).alias("customer_key"),
        source.alias("source_system"),
        "contract_id",
        "contract_version",
        "customer_id",
    )
