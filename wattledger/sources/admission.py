"""Loads that keep declared constraints: rows are written, audited and only then published."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wattledger.functions.expressions import count_where
from wattledger.schemas import FOREIGN_KEYS, Table
from wattledger.sources.files import conform
from wattledger.sources.layers import LayerStore

#: Reasons, the first that applies counts: a missing value, a reference without a row, a key taken by another row.
NULL_VALUE, ORPHAN, DUPLICATE = "missing {}", "no {} for {}", "duplicate key"


class LoadRefused(RuntimeError):
    """Too large a part of a load breaks the declared constraints; nothing was published."""


@dataclass(frozen=True)
class Admission:
    """How many rows a load gave, how many were published, and how many are in quarantine."""

    given: int
    published: int
    quarantined: int


def judged(df: DataFrame, table: Table, parents: Mapping[str, DataFrame]) -> DataFrame:
    """The rows with ``reason`` (NULL: may be published) and ``copies`` (how many given rows a row stands for).

    A NULL in a required column comes first, then a reference that has no row among ``parents`` (by table
    name; references to tables not given are not judged), then the key: of the rows that share one, the
    largest by its values may be published once, whatever the order they came in.

    Equal rows are counted before they are shuffled, and a key's largest row is found with a partial maximum,
    so a key that holds a third of all rows is joined to one row and may be split there.
    """
    columns = table.schema.names
    rows = df.groupBy(*columns).agg(F.count("*").alias("copies"))
    reason = F.lit(None).cast("string")
    for name in reversed(table.required):
        reason = F.when(F.col(name).isNull(), NULL_VALUE.format(name)).otherwise(reason)
    rows = rows.withColumn("reason", reason)
    for fk in FOREIGN_KEYS:
        if fk.child == table.name and fk.parent in parents:
            known = parents[fk.parent].select(*fk.columns).distinct().withColumn("__known", F.lit(True))
            orphan = F.col("reason").isNull() & F.col("__known").isNull()
            named = ORPHAN.format(fk.parent, " ".join(fk.columns))
            rows = rows.join(known, list(fk.columns), "left").withColumn("reason", F.when(orphan, named).otherwise(F.col("reason"))).drop("__known")
    key = list(table.key)
    winner = rows.where("reason IS NULL").groupBy(*key).agg(F.max(F.struct(*columns)).alias("__winner"))
    met = rows.join(winner, key, "left")
    wins = F.col("reason").isNull() & (F.struct(*columns) == F.col("__winner"))
    one = F.struct(F.lit(None).cast("string").alias("reason"), F.lit(1).cast("long").alias("copies"))
    others = lambda copies, why: F.struct(why.alias("reason"), copies.alias("copies"))
    split = F.when(wins, F.array(one, others(F.col("copies") - 1, F.lit(DUPLICATE)))).otherwise(
        F.array(others(F.col("copies"), F.coalesce("reason", F.lit(DUPLICATE))))
    )
    return met.select(*columns, F.explode(split).alias("__one")).select(*columns, "__one.reason", "__one.copies").where("copies > 0")


def admit(store: LayerStore, df: DataFrame, table: Table, parents: Mapping[str, DataFrame], staging: str, most_refused: float = 1.0) -> Admission:
    """Replaces a table by those rows of a load that keep its constraints; the others are listed with a reason.

    Written first: every row with its verdict goes to ``staging``, a folder of this load. Audited: counts are
    observed during that one pass. Published last, and only if no more than ``most_refused`` of the load is
    refused (``LoadRefused`` otherwise, and the table stays as it was). What is refused stays in ``staging``.
    """
    seen = Observation()
    copies = F.col("copies")
    counts = [F.sum(copies).alias("given"), F.sum(F.when(F.col("reason").isNull(), copies)).alias("published"), count_where(F.col("reason").isNull()).alias("rows")]
    verdicts = judged(conform(df, table, store.wide), table, parents)
    verdicts.observe(seen, *counts).write.mode("overwrite").parquet(staging)
    given, published = seen.get["given"] or 0, seen.get["published"] or 0
    if given - published > most_refused * given:
        raise LoadRefused(f"{table.name}: {given - published} of {given} rows break declared constraints")
    kept = store.spark.read.schema(verdicts.schema).parquet(staging).where("reason IS NULL")
    store.overwrite(kept.drop("reason", "copies"), table)
    return Admission(given, published, given - published)


def quarantine(store: LayerStore, staging: str) -> DataFrame:
    """The refused rows of a load, with reason and copies."""
    return store.spark.read.parquet(staging).where("reason IS NOT NULL")
