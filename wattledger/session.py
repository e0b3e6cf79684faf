"""Session settings the operators are written for."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

# Adaptive execution carries the skew handling of every large join (hot contracts, hot orders) and
# picks partition counts and broadcast sides from measured sizes, so no operator hard-codes them.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the next step could have used the join's partitioning: one more shuffle
    # beats one task with a third of the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Adaptive execution joins shuffle partitions up to a size as compressed. Rows of ascending keys take up to 25
# times that in a hash table or a sort, so partitions of the default 64 MB make tasks of 2 GB; these do not.
# Likewise the rows of a file that one task combines before its shuffle.
TASK_BYTES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20,
    "spark.sql.files.maxPartitionBytes": 32 << 20,
}

# Partitions that are small are joined, large ones are not cut: with a fixed number of them a task grows with the
# tables. So shuffles start from one partition for so many bytes of the files a query reads, 300,000 invoice lines.
SHUFFLE_BYTES = 4 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

SETTINGS = {
    **SKEW_SETTINGS,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def split_hot_keys(spark: SparkSession) -> None:
    """Makes a session it did not build meet skewed joins the way the operators rely on.

    The settings stay: queries are lazy and need them when they run. Bring ``spark.newSession()`` to keep
    another session's settings as they are.
    """
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)


def _bytes(size: str) -> int:
    """A size as Spark's settings give it: ``67108864``, ``64m``, ``64MB``."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def bound_tasks(spark: SparkSession, input_bytes: int = 0) -> None:
    """Lowers the sizes of ``TASK_BYTES`` in a session, and raises the partitions its shuffles start from to one for
    each ``SHUFFLE_BYTES`` of input; smaller sizes and larger numbers stay as they are."""
    for key, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    least = -(-input_bytes // SHUFFLE_BYTES)
    if least > int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(least))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wattledger")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
