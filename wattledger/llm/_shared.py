"""What several operators need: tables between jobs and the columns that identify a row."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.sources.files import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\x0c\r"
BATCH_RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Writes a table into the folder all machines share and reads it back: the lineage ends here, and a
    lost executor costs no more than the tasks that were reading from it."""
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Lowers the rows that go to Python at once to ``BATCH_ROWS``: an executor holds such a batch of texts in
    the JVM, in buffers it doubles as it fills them and keeps, and again in Python.

    The setting stays: queries are lazy and need it when they run. A smaller one is kept.
    """
    if not 0 < int(spark.conf.get(BATCH_RECORDS)) <= BATCH_ROWS:
        spark.conf.set(BATCH_RECORDS, str(BATCH_ROWS))


def release() -> None:
    """Gives free memory back to the system: a Python worker lives on and serves later stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def fingerprint(text: Column) -> Column:
    """128 bits of a text as two longs; together with an id it names a row, also where ids repeat."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"))
