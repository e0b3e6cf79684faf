"""CSV files in and out, typed to the declared tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.schemas import Table


def stored_type(field: T.StructField, wide: bool) -> T.DataType:
    """Declared type, or with ``wide`` the one for more keys than INT and larger totals than 14 digits hold."""
    if wide and isinstance(field.dataType, T.IntegerType):
        return T.LongType()
    if wide and field.dataType == T.DecimalType(14, 2):
        return T.DecimalType(20, 2)
    return field.dataType


def conform(df: DataFrame, table: Table, wide: bool = False, more: tuple[str, ...] = ()) -> DataFrame:
    """The declared columns in the declared order and type, then ``more`` as they are; times lose their
    fraction of a second."""

    def typed(field: T.StructField):
        if isinstance(field.dataType, T.TimestampNTZType):
            # As text: date_trunc would pass through the session's time zone and its clock changes.
            return F.substring(F.col(field.name).cast("string"), 1, 19).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name).cast(stored_type(field, wide)).alias(field.name)

    return df.select(*[typed(f) for f in table.schema.fields], *more)


def read_csv(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """A headed CSV file or directory of them, split between tasks.

    Bits are written 0/1, which a boolean schema would silently read as NULL, so they are read as
    integers. Malformed lines and headers in another order fail the read instead of becoming NULLs.
    """
    on_disk = T.StructType(
        [
            T.StructField(f.name, T.IntegerType() if isinstance(f.dataType, T.BooleanType) else f.dataType)
            for f in table.schema.fields
        ]
    )
    rows = (
        spark.read.schema(on_disk)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return conform(rows, table)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Headed CSV without an index column, one file per task, bits as 0/1."""
    bits = {name: F.col(name).cast("int") for name, kind in df.dtypes if kind == "boolean"}
    df.withColumns(bits).write.mode(mode).option("header", True).csv(path)


def scratch_dir(spark: SparkSession) -> str:
    """A new folder every executor can reach: under ``spark.checkpoint.dir``, or local on one machine."""
    return new_folder(spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master)


_local_root = lru_cache(maxsize=1)(lambda: tempfile.mkdtemp(prefix="wattledger-"))


def own_dir(spark: SparkSession, name: str) -> str:
    """The folder of one query under the shared one, emptied of what its last run left.

    Results that are read from it lazily are gone with the next run of the same query.
    """
    shared, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not shared and not _is_local(master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = f"{shared.rstrip('/') if shared else _local_root()}/wattledger-{name}"
    system, path = _on_file_system(spark, folder)
    system.delete(path, True)
    return folder


def size_of(spark: SparkSession, folder: str) -> int:
    """Bytes of the files in a folder and below it."""
    system, path = _on_file_system(spark, folder)
    return system.getContentSummary(path).getLength()


def _on_file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def _is_local(master: str) -> bool:
    """One process with one disk; ``local-cluster`` has several."""
    return re.match(r"local(\[|$)", master) is not None


def new_folder(shared: str | None, master: str) -> str:
    if shared:
        return f"{shared.rstrip('/')}/wattledger-{uuid.uuid4().hex}"
    if not _is_local(master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.mkdtemp(prefix="wattledger-"), "scratch")
