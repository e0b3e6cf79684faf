"""Folders that files are dropped into: each file is loaded once, damaged lines are set aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.schemas import Table
from wattledger.sources.files import conform

DAMAGED = "damaged_line"


def _as_written(table: Table) -> T.StructType:
    """The declared columns, all of which a line may leave empty, bits as 0/1, and the line where it is damaged."""
    kinds = [T.StructField(f.name, T.IntegerType() if isinstance(f.dataType, T.BooleanType) else f.dataType) for f in table.schema.fields]
    return T.StructType([*kinds, T.StructField(DAMAGED, T.StringType())])


_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": DAMAGED,
    # The number of values is judged on whole lines.
    "columnPruning": "false",
    # The declared names are applied by position; a header of another length is caught line by line.
    "enforceSchema": "true",
}


def read_lines(spark: SparkSession, path: str, table: Table, wide: bool = False) -> DataFrame:
    """CSV lines typed to the table, with ``damaged_line``: the text of a line with a value of another type or
    another number of values, whose columns are then NULL. Good and damaged lines add up to those given."""
    return _typed(spark.read.schema(_as_written(table)).options(**_OPTIONS).csv(path), table, wide)


def _typed(lines: DataFrame, table: Table, wide: bool) -> DataFrame:
    # The scan converts the columns it is asked for and sees damage in no other. This condition always holds
    # and asks for all of them, so that a line is damaged or not whatever is read of it.
    converted = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in table.schema.names])) >= 0
    judged = lines.withColumn(DAMAGED, F.when(converted, F.col(DAMAGED)))
    sound = F.col(DAMAGED).isNull()
    typed = conform(judged, table, wide, (DAMAGED,))
    return typed.select(*[F.when(sound, F.col(c)).alias(c) for c in table.schema.names], DAMAGED)


def good_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.col(DAMAGED).isNull()).drop(DAMAGED)


def damaged_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.col(DAMAGED).isNotNull()).select(DAMAGED)


def load_new_files(spark: SparkSession, folder: str, table: Table, out: str, wide: bool = False) -> None:
    """Loads the lines of those files of ``folder`` that were not loaded before into ``out``, damaged ones included.

    A file source with a checkpoint remembers files, and the file sink lists what each batch committed, so a
    load that is repeated adds nothing, one that died half way is finished without copies, and a file dropped
    later is all that the next load reads. Files must not change once they are there. The stream ends when
    the files at hand are used up.
    """
    lines = _typed(spark.readStream.schema(_as_written(table)).options(**_OPTIONS).csv(folder), table, wide)
    writer = lines.writeStream.format("parquet").outputMode("append").option("path", f"{out}/lines")
    writer.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def loaded(spark: SparkSession, out: str) -> DataFrame:
    """What was loaded, as ``read_lines`` gives it; files of a batch that never committed are not read."""
    return spark.read.parquet(f"{out}/lines")
