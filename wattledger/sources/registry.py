"""A stored map from ids of source systems to short keys that never change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PAIR = ("source_system", "natural_id")
SCHEMA = "source_system string, natural_id bigint, key bigint"


class KeyRegistry:
    """Keys 1, 2, 3 and on for (system, id) pairs, in the order of the pairs within each load.

    A load gives keys only to pairs that have none; the others keep theirs, so facts loaded earlier stay
    right whatever comes later and in whatever order. New pairs are sorted by ranges and stored, each range is
    numbered by itself from the sum of the counts before it, and only one count for each range reaches the
    driver. One load runs at a time. A load that died before its keys were appended left none.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def keys(self) -> DataFrame:
        self.spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(f"{self.root}/keys")
        return self.spark.read.schema(SCHEMA).parquet(f"{self.root}/keys")

    def register(self, pairs: DataFrame) -> int:
        """Gives keys to the pairs that have none; says how many there were. Pairs with a NULL get none."""
        known = self.keys()
        last = known.agg(F.max("key")).first()[0] or 0
        whole = pairs.select(F.col("source_system"), F.col("natural_id").cast("long").alias("natural_id")).dropna()
        unseen = whole.distinct().join(known.select(*PAIR), list(PAIR), "left_anti")
        staged = f"{self.root}/staged"
        ranged = unseen.repartitionByRange(*PAIR).withColumn("part", F.spark_partition_id())
        ranged.write.mode("overwrite").parquet(staged)
        new = self.spark.read.schema("source_system string, natural_id bigint, part int").parquet(staged)
        counts = sorted((r["part"], r["count"]) for r in new.groupBy("part").count().collect())
        first, total = {}, 0
        for part, count in counts:
            first[part], total = last + total, total + count
        if not total:
            return 0
        starts = F.create_map(*[F.lit(v) for part, start in first.items() for v in (part, start)])
        within = F.row_number().over(W.partitionBy("part").orderBy(*PAIR))
        numbered = new.withColumn("key", F.try_element_at(starts, F.col("part")) + within)
        numbered.select(*PAIR, F.col("key").cast("long").alias("key")).write.mode("append").parquet(f"{self.root}/keys")
        return total

    def keyed(self, rows: DataFrame) -> DataFrame:
        """Rows with source_system and natural_id, and the key of the pair; NULL where it has none."""
        return rows.join(self.keys(), list(PAIR), "left")
