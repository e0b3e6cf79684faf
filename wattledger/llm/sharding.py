"""Documents dealt to shards by rendezvous hashing. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.llm._shared import stored, table

SHARDS = 16


def draw(key: Column, shard: Column) -> Column:
    """A number in (0, 1) that key and shard alone decide: the leading 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws(":", key, shard.cast("string")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard with the highest score for a key; the smaller number on a tie.

    A shard's score is ``-weight / ln(draw)``, so it is chosen in proportion to its weight, and its score
    for a key depends on no other shard. A new shard therefore takes keys from all others and no key
    moves between old ones; removing a shard moves its keys alone. A null key is a key like any other.
    """
    if not weights or any(not 0 < w < float("inf") for w in weights):
        raise ValueError("every shard needs a positive weight")
    named = F.coalesce(key.cast("string"), F.lit("null"))
    table_of = F.array(*[F.lit(float(w)) for w in weights])
    scores = F.transform(
        table_of, lambda w, i: F.struct((-w / F.log(draw(named, i))).alias("score"), (-i).alias("less"), i.alias("shard"))
    )
    return F.array_max(scores)["shard"]


def number_within(rows: DataFrame, group: str, order: list[str], slot: str = "slot") -> DataFrame:
    """Numbers the rows of each group from 0 without a gap, in the given order.

    A group may be a large part of the table, so the rows are dealt out by ranges of group and order, each
    range is numbered on its own, and the sizes of those before it add up to where it starts. Rows that
    agree in all of this are told apart by where they were read, so repeats of one row fill no range of
    their own. The numbers depend on the values alone. The rows are written first, so that drawing the ranges
    does not read the input again, and once more when numbered, as both steps must see the same ranges.
    """
    from pyspark.sql import Window

    ranged = stored(rows).withColumn("__read", F.monotonically_increasing_id()).repartitionByRange(group, *order, "__read")
    inside = Window.partitionBy(group, "__range").orderBy(*order)
    numbered = stored(
        ranged.drop("__read").withColumn("__range", F.spark_partition_id()).withColumn("__n", F.row_number().over(inside).cast("long") - 1)
    )
    before = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        numbered.groupBy(group, "__range")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(group, "__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    )
    placed = numbered.join(starts, [group, "__range"]).withColumn(slot, F.col("__start") + F.col("__n"))
    return placed.select(*[c for c in rows.columns if c != slot], slot)


def assign_shards(docs: DataFrame, weights: list[float], id_col: str = "doc_id", shard: str = "shard") -> DataFrame:
    """The rows with the shard of their id beside them (replacing a column of that name).

    Nothing is shuffled. Rows that share an id share a shard; so do all rows without one.
    """
    return docs.withColumn(shard, rendezvous(F.col(id_col), weights))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``key``: doc_id and the number of shards decide, texts do not."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sharded = assign_shards(docs, [1.0] * SHARDS)
    grown = assign_shards(sharded, [1.0] * (SHARDS + 1), shard="grown_shard")
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = grown.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "grown_shard",
    )
    numbered = number_within(narrow, "shard", ["doc_id", "text_crc32", "size"])
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n, encode(coalesce(text, '')) AS bytes FROM documents
), listed AS (
  SELECT doc_id, n, list_transform(range(1, n + 1), lambda i: CAST('0x' || hex(bytes[i:i]) AS BIGINT)) AS codes FROM docs
), summed AS (
  -- Fixed values: what each bit of the lowest byte leaves in the remainder.
  SELECT doc_id, n + 1 AS size, xor(4294967295, list_reduce(codes, lambda c, d: xor(c >> 8, list_bit_xor([
           (xor(c, d) & 1) * 1996959894, (xor(c, d) >> 1 & 1) * 3993919788, (xor(c, d) >> 2 & 1) * 124634137,
           (xor(c, d) >> 3 & 1) * 249268274, (xor(c, d) >> 4 & 1) * 498536548, (xor(c, d) >> 5 & 1) * 997073096,
           (xor(c, d) >> 6 & 1) * 1994146192, (xor(c, d) >> 7 & 1) * 3988292384])), 4294967295)) AS text_crc32
  FROM listed
), drawn AS (
  SELECT doc_id, size, text_crc32,
         list_transform(range(17), lambda s: md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || s)[1:13]) AS draws
  FROM summed
), sharded AS (
  SELECT doc_id, size, text_crc32,
         list_position(draws[1:16], list_max(draws[1:16])) - 1 AS shard, list_position(draws, list_max(draws)) - 1 AS grown_shard
  FROM drawn
)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM sharded
"""
