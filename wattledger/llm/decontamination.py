"""Benchmark passages in documents: a join on the rarest words in a row of each window, then exact words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattledger.llm._shared import bound_batches, fingerprint, lower_ascii, release, stored, table
from wattledger.llm._words import ALNUM, groups

WINDOW = 13
SHINGLE = 3
FILTER_BITS = 2**25
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    split = F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS, -1)
    return F.filter(split, lambda w: w != "")


def _shingles_of(column: int, longest: int):
    """The hashes of a window's shingles and where in the window they start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, int]] = []
            for group in groups(batch.column(column), ALNUM):
                by_length = {n: group.shingles(n)[0] for n in np.unique(np.minimum(np.diff(group.bounds), longest)).tolist()}
                for i in range(len(group.bounds) - 1):
                    n = int(group.bounds[i + 1] - group.bounds[i])
                    hashes = by_length[min(n, longest)]
                    for offset in range(n - min(n, longest) + 1):
                        rows.append((group.first + i, int(hashes[group.bounds[i] + offset].astype(np.int64)), offset))
            taken = batch.take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32())],
                names=[*batch.schema.names, "hash", "offset"],
            )

    return run


def _bits(hashes: DataFrame) -> np.ndarray:
    """Marks of a set of hashes in a field of ``FILTER_BITS`` bits, the same size for any set."""
    slot = F.col("hash").bitwiseAND(FILTER_BITS - 1)
    rows = (
        hashes.select(F.shiftright(slot, 6).cast("int").alias("at"), slot.bitwiseAND(63).cast("int").alias("bit"))
        .groupBy("at")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .toArrow()
    )
    field = np.zeros(FILTER_BITS // 64, np.int64)
    field[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return field.view(np.uint8)


def _passing(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = (hashes & np.uint64(FILTER_BITS - 1)).astype(np.int64)
    return (field[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _occurrences(field, lengths: list[int]):
    """Counts of the shingles in the field, by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for group in groups(batch.column(0), ALNUM):
                for n in lengths:
                    hashes, inside = group.shingles(n)
                    found.append(hashes[inside & _passing(field.value, hashes)])
            hashes, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], names=["hash", "n"])
        release()

    return run


def _candidates(field, lengths: list[int], window: int):
    """Per document its number of words, and for each shingle in the field the words around it."""
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int64()), ("before", pa.int32()), ("around", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in groups(batch.column(batch.num_columns - 1), ALNUM):
                n_words = np.diff(group.bounds)
                hits: list[list[dict]] = [[] for _ in n_words]
                for n in lengths:
                    hashes, inside = group.shingles(n)
                    for k in np.flatnonzero(inside & _passing(field.value, hashes)):
                        i = int(np.searchsorted(group.bounds, k, "right")) - 1
                        low, high = max(int(group.bounds[i]), k - window + 1), min(int(group.bounds[i + 1]), k + window)
                        around = " ".join(group.word(j) for j in range(low, high))
                        at = int(k - group.bounds[i])
                        hits[i].append({"hash": int(hashes[k].astype(np.int64)), "at": at, "before": k - low, "around": around})
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(group.first, len(hits)).columns[:-1], pa.array(n_words, pa.int64()), pa.array(hits, kind)],
                    names=[*batch.schema.names[:-1], "n_words", "hits"],
                )
        release()

    return run


def find_items(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``id_col``, ``fp`` (with the id it names a row), ``n_words``, ``n_hit`` (words
    inside an occurrence of any item's window) and ``items`` (ids of items with occurring windows, as
    sorted strings; empty, not null).

    A window is ``window`` words of an item in a row; a shorter item is one window, one without words
    none. Null and empty texts have no words. Ids may be null and may repeat: documents are told apart by
    id and text, equal rows come back as often as they are given; item rows of one id are one item, and
    those without an id are the item "null".

    All shingles of ``shingle`` words of a window stand in a document that holds the window, so one of
    them is enough to find it: the one that is rarest among all documents. A window with a shingle that no
    document holds is dropped. A bit field of fixed size keeps other shingles of the documents out of the
    shuffles; what it lets through wrongly is sorted out by the joins. A document's shingle carries the
    words around it, so a candidate that leaves room for the window on both sides is verified word by
    word. The joins carry nothing else and may be split at frequent shingles.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    listed = items.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), words(F.col(text_col)).alias("words")
    ).where(F.size("words") > 0)
    firsts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    windows = stored(
        listed.select("item", "words", F.explode(firsts).alias("first"))
        .select("item", F.array_join(F.slice("words", F.col("first"), window), " ").alias("window"))
        .distinct()
    )
    shingles = stored(
        windows.select("window")
        .distinct()
        .withColumn("n", F.size(F.split("window", " ")))
        .mapInArrow(_shingles_of(0, shingle), "window string, n int, hash bigint, offset int")
    )
    lengths = sorted({min(r.n, shingle) for r in shingles.select(F.least("n", F.lit(shingle)).alias("n")).distinct().collect()})

    text = F.col(text_col).cast("string").alias("text")
    field = spark.sparkContext.broadcast(_bits(shingles))
    counts = (
        docs.select(text).mapInArrow(_occurrences(field, lengths), "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("found"))
    )
    rarest = (
        shingles.join(counts, "hash", "left")
        .groupBy("window", "n")
        .agg(F.min(F.struct(F.coalesce("found", F.lit(0)).alias("found"), "hash", "offset")).alias("r"))
        .where("r.found > 0")
        .select("window", "n", "r.hash", "r.offset")
    )
    rarest = stored(rarest)
    field = spark.sparkContext.broadcast(_bits(rarest))
    id_type = docs.schema[id_col].dataType.simpleString()
    hit = "struct<hash:bigint,at:bigint,before:int,around:string>"
    base = stored(
        docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col)).alias("fp"), text).mapInArrow(
            _candidates(field, lengths, window), f"id {id_type}, fp struct<a:bigint,b:bigint>, n_words bigint, hits array<{hit}>"
        )
    )
    start = F.col("at") - F.col("offset")
    there = F.slice(F.split("around", " "), F.col("before") - F.col("offset") + 1, F.col("n"))
    found = stored(
        base.select("id", "fp", "n_words", F.inline("hits"))
        .distinct()
        .join(rarest, "hash")
        .where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
        .where(F.array_join(there, " ") == F.col("window"))
        .select("id", "fp", start.alias("start"), "n", "window")
    )
    earlier = Window.partitionBy("id", "fp").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.groupBy("id", "fp", "start").agg(F.max(F.col("start") + F.col("n")).alias("end"))
    covered = (
        spans.withColumn("reached", F.greatest(F.col("start"), F.coalesce(F.max("end").over(earlier), F.lit(0))))
        .groupBy("id", "fp")
        .agg(F.sum(F.greatest(F.col("end") - F.col("reached"), F.lit(0))).alias("n_hit"))
    )
    held = (
        found.select("id", "fp", "window")
        .distinct()
        .join(windows, "window")
        .groupBy("id", "fp")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    marked = covered.join(held, covered.id.eqNullSafe(held.id) & (covered.fp == held.fp)).select(
        covered.id.alias("cid"), covered.fp.alias("cfp"), "n_hit", "items"
    )
    return base.join(marked, F.col("id").eqNullSafe(F.col("cid")) & (F.col("fp") == F.col("cfp")), "left").select(
        F.col("id").alias(id_col),
        "fp",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def contaminated() -> Column:
    """A document counts as contaminated when a twentieth of its words are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


ORACLE = r"""
WITH doc AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
  FROM documents
), item AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
  FROM benchmark
), item_window AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i:i + 12], ' ') AS win
  FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 12, 1))) AS i FROM item WHERE len(ws) > 0)
), doc_window AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i
        FROM doc, (SELECT DISTINCT n FROM item_window) WHERE len(ws) >= n)
), match AS (
  SELECT doc_id, i, d.n, item_id FROM doc_window d JOIN item_window w ON d.win = w.win
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM match) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS item_list
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM match) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(item_list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
