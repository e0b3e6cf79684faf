"""Near duplicates: bottom-k sketches, inverted lists of their values, and exact Jaccard similarity."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from wattledger.llm._components import components
from wattledger.llm._shared import bound_batches, fingerprint, release, stored, table
from wattledger.llm._words import SPACED, Group, groups, mix

SKETCH = 64
MISSED = 1e-8
CELL_DOCS = 800
CELL_BYTES = 6_000_000
PART_VALUES = 2**18
BLOCK_ROWS = 256


def fewest_common(k: int, percent: int) -> int:
    """Values of the k smallest of a union that two sets similar by ``percent`` share, but for a chance of ``MISSED``."""
    p, below = percent / 100, 0.0
    for c in range(k + 1):
        below += comb(k, c) * p**c * (1 - p) ** (k - c)
        if below > MISSED:
            return c
    return k


def least_shared(size: np.ndarray, k: int | None, percent: int) -> np.ndarray:
    """Values that the sketch of a set of this size shares with that of any set linked with it; without
    ``k`` the sketch is the set."""
    common = -(-size * percent // 100)
    return common if k is None else np.minimum(common, fewest_common(k, percent))


def shingle_sets(group: Group, n: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingles as sorted hashes; all words as one where there are fewer than n."""
    hashes, _ = group.shingles(n)
    for low, high in zip(group.bounds[:-1], group.bounds[1:], strict=True):
        if high - low >= n:
            yield np.unique(hashes[low : high - n + 1])
        elif high > low:
            short = Group(0, np.array([0, high - low]), group.hashes[low:high], group.starts, group.ends, group.lowered)
            yield short.shingles(int(high - low))[0]
        else:
            yield np.zeros(0, np.uint64)


def _sketches(words: int, k: int | None):
    """Per document the size of its set, a 128-bit digest of it and its k smallest hashes, or all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in groups(batch.column(batch.num_columns - 1), SPACED):
                rows: list[tuple[int, int, int]] = []
                sketches: list[np.ndarray] = []
                for hashes in shingle_sets(group, words):
                    one, two = (int(np.sum(mix(hashes + np.uint64(s)), dtype=np.uint64).view(np.int64)) for s in (1, 2))
                    rows.append((len(hashes), one, two))
                    # Copied: a view would keep the whole set.
                    sketches.append(hashes[:k].view(np.int64).copy())
                columns = [pa.array([r[j] for r in rows], pa.int64()) for j in range(3)]
                lists = pa.array(sketches, pa.list_(pa.int64()))
                given = batch.slice(group.first, len(rows)).columns[:-1]
                yield pa.RecordBatch.from_arrays([*given, *columns, lists], names=[*batch.schema.names[:-1], "n", "one", "two", "sketch"])
        release()

    return run


def _parts(sets: list[np.ndarray], size: int) -> Iterator[list[np.ndarray]]:
    """Sorted sets of hashes cut at the same hashes, to about ``size`` values of all of them together."""
    n = max(1, -(-sum(map(len, sets)) // size))
    edges = np.array([2**64 * p // n for p in range(1, n)], np.uint64)
    cuts = [[0, *np.searchsorted(s, edges).tolist(), len(s)] for s in sets]
    for p in range(n):
        yield [s[c[p] : c[p + 1]] for s, c in zip(sets, cuts, strict=True)]


def shared_counts(sets: list[np.ndarray], width: int = 1024) -> np.ndarray:
    """How many values each pair of sorted sets has in common, by products of 0/1 matrices over a few values at a time."""
    total = np.zeros((len(sets), len(sets)), np.float32)
    present = np.zeros((len(sets), width), np.float32)
    for part in _parts(sets, PART_VALUES):
        _, column, counts = np.unique(np.concatenate(part), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in part])
        several = counts[column] > 1
        row, column = row[several], np.cumsum(counts > 1)[column[several]] - 1
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, [low, low + width])
            present[:] = 0
            present[row[a:b], column[a:b] - low] = 1
            for at in range(0, len(sets), BLOCK_ROWS):
                total[at : at + BLOCK_ROWS] += present[at : at + BLOCK_ROWS] @ present.T
    return total.astype(np.int32)


def union_sketch(sketches: np.ndarray, i: np.ndarray, j: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of sketches (rows, filled up with the largest value): size of the union's sketch, and how
    many of its values both have."""
    both = np.sort(np.concatenate([sketches[i], sketches[j]], axis=1), axis=1)
    real = both != np.uint64(2**64 - 1)
    twice = np.zeros_like(real)
    twice[:, 1:] = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
    rank = np.cumsum(real & ~twice, axis=1)
    within = real & (rank <= k)
    return np.minimum(rank[:, -1], k), (twice & within).sum(axis=1)


def likely_pairs(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, k: int, percent: int) -> np.ndarray:
    """Which pairs have enough in common in the sketch of their union."""
    padded = np.full((len(sets), k), 2**64 - 1, np.uint64)
    for at, values in enumerate(sets):
        padded[at, : min(k, len(values))] = values[:k]
    likely = np.zeros(len(i), bool)
    for low in range(0, len(i), 5_000):
        part = slice(low, low + 5_000)
        size, common = union_sketch(padded, i[part], j[part], k)
        likely[part] = common >= least_shared(size, k, percent)
    return likely


def linked(sets: list[np.ndarray], k: int | None, percent: int) -> np.ndarray:
    """Which pairs of sets are linked, as a symmetric matrix. Pairs are looked at in blocks of rows, so that what
    is held of all of them at once is their counts and which are left."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    need = least_shared(sizes, k, percent)
    counts = shared_counts([s[:k] for s in sets])
    left = np.zeros((n, n), bool)
    for low in range(0, n, BLOCK_ROWS):
        i, j = np.nonzero(np.triu(counts[low : low + BLOCK_ROWS] >= np.minimum(need[low : low + BLOCK_ROWS, None], need), low + 1))
        i += low
        fits = 100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j])
        i, j = i[fits], j[fits]
        if k is not None:
            likely = likely_pairs(sets, i, j, k, percent)
            i, j = i[likely], j[likely]
        left[i, j] = True
    del counts
    used = np.flatnonzero(left.any(axis=0) | left.any(axis=1))
    common = shared_counts([sets[u] for u in used]) if len(used) else None
    for low in range(0, len(used), BLOCK_ROWS):
        rows, both = used[low : low + BLOCK_ROWS], common[low : low + BLOCK_ROWS].astype(np.int64)
        left[np.ix_(rows, used)] &= 100 * both >= percent * (sizes[rows, None] + sizes[used] - both)
    left |= left.T
    return left


def _cell_links(words: int, k: int | None, percent: int, id_kind: pa.DataType):
    """Links of one cell that connect what its links connect: each text with the first of those it reaches."""
    node = pa.struct([("id", id_kind), ("one", pa.int64())])

    def run(cell: pa.Table) -> pa.Table:
        sets = [s for group in groups(cell.column("text").combine_chunks(), SPACED) for s in shingle_sets(group, words)]
        reach = linked(sets, k, percent)
        np.fill_diagonal(reach, True)
        first = np.arange(len(sets))
        blocks = range(0, len(sets), BLOCK_ROWS)
        while True:
            lower = np.concatenate([np.where(reach[b : b + BLOCK_ROWS], first[None, :], len(sets)).min(axis=1) for b in blocks])
            lower = lower[lower]
            if (lower == first).all():
                break
            first = lower
        del sets, reach
        release()
        at = np.flatnonzero(first != np.arange(len(first)))
        nodes = cell.column("node").combine_chunks()
        return pa.table({"u": nodes.take(pa.array(at)).cast(node), "v": nodes.take(pa.array(first[at])).cast(node)})

    return run


def near_duplicates(
    docs: DataFrame, words: int, percent: int, k: int | None = SKETCH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``id_col``, ``fp`` (with the id it names a row), ``n_shingles`` and
    ``component_id``, the smallest id reachable over links.

    Words are what white space separates, A-Z in lower case; a document is the set of its shingles of
    ``words`` words, or of all its words as one where it has fewer. Two are linked when their sets' common
    part is at least ``percent`` of their union. Null and empty texts and those of white space have no
    shingles and no links. Rows without an id take no part either: their component is null. Rows that
    repeat an id are documents of their own under that id.

    Documents with equal sets are one class and go on as one row. A class keeps its k smallest hashes.
    Linked classes share at least a known number of them (but for a chance of ``MISSED`` for a pair just at
    the threshold), so they also share one of those that are rarest in the corpus: only that many of the
    rarest enter the inverted lists. Passages common to very many documents are not among them unless
    they are most of a document. Overlapping lists form candidate groups, held together by a link of each
    list's members to its first, never by pairs. A candidate group is compared in cells of bounded size:
    sketch overlap, then the union's sketch, then the full sets decide. Large groups are first cut by
    length, as linked sets differ little in it, then dealt to cells of two parts each. A cell gives
    back no pairs but one link for each text that reaches another.

    With ``k`` None nothing is left to chance: every hash of a set is kept, the lists hold as many of its
    rarest as a linked set cannot all lack, and cells compare full sets at once. It stores and shuffles
    eight bytes for each distinct shingle.
    """
    bound_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col)).alias("fp"), F.col(text_col).cast("string").alias("text"))
    sketched = stored(
        named.mapInArrow(
            _sketches(words, k),
            f"id {id_type}, fp struct<a:bigint,b:bigint>, n bigint, one bigint, two bigint, sketch array<bigint>",
        )
    )
    part = F.struct("one", "two")
    having = sketched.where("n > 0 AND id IS NOT NULL")
    # The row whose text stands for the class is fixed by id and fingerprint, so repeats of it are one.
    classes = stored(
        having.groupBy("one", "two")
        .agg(F.min(F.struct("id", "fp", "n", "sketch")).alias("r"))
        .select(F.struct("r.id", "one").alias("node"), "one", "two", "r.id", "r.fp", "r.n", "r.sketch")
    )
    values = classes.select("node", "n", F.explode("sketch").alias("value"))
    several = values.groupBy("value").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    size, shared = F.col("n"), F.ceil(F.col("n") * percent / 100)
    if k is not None:
        size, shared = F.least(size, F.lit(k)), F.least(shared, F.lit(fewest_common(k, percent)))
    rarest = F.array_sort(F.collect_list(F.struct("held", "value")))
    # Values no other class has are rarer than all others: they use up places without making a list.
    places = size - shared + 1 - (size - F.size("lists"))
    lists = stored(
        values.join(several, "value")
        .groupBy("node", "n")
        .agg(rarest.alias("lists"))
        .where(places > 0)
        .select("node", F.explode(F.slice("lists", F.lit(1), places.cast("int"))).alias("list"))
        .select("node", F.col("list.value").alias("value"))
    )
    firsts = lists.groupBy("value").agg(F.min("node").alias("v"))
    overlaps = lists.join(firsts, "value").where("node <> v").select(F.col("node").alias("u"), "v").distinct()
    candidates = components(overlaps).withColumnRenamed("component", "blob")
    members = stored(candidates.join(classes.select("node", "id", "fp", "n"), "node"))

    texts = named.where("id IS NOT NULL").withColumn("bytes", F.octet_length("text"))
    held = stored(members.join(texts, ["id", "fp"]).dropDuplicates(["node"]).select("node", "blob", "n", "bytes", "text"))
    fill = F.ceil(F.greatest(F.count(F.lit(1)) / CELL_DOCS, F.sum("bytes") / CELL_BYTES)).cast("int")
    blobs = held.groupBy("blob").agg(fill.alias("blob_parts"))
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent))).cast("int")
    zoned = (
        held.select("node", "blob", "n", "bytes")
        .join(blobs, "blob")
        # Linked sets differ by one step at most; a zone is two neighbouring steps.
        .withColumn("zone", F.explode(F.when(F.col("blob_parts") > 1, F.array(step - 1, step)).otherwise(F.array(F.lit(0)))))
    )
    parts = zoned.groupBy("blob", "zone").agg(F.greatest(fill, F.lit(1)).alias("parts"))
    mine = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("parts") - 1)))
    dealt = (
        zoned.join(parts, ["blob", "zone"])
        .select("node", "blob", "zone", mine.alias("mine"), other.alias("other"))
        .select("node", "blob", "zone", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"))
        .distinct()
    )
    cells = dealt.join(held.select("node", "text"), "node")
    links = (
        cells.groupBy("blob", "zone", "low", "high")
        .applyInArrow(
            _cell_links(words, k, percent, to_arrow_type(docs.schema[id_col].dataType)),
            f"u struct<id:{id_type},one:bigint>, v struct<id:{id_type},one:bigint>",
        )
        .distinct()
    )
    found = components(links)
    joined = classes.select("node", "one", "two").join(found, "node", "left")
    grouped = joined.select("one", "two", F.coalesce("component", "node").alias("component"))
    return (
        sketched.select("id", "fp", "n", "one", "two")
        .withColumn("__none", (F.col("n") == 0) | F.col("id").isNull())
        .join(grouped.withColumn("__none", F.lit(False)), ["one", "two", "__none"], "left")
        .select(
            F.col("id").alias(id_col),
            "fp",
            F.col("n").alias("n_shingles"),
            F.when(F.col("__none"), F.col("id")).otherwise(F.col("component.id")).alias("component_id"),
        )
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS shingles
  FROM split
), members AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id AS node, doc_id AS other FROM sets
  UNION
  SELECT reached.node, links.v FROM reached JOIN links ON links.u = reached.other
), smallest AS (
  SELECT node, min(other) AS component_id FROM reached GROUP BY node
)
SELECT doc_id, len(shingles) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN smallest ON node = doc_id
"""
