"""Ranked lexical search: impact vectors in buckets by length, bounds that leave few of them, exact scores."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattledger.llm._shared import lower_ascii, stored, table
from wattledger.llm._words import ALNUM, groups

TOP = 10
#: Items are searched for in blocks of about so many bytes; the words of a block are what every task holds.
BLOCK_BYTES = 4_000_000
#: A bucket is complete with so many documents or so many entries of their vectors.
BUCKET_DOCS, BUCKET_ENTRIES = 4096, 1_000_000
#: The longest vectors, which are searched first so that all others meet a threshold.
FIRST_DOCS = 4096
#: Sums of doubles that bound a score may come out lower by less than this part.
SLACK = 1 + 1e-9


@dataclass(frozen=True)
class Items:
    """A block of items: their ids, and for each the terms (by number) with how often it names them.

    Terms are numbered in the order of their hashes. ``weights`` are 0 until the corpus is counted.
    """

    numbers: pa.Array
    ids: pa.Array
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    hashes: np.ndarray
    lengths: np.ndarray
    weights: np.ndarray


def _hashed(terms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    found = list(groups(pa.array(terms, pa.string()), ALNUM))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([g.hashes for g in found]), np.concatenate([g.ends - g.starts for g in found])


def _items(rows: list) -> Items:
    words = sorted({t for r in rows for t in r["terms"]})
    hashes, lengths = _hashed(words)
    order = np.argsort(hashes)
    number = {words[w]: k for k, w in enumerate(order)}
    counted = [np.unique(np.array([number[t] for t in r["terms"]], np.int64), return_counts=True) for r in rows]
    return Items(
        pa.array([r["number"] for r in rows], pa.int64()),
        pa.array([r["item"] for r in rows]),
        [c[0] for c in counted],
        [c[1].astype(np.int64) for c in counted],
        hashes[order],
        lengths[order],
        np.zeros(len(words), np.int64),
    )


def _counted(items: Items):
    """Per document its number of terms, and the items' terms in it with their counts."""
    vocabulary, size = items.hashes, max(len(items.hashes), 1)
    lists = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, bounds, terms, counts = [], [np.zeros(1, np.int64)], [], []
            for group in groups(batch.column(1), ALNUM):
                docs = len(group.bounds) - 1
                totals.append(np.diff(group.bounds))
                at = np.minimum(np.searchsorted(vocabulary, group.hashes), size - 1)
                known = (vocabulary[at] == group.hashes) & (items.lengths[at] == group.ends - group.starts) if len(vocabulary) else np.zeros(len(at), bool)
                of = np.repeat(np.arange(docs), np.diff(group.bounds))[known]
                keys, n = np.unique(of * size + at[known], return_counts=True)
                terms.append(keys % size)
                counts.append(n)
                bounds.append(bounds[-1][-1] + np.cumsum(np.bincount(keys // size, minlength=docs)))
            offsets = pa.array(np.concatenate(bounds), pa.int32())
            joined = lambda parts: pa.array(np.concatenate(parts) if parts else [], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.concatenate(totals) if totals else [], pa.int64()),
                    pa.ListArray.from_arrays(offsets, joined(terms)).cast(lists),
                    pa.ListArray.from_arrays(offsets, joined(counts)).cast(lists),
                ],
                names=["id", "n", "terms", "counts"],
            )

    return run


def _impacts(weights: np.ndarray, documents: int, words: int):
    """The vectors of impacts, weights included, with their lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy()
            terms, starts = _flat(batch.column(2))
            tf = batch.column(3).flatten().to_numpy().astype(np.int64)
            m = 100 - 75 + (75 * n * documents) // words
            impact = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(starts))))
            # Of each row by itself: differences of running sums would lose the small ones.
            squares = np.append(impact.astype(np.float64) ** 2, 0.0)
            size = np.where(np.diff(starts) > 0, np.add.reduceat(squares, starts[:-1]), 0.0) if len(n) else np.zeros(0)
            lists = lambda v: pa.ListArray.from_arrays(pa.array(starts, pa.int32()), v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.sqrt(size)), lists(pa.array(terms, pa.int32())), lists(pa.array(impact, pa.int64()))],
                names=["id", "length", "terms", "impacts"],
            )

    return run


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All entries, and where each row's start."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])


class _Best:
    """The best of one item so far: highest scores first, then smallest ids."""

    def __init__(self, floor: int, top: int):
        self.floor, self.top = floor, top
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def threshold(self) -> int:
        """What a score must reach."""
        return max(self.floor, int(self.scores[-1]) if len(self.scores) == self.top else 1)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.top]
        self.scores, self.ids = scores[order], ids[order]


class _Bucket:
    """Vectors of nearly one length, also as lists by term."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray):
        self.ids, self.lengths, self.starts, self.terms, self.impacts = ids, lengths, starts, terms, impacts
        order = np.argsort(terms, kind="stable")
        self.docs = np.repeat(np.arange(len(ids)), np.diff(starts))[order]
        self.values = impacts[order]
        self.named, firsts = np.unique(terms[order], return_index=True)
        self.firsts = np.append(firsts, len(terms))
        self.highest = np.maximum.reduceat(self.values, firsts) if len(firsts) else self.values

    def search(self, terms: np.ndarray, repeats: np.ndarray, length: float, best: _Best) -> None:
        """Coordinates with the largest products first, as far as the rest can still reach the threshold."""
        if length * self.lengths[0] * SLACK < best.threshold:
            return
        at = np.searchsorted(self.named, terms)
        here = (at < len(self.named)) & (self.named[np.minimum(at, len(self.named) - 1)] == terms) if len(self.named) else np.zeros(len(terms), bool)
        at, repeats = at[here], repeats[here]
        product = repeats * self.highest[at]
        order = np.argsort(-product, kind="stable")
        at, repeats, product = at[order], repeats[order], product[order]
        # What the coordinates from each on can add: by their largest products, and by Cauchy and Schwarz.
        left = np.append(np.cumsum(product[::-1])[::-1], 0)
        rest = np.sqrt(np.append(np.cumsum((repeats.astype(np.float64) ** 2)[::-1])[::-1], 0.0))
        focus = int(np.argmax(np.minimum(left, rest * self.lengths[0] * SLACK) < best.threshold))
        if not focus:
            return
        taken = [slice(self.firsts[a], self.firsts[a + 1]) for a in at[:focus]]
        docs = np.concatenate([self.docs[s] for s in taken])
        values = np.concatenate([self.values[s] for s in taken]).astype(np.float64)
        times = np.repeat(repeats[:focus], [s.stop - s.start for s in taken])
        partial = np.bincount(docs, values * times, len(self.ids))
        seen = np.bincount(docs, values**2, len(self.ids))
        beyond = np.sqrt(np.maximum(self.lengths**2 * SLACK - seen, 0.0)) * rest[focus]
        bound = (partial + np.minimum(beyond, float(left[focus]))) * SLACK
        survivors = np.flatnonzero((partial > 0) & (bound >= best.threshold))
        if len(survivors):
            scores = self._scores(survivors, terms, here, at, repeats)
            good = scores >= best.threshold
            best.add(scores[good], self.ids[survivors[good]])

    def _scores(self, docs: np.ndarray, terms: np.ndarray, here: np.ndarray, at: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        """Products of whole numbers over all coordinates."""
        sizes = self.starts[docs + 1] - self.starts[docs]
        ends = np.cumsum(sizes)
        entries = np.arange(int(ends[-1])) + np.repeat(self.starts[docs] - (ends - sizes), sizes)
        asked = self.named[at]
        order = np.argsort(asked)
        place = np.minimum(np.searchsorted(asked[order], self.terms[entries]), len(asked) - 1)
        match = asked[order][place] == self.terms[entries]
        parts = np.where(match, repeats[order][place] * self.impacts[entries], 0)
        return np.add.reduceat(parts, ends - sizes)


def _buckets(batch: pa.RecordBatch) -> Iterator[_Bucket]:
    ids = batch.column(0).fill_null(np.iinfo(np.int64).min).to_numpy()
    lengths = batch.column(1).to_numpy()
    terms, starts = _flat(batch.column(2))
    impacts = batch.column(3).flatten().to_numpy()
    first = 0
    while first < len(ids):
        full = int(np.searchsorted(starts, starts[first] + BUCKET_ENTRIES, "right")) - 1
        last = min(max(full, first + 1), first + BUCKET_DOCS, len(ids))
        low, high = starts[first], starts[last]
        yield _Bucket(ids[first:last], lengths[first:last], starts[first : last + 1] - low, terms[low:high], impacts[low:high])
        first = last


def _searched(items: Items, floors: np.ndarray, top: int):
    """The best of each item among a task's vectors, which come longest first."""
    norms = [float(np.sqrt((r.astype(np.float64) ** 2).sum())) for r in items.repeats]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(int(floor), top) for floor in floors]
        for batch in batches:
            for bucket in _buckets(batch):
                for k, found in enumerate(best):
                    bucket.search(items.terms[k], items.repeats[k], norms[k], found)
        of = np.repeat(np.arange(len(best)), [len(b.scores) for b in best])
        joined = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
        ids = joined([b.ids for b in best])
        yield pa.RecordBatch.from_arrays(
            [
                items.numbers.take(pa.array(of)),
                items.ids.take(pa.array(of)),
                pa.array(ids, pa.int64(), mask=ids == np.iinfo(np.int64).min),
                pa.array(joined([b.scores for b in best]), pa.int64()),
            ],
            names=["number", "item", "doc", "score"],
        )

    return run


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_first("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search_block(docs: DataFrame, items: Items, item_kind: str, top: int) -> DataFrame | None:
    spark = docs.sparkSession
    counted = stored(docs.mapInArrow(_counted(items), "id bigint, n bigint, terms array<int>, counts array<int>"))
    corpus = counted.where("n > 0").agg(F.count("*").alias("documents"), F.sum("n").alias("words")).first()
    if not corpus.documents:
        return None
    weights = np.zeros(len(items.hashes), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        weights[r["term"]] = math.floor(1000 * math.log((2 * corpus.documents + 2) / (2 * r["count"] + 1)))
    vectors = (
        counted.mapInArrow(_impacts(weights, corpus.documents, corpus.words), "id bigint, length double, terms array<int>, impacts array<bigint>")
        .where("length > 0")
        .withColumn("place", F.monotonically_increasing_id())
        # The place deals out vectors of one length, such as those of copies.
        .repartitionByRange(F.desc("length"), "place")
        .sortWithinPartitions(F.desc("length"))
        .drop("place")
    )
    vectors = stored(vectors)
    lengths = vectors.select("length").orderBy(F.desc("length")).limit(FIRST_DOCS)
    cut = lengths.agg(F.min("length").alias("cut")).first().cut
    if cut is None:
        return None
    kind = f"number bigint, item {item_kind}, doc bigint, score bigint"
    search = lambda rows, floors: rows.mapInArrow(_searched(items, floors, top), kind)
    number = {n: k for k, n in enumerate(items.numbers.to_pylist())}
    floors = np.ones(len(number), np.int64)
    first = stored(_ranked(search(vectors.where(F.col("length") >= cut), floors), top).drop("rank"))
    for r in first.groupBy("number").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == top).collect():
        floors[number[r.number]] = r.least
    return first.unionByName(search(vectors.where(F.col("length") < cut), floors))


def rank_documents(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """For each item its ``top`` highest-scoring documents with a score above 0: ``item_col``, ``rank`` (from 1),
    ``id_col`` and ``score``, equal scores by ascending id (a null id first).

    Terms are the runs of letters, digits and non-ASCII characters of whole texts, A-Z lower-cased; a null or
    empty text has none. The score is that of the contract, in whole numbers. Every row of the documents is a
    document, also where ids are null or repeat; ids are whole numbers. Item rows equal in id and text are
    one item; one id with two texts is ranked twice. Empty tables and items without terms give no rows.

    Only terms of items matter to a product, so a document's vector holds their impacts alone. Vectors are
    ordered by length and searched in buckets, the longest first: an item passes by a bucket when its length
    times the bucket's cannot reach the item's tenth best so far; inside, the coordinates with the largest
    products are read until what is left cannot reach it, a document must reach it with the most its other
    coordinates can add, and what survives is scored anew over all coordinates. All bounds err upwards, so
    the result is exact. Items come in blocks of bounded size, and with them what each task is sent; words
    are told apart by 64-bit hashes and their lengths.
    """
    spark = docs.sparkSession
    item_kind, kind = items.schema[item_col].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
    terms = F.filter(F.split(lower_ascii(F.col("text")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", -1), lambda t: t != "")
    listed = items.select(F.col(item_col).alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    listed = stored(listed.withColumn("number", F.monotonically_increasing_id()))
    total = listed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + total // BLOCK_BYTES
    corpus = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = []
    for block in range(blocks):
        rows = listed.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).select("number", "item", terms.alias("terms"))
        held = rows.where(F.size("terms") > 0).collect()
        part = _search_block(corpus, _items(held), item_kind, top) if held else None
        if part is not None:
            found.append(stored(_ranked(part, top)) if blocks > 1 else _ranked(part, top))
    if not found:
        return spark.createDataFrame([], f"{item_col} {item_kind}, rank int, {id_col} {kind}, score bigint")
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    return every.select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc").cast(kind).alias(id_col), "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS terms FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id, terms FROM (SELECT DISTINCT item_id, text, {_TERMS} AS terms FROM benchmark) once),
asked AS (SELECT i, term, count(*) AS q FROM (SELECT i, unnest(terms) AS term FROM items) listed GROUP BY 1, 2),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_words FROM docs WHERE len(terms) > 0),
postings AS (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) listed
  WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY 1) counted, corpus
), impacts AS (
  SELECT d, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(terms) * n_docs) // n_words))) AS impact
  FROM postings JOIN weights USING (term) JOIN docs USING (d), corpus
), ranked AS (
  SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank
  FROM (SELECT i, d, doc_id, CAST(sum(q * impact) AS BIGINT) AS score
        FROM asked JOIN impacts USING (term) GROUP BY 1, 2, 3) scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN items USING (i) WHERE rank <= 10
"""
