"""Long byte strings that occur more than once, found by sparse suffix arrays over sampled places."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.llm._shared import stored, table
from wattledger.llm._words import mix, prefix_sums, spans_hash

LENGTH = 400
PIECE = 2**19
PLACE_BITS = np.uint64(2**20 - 1)
ARRAY_ROWS = 4000
FIELD_BITS = 2**25


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of all ``width`` neighbours, from running minima of whole blocks in both directions."""
    n = len(values) - width + 1
    full = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    full[: len(values)] = values
    rows = full.reshape(-1, width)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Sampled places of a text: each window of ``length`` bytes names the place in it where the string of
    half that length has the smallest hash, leftmost on a tie, so equal windows name the same place.

    Per place: where it is, how far the windows that name it reach to its left and its right, the hash of
    its string and a hash of all they cover.
    """
    half, out = length // 2, []
    for low in range(0, len(data) - length + 1, PIECE):
        part = data[low : low + PIECE + length - 1]
        sums = prefix_sums(part)
        at = np.arange(len(part) - half + 1)
        hashes = spans_hash(sums, at, at + half)
        named = sliding_min((hashes & ~PLACE_BITS) | at.astype(np.uint64), length - half + 1) & PLACE_BITS
        cuts = np.flatnonzero(np.diff(named)) + 1
        first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(named)]]) - 1
        place = named[first].astype(np.int64)
        left, right = place - first, last + length - place
        around = spans_hash(sums, first, last + length) + mix((left * length + right).astype(np.uint64))
        out.append((place + low, left, right, hashes[place], around))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else ()


def _anchor_rows(length: int):
    names = ["a", "b", "place", "left", "right", "string", "around"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(k).to_numpy() for k in (0, 1))
            held, size = [], 0
            for i in range(batch.num_rows + 1):
                if held and (size > 200_000 or i == batch.num_rows):
                    kinds = [np.int64, np.int64, np.int64, np.int32, np.int32, None, None]
                    columns = [np.concatenate(c) for c in zip(*held, strict=True)]
                    columns = [c.view(np.int64) if k is None else c.astype(k) for c, k in zip(columns, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
                    held, size = [], 0
                if i < batch.num_rows:
                    data = np.frombuffer(batch.column(2)[i].as_py().encode(), np.uint8)
                    if found := anchors(data, length):
                        held.append((np.full(len(found[0]), a[i]), np.full(len(found[0]), b[i]), *found))
                        size += len(found[0])

    return run


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the windows of a text's wanted places cover."""
    names = ["a", "b", "place", "left", "string", "around", "covered"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        rows: list[tuple] = []
        for i in range(batch.num_rows):
            data = batch.column(2)[i].as_py().encode()
            a, b = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            for w in batch.column(3)[i].as_py():
                start = w["place"] - w["left"]
                rows.append((a, b, w["place"], w["left"], w["string"], w["around"], data[start : w["place"] + w["right"]]))
                if len(rows) >= 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _padded(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in strings], np.int64)
    return np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(-1, width), lengths


def _common(rows: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefixes of neighbours in an order."""
    differ = rows[order[1:]] != rows[order[:-1]]
    same = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return np.minimum(same, np.minimum(lengths[order[1:]], lengths[order[:-1]]))


def intervals(prefixes: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Nodes of the common-prefix interval tree (depth, first, last), by one scan with a stack."""
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*prefixes.tolist(), 0]):
        first = i
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            if top >= least:
                yield top, first, i
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def repeats(left: list[bytes], right: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """Of strings that meet at a place (what is before it reversed, what is after): for each that has ``length``
    bytes around the place in common with another, which it is and how far they reach to either side.

    The suffixes from the places are sorted; a node of their interval tree is a set of places with the
    same bytes after them, as many as its depth, whatever neighbours they have. A node is a maximal repeat
    to the right; to the left its members differ, so they are put in order by what is before them, and
    each goes as far as it agrees with any other member of the node.
    """
    half = length - length // 2
    after, after_len = _padded(right, length)
    before, before_len = _padded(left, half)
    order = np.array(sorted(range(len(right)), key=right.__getitem__))
    rank = np.empty(len(left), np.int64)
    rank[sorted(range(len(left)), key=left.__getitem__)] = np.arange(len(left))
    out = []
    for depth, first, last in intervals(_common(after, after_len, order), length - half):
        members = order[first : last + 1]
        members = members[before_len[members] >= length - depth]
        if len(members) < 2:
            continue
        members = members[np.argsort(rank[members])]
        shared = _common(before, before_len, members)
        reach = np.maximum(np.append(shared, 0), np.insert(shared, 0, 0))
        for k in np.flatnonzero(reach >= length - depth):
            out.append((int(members[k]), int(reach[k]), depth))
    return out


def _array_spans(length: int):
    names = ["a", "b", "start", "end"]

    def run(part: pa.Table) -> pa.Table:
        seen, rows = set(), []
        for r in part.to_pylist():
            if (r["string"], r["around"]) not in seen:  # equal rows of documents share their places
                seen.add((r["string"], r["around"]))
                rows.append(r)
        left = [r["covered"][: r["left"]][::-1] for r in rows]
        right = [r["covered"][r["left"] :] for r in rows]
        found = [(rows[i]["a"], rows[i]["b"], rows[i]["place"] - l, rows[i]["place"] + r) for i, l, r in repeats(left, right, length)]
        return pa.table([pa.array([f[k] for f in found], pa.int64()) for k in range(4)], names=names)

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for i in range(batch.num_rows):
            data = batch.column(1)[i].as_py().encode()
            kept, runs, at = [], [], 0
            for start, end in sorted((s["start"], s["end"]) for s in batch.column(2)[i].as_py() or []):
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = max(end, runs[-1][1])
                else:
                    runs.append([start, end])
            for start, end in runs:
                kept.append(data[at:start])
                at = end
            kept.append(data[at:])
            out.append((len(data), sum(e - s for s, e in runs), [{"start": s, "end": e} for s, e in runs], b"".join(kept)))
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types = [pa.int64(), pa.int64(), spans, pa.binary()]
        columns = [pa.array([o[k] for o in out], t) for k, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[batch.schema.names[0], "n_bytes", "n_removed", "spans", "kept"])


def likely_in(rows: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """The rows whose value is among ``values``, with some others: a bit field of fixed size, at most
    ``FIELD_BITS`` / 64 rows whatever there is, is broadcast instead of the values."""
    slot = F.col(column).bitwiseAND(FIELD_BITS - 1)
    at, bit = F.shiftright(slot, 6).cast("int"), slot.bitwiseAND(63).cast("int")
    field = (
        values.select(at.alias("__at"), bit.alias("__bit")).groupBy("__at").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    )
    marked = rows.withColumns({"__at": at, "__bit": bit}).join(F.broadcast(field), "__at")
    return marked.where(F.expr("shiftrightunsigned(__bits, __bit) & 1 = 1")).select(*rows.columns)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", array_rows: int = ARRAY_ROWS
) -> DataFrame:
    """One row per document: ``id_col``, ``n_bytes``, ``n_removed``, ``spans`` (the maximal runs removed, as
    start and end in bytes) and ``kept`` (the bytes left, which may start or end inside a character).

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else too: in another row,
    in an equal row, or in the same text, overlaps included. Null texts are empty; texts shorter than
    ``length`` keep all. Ids may be null or repeat, every row is a document of its own.

    Every window names a place, about a hundred bytes from the next, and equal windows name the same.
    A place is known by the hash of the string at it and by a hash of all its windows. Places with both
    in common are repeated as a whole: they are counted, not gathered, so groups of copies cost nothing
    more. For each string with different surroundings one text of each kind is gathered, and suffix
    arrays over about ``array_rows`` such places find how far they agree. A string with more kinds than
    that goes another exact way, so no task holds it whole: its windows are hashed one by one and counted.
    The texts are shuffled once, for both joins.
    """
    half = length // 2
    key = [F.xxhash64(F.lit(k), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))) for k in (1, 2)]
    named = docs.select(
        F.col(id_col).alias("id"), key[0].alias("a"), key[1].alias("b"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    places = stored(
        named.select("a", "b", "text").mapInArrow(
            _anchor_rows(length), "a bigint, b bigint, place bigint, left int, right int, string bigint, around bigint"
        )
    )
    # Most strings occur once; as long as the field is not full, their places go no further.
    often = stored(places.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string"))
    places = likely_in(places, "string", often)
    kinds = places.groupBy("string", "around").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("a", "b", "place", "left", "right")).alias("one")
    )
    kinds = stored(kinds)
    several = kinds.groupBy("string").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n")).where("n > 1").select("string", "kinds")
    repeated = stored(kinds.join(several, "string"))
    copied = (
        places.join(repeated.where("n > 1").select("string", "around"), ["string", "around"])
        .select("a", "b", (F.col("place") - F.col("left")).alias("start"), (F.col("place") + F.col("right")).alias("end"))
    )
    differing = repeated.where("kinds > 1").select("kinds", "string", "around", "one.*")
    arrays = max(1, -(-differing.count() // array_rows))
    wanted = differing.groupBy("a", "b").agg(F.collect_list(F.struct("place", "left", "right", "string", "around")).alias("wanted"))
    texts = named.hint("merge")
    covered = stored(
        texts.join(wanted, ["a", "b"])
        .select("a", "b", "text", "wanted")
        .mapInArrow(_contexts, "a bigint, b bigint, place bigint, left int, string bigint, around bigint, covered binary")
    )
    hot = repeated.where(F.col("kinds") > array_rows).select("string").distinct()
    by_array = (
        covered.join(hot, "string", "left_anti")
        .groupBy(F.pmod(F.xxhash64("string"), F.lit(arrays)).alias("array"))
        .applyInArrow(_array_spans(length), "a bigint, b bigint, start bigint, end bigint")
    )
    windows = (
        covered.join(hot, "string")
        .dropDuplicates(["string", "around"])
        .select("a", "b", (F.col("place") - F.col("left")).alias("from"), "covered", F.explode(F.sequence(F.lit(1), F.length("covered") - length + 1)).alias("at"))
        .select("a", "b", (F.col("from") + F.col("at") - 1).alias("start"), F.md5(F.substr("covered", F.col("at"), F.lit(length))).alias("digest"))
    )
    twice = windows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    by_window = windows.join(twice, "digest").select("a", "b", "start", (F.col("start") + length).alias("end"))
    spans = (
        copied.unionByName(by_array)
        .unionByName(by_window)
        .groupBy("a", "b", "start")
        .agg(F.max("end").alias("end"))
        .groupBy("a", "b")
        .agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )
    id_type = docs.schema[id_col].dataType.simpleString()
    run = "array<struct<start:bigint,end:bigint>>"
    return (
        texts.join(spans, ["a", "b"], "left")
        .select(F.col("id").alias(id_col), "text", "spans")
        .mapInArrow(_remove, f"{id_col} {id_type}, n_bytes bigint, n_removed bigint, spans {run}, kept binary")
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_bytes") - F.col("n_removed")).alias("n_kept"),
    )


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, encode(coalesce(text, '')) AS bytes, strlen(coalesce(text, '')) AS n FROM documents
), windows AS (
  SELECT doc_id, place, md5(bytes[place + 1:place + 400]) AS digest
  FROM (SELECT doc_id, bytes, unnest(range(n - 399)) AS place FROM docs)
), again AS (
  SELECT doc_id, place, place > lag(place, 1, -500) OVER (PARTITION BY doc_id ORDER BY place) + 400 AS fresh
  FROM windows WHERE digest IN (SELECT digest FROM windows GROUP BY digest HAVING count(*) > 1)
), runs AS (
  SELECT doc_id, min(place) AS low, max(place) + 400 AS high
  FROM (SELECT doc_id, place, count(*) FILTER (fresh) OVER (PARTITION BY doc_id ORDER BY place) AS run FROM again)
  GROUP BY doc_id, run
), pieces AS (
  SELECT doc_id, low, high, lag(high, 1, 0) OVER (PARTITION BY doc_id ORDER BY low) AS since FROM runs
  UNION ALL
  SELECT doc_id, n, n, coalesce((SELECT max(high) FROM runs WHERE runs.doc_id = docs.doc_id), 0) FROM docs
)
SELECT docs.doc_id, any_value(n) AS n_bytes, sum(high - low)::BIGINT AS n_removed, count(*) FILTER (high > low) AS n_spans,
       sha256(unhex(string_agg(CASE WHEN low > since THEN hex(bytes[since + 1:low]) ELSE '' END, '' ORDER BY since, low))) AS kept_sha256,
       any_value(n) - sum(high - low)::BIGINT AS n_kept
FROM docs JOIN pieces ON pieces.doc_id = docs.doc_id
GROUP BY docs.doc_id
"""
