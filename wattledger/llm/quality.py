"""A quality score for whole texts: a small convolutional network over bytes, in numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.llm._shared import bound_batches, release, stored, table

CHUNK = 256
STEP = 128
BLOCK = 64
WIDTH = 6
FILTERS = 12
TRAIN_ROWS = 1600
EPOCHS = 12
BATCH_ROWS = 32
SAMPLE_PARTS = 4
#: Chunks whose responses are held at a time.
SLICE_CHUNKS = 1024
THRESHOLD = 0.7
GROUP_BYTES = 500_000


def chunk_starts(length: int) -> np.ndarray:
    """Every byte is in a chunk, and but for the ends in two."""
    return np.arange(0, max(length - STEP, 1), STEP)


@dataclass
class Network:
    """Filters of ``WIDTH`` bytes, their largest value in each chunk, then the mean and the maximum over chunks."""

    filters: np.ndarray  # WIDTH, 256, FILTERS
    bias: np.ndarray
    weights: np.ndarray  # 2 * FILTERS
    offset: float

    def __post_init__(self) -> None:
        # Sums for two bytes in a row, so that a position takes half the lookups.
        pairs = range(0, WIDTH, 2)
        self.pairs = [(self.filters[k][:, None, :] + self.filters[k + 1][None, :, :]).reshape(65536, -1) for k in pairs]

    def respond(self, data: np.ndarray) -> np.ndarray:
        """Each filter at each position but the last ``WIDTH``."""
        two = data[:-1].astype(np.int32) * 256 + data[1:]
        n = len(data) - WIDTH
        out = self.pairs[0][two[:n]]
        for k in range(1, WIDTH // 2):
            out += self.pairs[k][two[2 * k : 2 * k + n]]
        return out

    def scores(self, texts: list[bytes]) -> list[float]:
        """Of texts laid one after the other, each filled up to whole blocks with zero bytes."""
        blocks = [max(1, -(-len(t) // BLOCK)) for t in texts]
        data = b"".join(t + bytes(n * BLOCK + BLOCK - len(t)) for t, n in zip(texts, blocks, strict=True)) + bytes(WIDTH)
        tops = []
        for low in range(0, len(data) - WIDTH, GROUP_BYTES // BLOCK * BLOCK):
            part = np.frombuffer(data[low : low + GROUP_BYTES // BLOCK * BLOCK + WIDTH], np.uint8)
            tops.append(self.respond(part).reshape(-1, BLOCK, FILTERS).max(axis=1))
        top, at, out = np.concatenate(tops), 0, []
        per = CHUNK // BLOCK
        for text, n in zip(texts, blocks, strict=True):
            starts = chunk_starts(len(text)) // BLOCK
            own = np.concatenate([top[at : at + n], np.full((per, FILTERS), -np.inf, np.float32)])
            pooled = np.max([own[starts + k] for k in range(per)], axis=0)
            out.append(self.combine(np.maximum(pooled + self.bias, 0)))
            at += n + 1
        return out

    def combine(self, chunks: np.ndarray) -> float:
        z = float(np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)]) @ self.weights + self.offset)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _chunks(text: bytes) -> np.ndarray:
    """All chunks of a text, one a row, each with the bytes that filters reach beyond it."""
    data = np.frombuffer(text + bytes(CHUNK + WIDTH), np.uint8)
    return np.lib.stride_tricks.sliding_window_view(data, CHUNK + WIDTH)[chunk_starts(len(text))]


def _strongest(network: Network, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where in each chunk each filter responds most, and with what."""
    places, values = [], []
    for low in range(0, len(chunks), SLICE_CHUNKS):
        part = chunks[low : low + SLICE_CHUNKS]
        flat = np.concatenate([part.ravel(), np.zeros(WIDTH, np.uint8)])
        response = network.respond(flat).reshape(len(part), -1, FILTERS)[:, :CHUNK]
        place = response.argmax(axis=1)
        places.append(place)
        values.append(np.take_along_axis(response, place[:, None], 1)[:, 0])
    return np.concatenate(places), np.concatenate(values)


def train(
    samples: Callable[[int], Iterator[tuple[bytes, int]]], weight: dict[int, float], epochs: int = EPOCHS, seed: int = 7
) -> Network:
    """Adam over batches of documents. ``samples`` gives those of an epoch, whole texts and labels, one by one."""
    rng = np.random.default_rng(seed)
    parameters = {
        "filters": rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "weights": rng.normal(0, 0.3, 2 * FILTERS).astype(np.float32),
        "offset": np.zeros(1, np.float32),
    }
    first = {k: np.zeros_like(v) for k, v in parameters.items()}
    second = {k: np.zeros_like(v) for k, v in parameters.items()}
    step = 0
    for epoch in range(epochs):
        given = samples(epoch)
        while batch := list(islice(given, BATCH_ROWS)):
            each = [_chunks(text) for text, _ in batch]
            chunks = np.concatenate(each)
            owner = np.repeat(np.arange(len(batch)), [len(c) for c in each])
            edges = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
            label = np.array([y for _, y in batch], np.float32)
            network = Network(parameters["filters"], parameters["bias"], parameters["weights"], float(parameters["offset"][0]))
            place, value = _strongest(network, chunks)
            pooled = np.maximum(value + parameters["bias"], 0)
            counts = np.bincount(owner)[:, None]
            mean, top = np.add.reduceat(pooled, edges) / counts, np.maximum.reduceat(pooled, edges)
            z = np.concatenate([mean, top], axis=1) @ parameters["weights"] + parameters["offset"]
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) * np.array([weight[int(y)] for y in label]) / len(batch)
            slope = error[:, None] * parameters["weights"][None]
            is_top = pooled == top[owner]
            grad = (slope[:, :FILTERS] / counts)[owner] + slope[:, FILTERS:][owner] * is_top
            grad = np.where(pooled > 0, grad, 0).astype(np.float32)
            by_filter = np.zeros_like(parameters["filters"])
            for k in range(WIDTH):
                seen = np.take_along_axis(chunks, place + k, 1).astype(np.int64) * FILTERS + np.arange(FILTERS)
                by_filter[k] = np.bincount(seen.ravel(), grad.ravel(), 256 * FILTERS).reshape(256, FILTERS)
            grads = {
                "filters": by_filter,
                "bias": grad.sum(axis=0),
                "weights": np.concatenate([mean, top], axis=1).T @ error,
                "offset": np.array([error.sum()]),
            }
            step += 1
            rate = 0.01 * (1 - epoch / epochs)
            for name, g in grads.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.999 * second[name] + 0.001 * g * g
                scale = np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8
                parameters[name] = (parameters[name] - rate * first[name] / (1 - 0.9**step) / scale).astype(np.float32)
    return Network(parameters["filters"], parameters["bias"], parameters["weights"], float(parameters["offset"][0]))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Network:
    """A network learned from the whole texts of ``rows`` labelled documents at most, half of each label (fewer
    where a label has fewer).

    ``labels`` has doc_id and label (0 or 1, others and nulls are left out). The documents are those whose
    ids hash lowest, so the same tables give the same sample; of rows that share an id, the one whose text
    hashes lowest stands for them, found before rows are shuffled. The loss weighs the labels as all of
    ``labels`` holds them. Without documents of both labels every score is one half.

    The sample is stored and read again for each epoch, part by part and in another order: the driver holds
    one part (``SAMPLE_PARTS``) of it, not the sample.
    """
    nothing = np.zeros((WIDTH, 256, FILTERS), np.float32)
    blank = Network(nothing, nothing[0, 0], np.zeros(2 * FILTERS, np.float32), 0.0)
    known = labels.where("label IN (0, 1) AND doc_id IS NOT NULL")
    totals = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return blank
    order = [F.xxhash64(F.lit("sample"), "doc_id"), F.col("doc_id")]
    picked = [known.where(F.col("label") == y).dropDuplicates(["doc_id"]).orderBy(*order).limit(rows // 2) for y in (0, 1)]
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    chosen = stored(
        docs.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
        .groupBy("doc_id", F.col("label").cast("int").alias("label"))
        .agg(one.alias("one"))
        .select("doc_id", "label", "one.text")
        .coalesce(SAMPLE_PARTS)
    )
    have = {r.label: r.n for r in chosen.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not have:
        return blank

    def samples(epoch: int) -> Iterator[tuple[bytes, int]]:
        turn = F.xxhash64(F.lit(epoch), "doc_id")
        for part in range(SAMPLE_PARTS):
            dealt = chosen.where(F.pmod(turn, F.lit(SAMPLE_PARTS)) == part).coalesce(1).sortWithinPartitions(turn, "doc_id", "label")
            for r in dealt.select("text", "label").toLocalIterator():
                yield r.text.encode(), r.label

    share = {y: totals[y] / sum(totals.values()) for y in (0, 1)}
    return train(samples, {y: share[y] * sum(have.values()) / have.get(y, 1) for y in (0, 1)})


def _score(network: Network, score_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores: list[float] = []
            held: list[bytes] = []
            size = 0
            for text in batch.column(batch.num_columns - 1):
                held.append((text.as_py() or "").encode())
                size += len(held[-1])
                if size > GROUP_BYTES:
                    scores += network.scores(held)
                    held, size = [], 0
            if held:
                scores += network.scores(held)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*batch.schema.names[:-1], score_col]
            )
        release()

    return run


def score(docs: DataFrame, network: Network, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The rows without the text and with ``score_col`` (replacing a column of that name), from 0 to 1.

    Only the text is read. All of it is, in chunks of 256 bytes that overlap by half. Null and empty texts
    score as one empty chunk does. Nothing is shuffled.
    """
    bound_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (text_col, score_col)]
    base = docs.select(*kept, F.col(text_col).cast("string").alias("__text"))
    return base.mapInArrow(_score(network, score_col), base.drop("__text").schema.add(score_col, "double"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Network:
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    return fit(docs.select("doc_id", "text"), labels)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit_on(spark, docs, sf_dir))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
