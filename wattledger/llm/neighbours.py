"""Approximate nearest neighbours: a small-world graph for each shard, shard results merged."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattledger.llm._shared import stored, table

SHARD_ROWS = 4000
#: Components that one block of queries holds, 8 bytes each.
QUERY_VALUES = 500_000
LINKS = 16
BUILD_WIDTH = 64
SEARCH_WIDTH = 80


@dataclass
class Graph:
    """Vectors and, by level and vector, the neighbours in one flat array; -1 fills up. The lowest level has 2 * links."""

    vectors: np.ndarray
    levels: np.ndarray
    flat: np.ndarray
    links: int
    entry: int

    def __post_init__(self) -> None:
        self.seen = np.zeros(len(self.vectors), np.int64)
        self.turn = 0

    def row(self, level: int, node: int) -> np.ndarray:
        n, m = len(self.vectors), self.links
        at = node * 2 * m if level == 0 else n * 2 * m + ((level - 1) * n + node) * m
        return self.flat[at : at + (2 * m if level == 0 else m)]

    def distances(self, query: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        apart = self.vectors[nodes] - query
        return np.einsum("ij,ij->i", apart, apart)

    def search(self, query: np.ndarray, entries: list[tuple[float, int]], width: int, level: int) -> list[tuple[float, int]]:
        """The nearest ``width`` found on a level, nearest first, going on from the nearest not yet visited."""
        self.turn += 1
        seen, turn = self.seen, self.turn
        for _, node in entries:
            seen[node] = turn
        ahead = list(entries)
        heapq.heapify(ahead)
        best = [(-d, node) for d, node in entries]
        heapq.heapify(best)
        while ahead:
            distance, node = heapq.heappop(ahead)
            if distance > -best[0][0] and len(best) >= width:
                break
            near = self.row(level, node)
            near = near[near >= 0]
            near = near[seen[near] != turn]
            if not len(near):
                continue
            seen[near] = turn
            found = self.distances(query, near)
            limit = -best[0][0] if len(best) >= width else np.inf
            for d, other in zip(found.tolist(), near.tolist(), strict=True):
                if d < limit or len(best) < width:
                    heapq.heappush(ahead, (d, other))
                    heapq.heappush(best, (-d, other))
                    if len(best) > width:
                        heapq.heappop(best)
                    limit = -best[0][0]
        return sorted((-d, node) for d, node in best)

    def nearest(self, query: np.ndarray, width: int) -> list[int]:
        """From the top level down, then the best of the lowest."""
        entry = [(float(self.distances(query, np.array([self.entry]))[0]), self.entry)]
        for level in range(int(self.levels[self.entry]), 0, -1):
            entry = self.search(query, entry, 1, level)
        return [node for _, node in self.search(query, entry, width, 0)]


def spread(graph: Graph, found: list[tuple[float, int]], most: int) -> list[tuple[float, int]]:
    """Of the nearest found those that are not nearer to one already taken, then the others, up to ``most``."""
    if len(found) <= most:
        return found
    points = graph.vectors[[node for _, node in found]]
    squares = np.einsum("ij,ij->i", points, points)
    apart = squares[:, None] + squares[None, :] - 2 * points @ points.T
    taken: list[int] = []
    closest = np.full(len(found), np.inf)
    for k, (distance, _) in enumerate(found):
        if closest[k] > distance:
            taken.append(k)
            closest = np.minimum(closest, apart[k])
            if len(taken) == most:
                break
    held = set(taken)
    rest = [k for k in range(len(found)) if k not in held]
    return [found[k] for k in (taken + rest)[:most]]


def build(vectors: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, seed: int = 3) -> Graph:
    """Inserts the vectors one after the other. A level holds about one in ``links`` of the one below."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    levels = np.floor(-np.log(1 - rng.random(n)) / np.log(links)).astype(np.int64)
    top = int(levels.max())
    graph = Graph(vectors, levels, np.full(n * 2 * links + top * n * links, -1, np.int32), links, 0)
    lengths: list[np.ndarray] = [np.full((n, 2 * links if level == 0 else links), np.inf, np.float32) for level in range(top + 1)]
    for node in range(1, n):
        query = vectors[node]
        entry = [(float(graph.distances(query, np.array([graph.entry]))[0]), graph.entry)]
        for level in range(int(levels[graph.entry]), int(levels[node]), -1):
            entry = graph.search(query, entry, 1, level)
        for level in range(min(int(levels[node]), int(levels[graph.entry])), -1, -1):
            entry = graph.search(query, entry, width, level)
            chosen = spread(graph, entry, links)
            own, far = graph.row(level, node), lengths[level]
            for k, (distance, other) in enumerate(chosen):
                own[k], far[node, k] = other, distance
                # A full list gives up its longest link.
                slot = int(far[other].argmax())
                if distance < far[other, slot]:
                    graph.row(level, other)[slot], far[other, slot] = node, distance
        if levels[node] > levels[graph.entry]:
            graph.entry = node
    return graph


SHARD = "size int, shard int, vectors binary, ids array<array<bigint>>, levels binary, flat binary, entry int"


def scale(vectors: np.ndarray) -> float:
    """The power of two at the largest component, so that squares of what is divided by it neither overflow nor vanish."""
    return float(np.ldexp(1.0, int(np.frexp(np.abs(vectors).max())[1]) - 1))


def _build_shard(part: pa.Table) -> pa.Table:
    part = part.combine_chunks()
    size = part.column("size")[0].as_py()
    vectors = np.array(part.column("vector").to_pylist(), np.float64).reshape(-1, size)
    order = np.lexsort(vectors.T[::-1])
    graph = build(vectors[order] / scale(vectors))
    row = {
        "size": size,
        "shard": part.column("shard")[0].as_py(),
        "vectors": vectors[order].tobytes(),
        "ids": part.column("ids").take(pa.array(order)).to_pylist(),
        "levels": graph.levels.tobytes(),
        "flat": graph.flat.tobytes(),
        "entry": graph.entry,
    }
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.list_(pa.int64())), pa.binary(), pa.binary(), pa.int32()]
    return pa.table([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))


def _search_shard(k: int, width: int):
    names = ["query_id", "row", "vec_id", "score"]

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if index.num_rows and queries.num_rows:
            shard = index.to_pylist()[0]
            vectors = np.frombuffer(shard["vectors"]).reshape(-1, shard["size"])
            levels, flat = np.frombuffer(shard["levels"], np.int64), np.frombuffer(shard["flat"], np.int32)
            unit = scale(vectors)
            graph = Graph(vectors / unit, levels, flat, LINKS, shard["entry"])
            for query in queries.to_pylist():
                at = np.array(query["vector"], np.float64)
                nodes = graph.nearest(at / unit, width)
                scores = np.sqrt(((vectors[nodes] - at) ** 2).sum(axis=1))
                pairs = sorted((float(s), i) for s, n in zip(scores, nodes, strict=True) for i in shard["ids"][n] if i != query["vec_id"])
                found += [(query["vec_id"], query["row"], i, s) for s, i in pairs[:k]]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array([f[j] for f in found], kind) for j, kind in enumerate(kinds)], names=names)

    return run


def usable(vector: Column) -> Column:
    """Vectors that have a direction: no nulls, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    width: int = SEARCH_WIDTH,
    shard_rows: int = SHARD_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """For each row that ``queries`` picks its ``k`` nearest other rows found: query_id, rank (from 1), vec_id
    and score, the Euclidean distance of the vectors as given in double precision; ties to the smaller id.

    Rows without an id, and vectors that are null, zero or hold null or non-finite components take no part.
    Vectors are compared with those of their own length. Equal rows count once; rows that share an id but
    not a vector are searched and found each by itself, never by one another.

    Equal vectors are one node of the graph with their ``k`` + 1 smallest ids, all that any query can ask
    for, picked before they are shuffled. Nodes are dealt to shards of about ``shard_rows`` by their
    hash, and each shard's graph is built in a task of its own and stored as flat arrays. Queries go to all
    shards of their length in blocks of ``QUERY_VALUES`` components, about the size of a shard; a block meets a
    shard in one task and gives back ``k`` rows for each query.

    What is broadcast is one row for each length of vector: m different lengths take m * (m + 1) / 2
    components at the least, so there are fewer of them than the square root of twice the components.
    """
    given = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), queries.alias("asked")
    )
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    first = given.select("vec_id", "vector").distinct().withColumn("n", rank).where(F.col("n") <= k + 1)
    nodes = stored(first.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("size", F.size("vector")))
    asked = stored(
        given.where("asked").select("vec_id", "vector").distinct().withColumn("row", F.xxhash64("vec_id", "vector")).withColumn("size", F.size("vector"))
    )
    one = F.count(F.lit(1))
    lengths = stored(
        nodes.groupBy("size")
        .agg(F.greatest(F.lit(1), F.round(one / shard_rows)).cast("int").alias("shards"))
        .join(asked.groupBy("size").agg(F.ceil(one * F.col("size") / QUERY_VALUES).cast("int").alias("blocks")), "size")
    )
    total = lengths.agg(F.sum("shards")).first()[0] or 1
    # The shards of a length go to neighbouring tasks, each to its own.
    dealt = nodes.join(F.broadcast(lengths), "size").withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int"))
    task = F.pmod(F.pmod(F.xxhash64("size"), F.lit(total)) + F.col("shard"), F.lit(total)).cast("int")
    index = stored(
        dealt.select("size", "shard", "vector", "ids", task.alias("task"))
        .repartitionById(total, "task")
        .groupBy("task", "size", "shard")
        .applyInArrow(_build_shard, SHARD)
    )
    block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    met = index.join(F.broadcast(lengths), "size").select(*index.columns, block)
    sent = asked.join(F.broadcast(lengths), "size").select(
        "vec_id",
        "row",
        "vector",
        "size",
        F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
        F.pmod(F.col("row"), F.col("blocks")).cast("int").alias("block"),
    )
    found = met.groupBy("size", "shard", "block").cogroup(sent.groupBy("size", "shard", "block")).applyInArrow(
        _search_shard(k, width), "query_id bigint, row bigint, vec_id bigint, score double"
    )
    order = Window.partitionBy("query_id", "row").orderBy("score", "vec_id")
    merged = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return merged.select("query_id", "rank", "vec_id", "score")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
