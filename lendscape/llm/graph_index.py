"""Nearest neighbours by largest inner product, with a robust-pruned directed graph per shard.

Vectors are dealt to shards of about ``SHARD_ROWS``; every valid row is in one. Within a shard,
points are inserted in growing batches: a greedy beam search over the graph so far, begun at the
best of ``SEEDS`` random nodes, proposes neighbours, and relaxed pruning keeps a neighbour only if
no kept one is ``ALPHA`` times nearer to it than the point itself, so that ``DEGREE`` edges point
in diverse directions.

Vectors are put into bands of nearly one length, the longest at most ``BAND_RATIO`` times the
shortest, and a shard holds vectors of one band. Its graph is built on directions; within a band
the nearest directions are, but for that ratio, the largest inner products. Over lengths that
differ more, neither directions nor distances lead to them. Queries run in blocks against each
shard by beam search on inner products; the shards' best are merged, and scores are computed on
the original vectors in double precision.

Equal vectors are one graph node carrying its smallest ids; as a query can name no more than
``top`` of them besides itself, nothing is lost.

* Vectors that are NULL, zero, hold NULL or non-finite components, or have another length than
  most, take no part. NULL ids take no part.
* Fewer than ``top`` candidates: all of them. Equal scores rank by the smaller id.
* Repeated ids: each row is a candidate of its own vector; a query excludes its own id. Each
  query row gets its own ranks, also where several rows have one id.
* An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscape.llm import arrow as A

SHARD_ROWS = 16_384
BAND_RATIO = 1.1
SEEDS = 1024
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 160
ALPHA = 1.2
TOP = 20
_BATCH = 256
_EXPAND = 4
_STARTS = 16


class Graph:
    """A shard: float vectors, edges (-1 where fewer), and the nodes where searches may begin."""

    def __init__(self, x: np.ndarray, edges: np.ndarray, seeds: np.ndarray):
        self.x, self.edges, self.seeds = x, edges, seeds

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search for each query by largest inner product: node numbers (-1 where fewer)
        and products, best first."""
        n, b = len(self.x), len(queries)
        ids = np.full((b, beam), -1, np.int32)
        near = np.full((b, beam), -np.inf, np.float32)
        done = np.ones((b, beam), bool)
        seen = np.zeros((b, n + 1), bool)  # the last column stands for missing edges
        seen[:, n] = True
        # Tight clusters have few edges between them; the best of many seeds lie near the right one.
        first = min(_STARTS, beam, len(self.seeds))
        to_seed = queries @ self.x[self.seeds].T
        best = np.argpartition(-to_seed, first - 1, axis=1)[:, :first]
        rows = np.arange(b)
        ids[:, :first], near[:, :first] = self.seeds[best], np.take_along_axis(to_seed, best, 1)
        done[:, :first] = False
        seen[rows[:, None], ids[:, :first]] = True
        while len(rows):
            open_ = np.where(done[rows], -np.inf, near[rows])
            pick = np.argpartition(-open_, min(_EXPAND, beam) - 1, axis=1)[:, :_EXPAND]
            value = np.take_along_axis(open_, pick, 1)
            going = value.max(axis=1) > -np.inf
            rows, pick, value = rows[going], pick[going], value[going]
            if not len(rows):
                break
            chosen = np.where(value > -np.inf, ids[rows[:, None], pick], -1)
            done[rows[:, None], pick] = True
            new = np.where(chosen[:, :, None] >= 0, self.edges[chosen], -1).reshape(len(rows), -1)
            new = np.sort(np.where(new < 0, n, new), axis=1)
            fresh = ~seen[rows[:, None], new]
            fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
            seen[rows[:, None], new] = True
            width = int(fresh.sum(axis=1).max(initial=0))
            if not width:
                continue
            order = np.argsort(~fresh, axis=1, kind="stable")[:, :width]
            new, fresh = np.take_along_axis(new, order, 1), np.take_along_axis(fresh, order, 1)
            got = self.x[np.where(fresh, new, 0)]
            product = np.where(fresh, np.matmul(got, queries[rows][:, :, None])[:, :, 0], -np.inf)
            all_near = np.concatenate([near[rows], product.astype(np.float32)], axis=1)
            best = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
            near[rows] = np.take_along_axis(all_near, best, 1)
            ids[rows] = np.take_along_axis(np.concatenate([ids[rows], np.where(fresh, new, -1)], axis=1), best, 1)
            done[rows] = np.take_along_axis(np.concatenate([done[rows], ~fresh], axis=1), best, 1)
        return ids, near


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Up to ``DEGREE`` diverse neighbours for each point from its candidates (-1: none)."""
    c = np.where(candidates < 0, 0, candidates)
    vectors = x[c]
    norms = (x * x).sum(axis=1)
    to_point = norms[c] + norms[points][:, None] - 2 * np.matmul(vectors, x[points][:, :, None])[:, :, 0]
    to_point[(candidates < 0) | (candidates == points[:, None])] = np.inf
    order = np.argsort(to_point, axis=1, kind="stable")
    c, to_point = np.take_along_axis(c, order, 1), np.take_along_axis(to_point, order, 1)
    vectors = np.take_along_axis(vectors, order[:, :, None], 1)
    between = norms[c][:, :, None] + norms[c][:, None, :] - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
    alive = np.isfinite(to_point)
    alive[:, 1:] &= c[:, 1:] != c[:, :-1]
    out = np.full((len(points), DEGREE), -1, np.int32)
    rows = np.arange(len(points))
    for k in range(DEGREE):
        first = alive.argmax(axis=1)
        live = alive[rows, first]
        if not live.any():
            break
        out[live, k] = c[rows, first][live]
        alive &= ALPHA * ALPHA * between[rows, first] > to_point
        alive[rows, first] = False
    return out


def build(vectors: np.ndarray) -> Graph:
    """Graph over distinct vectors: built on their directions, to be searched on the vectors, which
    are scaled to a length of at most one."""
    most = np.abs(vectors).max(axis=1, keepdims=True)
    lengths = most * np.sqrt(((vectors / most) ** 2).sum(axis=1, keepdims=True))
    x = (vectors / lengths).astype(np.float32)
    n = len(x)
    order = np.random.default_rng(0).permutation(n)
    start = order[: min(n, _BATCH)]
    graph = Graph(x, np.full((n, DEGREE), -1, np.int32), start)
    graph.edges[start] = robust_prune(x, start, np.tile(start, (len(start), 1)))
    at = len(start)
    while at < n:
        points = order[at : at + min(_BATCH, at)]
        # Among directions the largest product is the smallest distance.
        found, _ = graph.search(x[points], BUILD_BEAM)
        graph.edges[points] = robust_prune(x, points, found)
        _add_reverse(graph, points)
        at += len(points)
        graph.seeds = order[: min(at, SEEDS)]
    graph.x = (vectors / lengths.max()).astype(np.float32)
    return graph


def _add_reverse(graph: Graph, points: np.ndarray) -> None:
    """Edges back to the new points, pruned where a node would get too many."""
    targets = graph.edges[points]
    source = np.repeat(points, DEGREE)[targets.ravel() >= 0]
    target = targets.ravel()[targets.ravel() >= 0]
    order = np.argsort(target, kind="stable")
    nodes, begin, count = np.unique(target[order], return_index=True, return_counts=True)
    width = int(count.max(initial=0))
    extra = np.full((len(nodes), width), -1, np.int32)
    place = np.arange(len(order)) - np.repeat(begin, count)
    extra[np.repeat(np.arange(len(nodes)), count), place] = source[order]
    for i in range(0, len(nodes), _BATCH):
        some = slice(i, i + _BATCH)
        used = int(count[some].max())
        both = np.concatenate([graph.edges[nodes[some]], extra[some, :used]], axis=1)
        full = (both >= 0).sum(axis=1) > DEGREE
        packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :DEGREE]
        if full.any():
            packed[full] = robust_prune(graph.x, nodes[some][full], both[full])
        graph.edges[nodes[some]] = packed


def valid_vectors(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(_id, _v) of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
    sound, some = (
        F.coalesce(~F.exists("_v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(False)),
        F.coalesce(F.exists("_v", lambda c: c != 0), F.lit(False)),
    )
    return rows.filter(F.col("_id").isNotNull() & F.col("_v").isNotNull() & sound & some)


def band(vector: str) -> Column:
    """Number of the band a vector's length lies in; a length of one is the middle of a band."""
    most = F.array_max(F.transform(vector, lambda c: F.abs(c)))
    square = F.aggregate(vector, F.lit(0.0), lambda acc, c: acc + (c / most) * (c / most))
    return F.floor((F.log(most) + F.log(square) / 2) / F.lit(math.log(BAND_RATIO)) + 0.5).cast("int")


_GRAPH = "shard int, n int, width int, x binary, edges binary, seeds binary, vectors binary, ids array<array<long>>"


def build_index(rows: DataFrame, shard_rows: int, keep: int) -> DataFrame:
    """A row per shard with its graph. ``keep`` ids are kept of equal vectors."""
    order = Window.partitionBy("_v").orderBy("_id")
    nodes = (
        rows.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= keep)
        .groupBy("_v")
        .agg(F.sort_array(F.collect_list("_id")).alias("ids"))
        .withColumn("_band", band("_v"))
    )
    nodes = A.staged(nodes, "nodes")
    # A row per band, of which the range of doubles allows some fifteen thousand.
    sizes = nodes.groupBy("_band").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("_parts"))
    after = Window.partitionBy(F.lit(0)).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_first", F.coalesce(F.sum("_parts").over(after), F.lit(0)))
    part = F.pmod(F.xxhash64(F.col("ids")[0]), F.col("_parts"))
    nodes = nodes.join(F.broadcast(sizes), "_band").select(
        (F.col("_first") + part).cast("int").alias("shard"), "_v", "ids"
    )

    def make(table: pa.Table) -> pa.Table:
        ids = table["ids"].to_pylist()
        order = sorted(range(len(ids)), key=lambda i: ids[i])
        table, ids = table.take(order), [ids[i] for i in order]
        vectors = np.array(table["_v"].to_pylist(), np.float64)
        graph = build(vectors)
        row = {
            "shard": table["shard"][0].as_py(),
            "n": len(ids),
            "width": vectors.shape[1],
            "x": graph.x.astype("<f4").tobytes(),
            "edges": graph.edges.astype("<i4").tobytes(),
            "seeds": graph.seeds.astype("<i4").tobytes(),
            "vectors": vectors.astype("<f8").tobytes(),
            "ids": ids,
        }
        kinds = [("shard", pa.int32()), ("n", pa.int32()), ("width", pa.int32()), ("x", pa.binary()),
                 ("edges", pa.binary()), ("seeds", pa.binary()), ("vectors", pa.binary()), ("ids", pa.list_(pa.list_(pa.int64())))]
        return pa.Table.from_pylist([row], schema=pa.schema(kinds))

    return A.staged(A.reachable(nodes).groupBy("shard").applyInArrow(make, _GRAPH), "graphs")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    top: int = TOP,
    id_col: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    beam: int = SEARCH_BEAM,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's nearest rows besides itself, found by beam
    search in every shard."""
    rows = valid_vectors(vectors, id_col, vector)
    sizes = rows.groupBy(F.size("_v").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), "width").first()
    width, n = (most["width"], most["n"]) if most else (0, 0)
    rows = rows.filter(F.size("_v") == width)
    graphs = build_index(rows, shard_rows, top + 1)
    asked = valid_vectors(vectors.filter(is_query), id_col, vector).filter(F.size("_v") == width)
    asked = A.staged(asked.withColumn("_row", F.monotonically_increasing_id()), "queries")
    blocks = max(1, math.ceil(n / shard_rows))  # of queries; grows with the rows, as queries do
    packed = (
        asked.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)))
        .groupBy("_block")
        .agg(F.sort_array(F.collect_list(F.struct("_row", "_id", "_v"))).alias("_queries"))
    )
    # Every block of queries meets every shard; blocks are given the shards' numbers, then join.
    last = graphs.agg(F.max("shard")).first()[0]
    numbers = F.sequence(F.lit(0), F.lit(last or 0))
    met = packed.withColumn("shard", F.explode(numbers)).join(graphs, "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = row["ids"]
                graph = Graph(
                    np.frombuffer(row["x"], "<f4").reshape(row["n"], -1),
                    np.frombuffer(row["edges"], "<i4").reshape(row["n"], -1),
                    np.frombuffer(row["seeds"], "<i4"),
                )
                own = np.frombuffer(row["vectors"], "<f8").reshape(row["n"], -1)
                for a in range(0, len(row["_queries"]), _BATCH):
                    some = row["_queries"][a : a + _BATCH]
                    yield _answers(graph, own, ids, some, top, beam)

    out = A.reachable(met).mapInArrow(run, "_row long, query_id long, vec_id long, score double")
    best = Window.partitionBy("_row").orderBy(F.desc("score"), "vec_id")
    return (
        out.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )


def _answers(graph: Graph, own: np.ndarray, ids: list, queries: list, top: int, beam: int) -> pa.RecordBatch:
    q = np.array([x["_v"] for x in queries], np.float64)
    found, _ = graph.search((q / np.abs(q).max(axis=1, keepdims=True)).astype(np.float32), max(beam, top + 1))
    out: list[tuple] = []
    for row, asked, numbers in zip(q, queries, found):
        numbers = numbers[numbers >= 0]
        scores = (own[numbers] * row).sum(axis=1)
        ranked = sorted(
            (-s, i) for s, k in zip(scores.tolist(), numbers.tolist()) for i in ids[k] if i != asked["_id"]
        )
        out += [(asked["_row"], asked["_id"], i, -s) for s, i in ranked[:top]]
    columns = list(zip(*out)) or [(), (), (), ()]
    return pa.RecordBatch.from_pydict(
        {
            "_row": pa.array(columns[0], pa.int64()),
            "query_id": pa.array(columns[1], pa.int64()),
            "vec_id": pa.array(columns[2], pa.int64()),
            "score": pa.array(columns[3], pa.float64()),
        }
    )
