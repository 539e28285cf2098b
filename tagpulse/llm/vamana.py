"""Approximate nearest neighbours by largest inner product, over robust-pruned graphs.

Distinct vectors are dealt by hash to shards of about ``SHARD_ROWS``. In a shard points enter
a directed graph in growing batches: a greedy search proposes what is near a point, and
pruning keeps the nearest and drops whatever a kept neighbour is closer to by the factor
``ALPHA``, so that edges point in diverse directions; then neighbours get edges back, pruned
likewise. Searches start from ``STARTS`` random points at once, so that a dense cluster far
from the rest is found too, and from one point more of any part that these do not reach. One
more coordinate, which makes all vectors equally long, turns the largest inner
product into the smallest distance. Every shard answers every query by beam search, queries
in blocks; the best of all shards are merged, and scores are computed again in double
precision from the original vectors.

Null vectors, zero vectors and those with a null or non-finite component take no part, nor
do rows without an id. Vectors of different length are never compared. Equal vectors are one
point of the graph; of each, the smallest ids come first, as ties go to the smaller id. Rows
that repeat id and vector count once. Other columns are left out; without candidates or
queries the result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagpulse.llm.shared import settle

DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 96
ALPHA = 1.2
STARTS = 48
SHARD_ROWS = 4096
BLOCK_QUERIES = 512
_FAR = np.float32(np.inf)


class Graph:
    """``points`` (float32), up to DEGREE ``edges`` of each, filled up with -1, and the
    points where searches start."""

    def __init__(self, points: np.ndarray, edges: np.ndarray, starts: np.ndarray):
        self.points, self.edges, self.starts = points, edges, starts

    def reach(self) -> None:
        """Start also at one point of each part that was not reached."""
        reached = np.zeros(len(self.points), bool)
        new = self.starts
        while True:
            while len(new):
                reached[new] = True
                next_ = np.unique(self.edges[new])
                new = next_[(next_ >= 0) & ~reached[next_]]
            if reached.all():
                return
            new = np.flatnonzero(~reached)[:1]
            self.starts = np.concatenate((self.starts, new))

    def search(self, queries: np.ndarray, beam: int, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` points found nearest to each query by ``offsets - 2 * inner product``,
        nearest first (-1: none), and their distances; all queries step together."""
        n = len(queries)
        rows = np.arange(n)
        first = offsets[self.starts] - 2 * (queries @ self.points[self.starts].T)
        near = np.argsort(first, axis=1, kind="stable")[:, :beam]
        ids = np.full((n, beam), -1, np.int32)
        away = np.full((n, beam), _FAR, np.float32)
        done = np.ones((n, beam), bool)
        ids[:, : near.shape[1]] = self.starts[near]
        away[:, : near.shape[1]] = np.take_along_axis(first, near, axis=1)
        done[:, : near.shape[1]] = False
        seen = np.zeros((n, len(self.points)), bool)
        seen[:, self.starts] = True
        live = rows
        while len(live):
            open_ = ~done[live]
            live = live[open_.any(axis=1)]
            if not len(live):
                break
            at = np.argmax(~done[live], axis=1)
            done[live, at] = True
            next_ = self.edges[ids[live, at]]
            new = (next_ >= 0) & ~seen[live[:, None], next_]
            seen[live[:, None], np.where(new, next_, self.starts[0])] = True
            distance = offsets[next_] - 2 * np.matmul(self.points[next_], queries[live][:, :, None])[:, :, 0]
            distance[~new] = _FAR
            pool = np.concatenate((away[live], distance), axis=1)
            keep = np.argsort(pool, axis=1, kind="stable")[:, :beam]
            away[live] = np.take_along_axis(pool, keep, axis=1)
            ids[live] = np.take_along_axis(np.concatenate((ids[live], next_), axis=1), keep, axis=1)
            done[live] = np.take_along_axis(np.concatenate((done[live], ~new), axis=1), keep, axis=1)
        ids[~np.isfinite(away)] = -1
        return ids, away


def _prune(points: np.ndarray, owners: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """For each owner up to DEGREE of its candidates (-1: none), nearest first, without those
    to which a kept one is nearer by the factor ALPHA."""
    out = np.full((len(owners), DEGREE), -1, np.int32)
    near = points[candidates]
    away = ((near - points[owners][:, None, :]) ** 2).sum(axis=2)
    away[(candidates < 0) | (candidates == owners[:, None])] = _FAR
    rows = np.arange(len(owners))
    left = away.copy()
    for place in range(DEGREE):
        best = left.argmin(axis=1)
        found = np.isfinite(left[rows, best])
        if not found.any():
            break
        out[found, place] = candidates[rows, best][found]
        chosen = near[rows, best]
        between = ((near - chosen[:, None, :]) ** 2).sum(axis=2)
        # Distances are squared; a copy of the chosen candidate has distance zero and goes too.
        left[(ALPHA * ALPHA * between <= away) & found[:, None]] = _FAR
        left[rows[found], best[found]] = _FAR
    return out


def build(points: np.ndarray, seed: int = 1) -> Graph:
    n = len(points)
    points = np.ascontiguousarray(points, np.float32)
    offsets = (points**2).sum(axis=1)
    order = np.random.default_rng(seed).permutation(n)
    graph = Graph(points, np.full((n, DEGREE), -1, np.int32), order[:1])
    at, size = 1, 1
    while at < n:
        batch = order[at : at + size]
        found, _ = graph.search(points[batch], BUILD_BEAM, offsets)
        graph.edges[batch] = _prune(points, batch, found)
        _add_back(graph, batch)
        at, size = at + len(batch), min(size * 2, 256)
        graph.starts = order[: min(at, STARTS)]
    graph.reach()
    return graph


def _add_back(graph: Graph, batch: np.ndarray) -> None:
    """An edge back to each point of the batch; where that is too many, prune."""
    to = graph.edges[batch]
    of = np.repeat(batch, DEGREE).reshape(to.shape)
    to, of = to[to >= 0], of[to >= 0]
    order = np.argsort(to, kind="stable")
    to, of = to[order], of[order]
    owners, first, counts = np.unique(to, return_index=True, return_counts=True)
    added = np.full((len(owners), int(counts.max(initial=0))), -1, np.int32)
    place = np.arange(len(to)) - np.repeat(first, counts)
    added[np.repeat(np.arange(len(owners)), counts), place] = of
    all_ = np.concatenate((graph.edges[owners], added), axis=1)
    full = (all_ >= 0).sum(axis=1) > DEGREE
    packed = np.take_along_axis(all_, np.argsort(all_ < 0, axis=1, kind="stable"), axis=1)
    graph.edges[owners[~full]] = packed[~full][:, :DEGREE]
    for part in np.array_split(np.flatnonzero(full), max(1, full.sum() // 512)):
        graph.edges[owners[part]] = _prune(graph.points, owners[part], all_[part])


def lengthened(vectors: np.ndarray) -> np.ndarray:
    """One more coordinate that makes all vectors as long as the longest."""
    squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
    return np.column_stack((vectors, np.sqrt(squares.max() - squares))).astype(np.float32)


def _built(group: pd.DataFrame) -> pd.DataFrame:
    """The graph of a shard as one row."""
    group = group.sort_values("rep")
    vectors = np.stack(group["vector"].to_numpy()).astype(np.float32)
    graph = build(lengthened(vectors))
    return pd.DataFrame(
        {
            "size": [vectors.shape[1]],
            "shard": [group["shard"].iloc[0]],
            "ids": [group["rep"].to_numpy(np.int64).tobytes()],
            "vectors": [vectors.tobytes()],
            "edges": [graph.edges.tobytes()],
            "starts": [graph.starts.astype(np.int32).tobytes()],
        }
    )


def _searched(k: int, beam: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                vectors = np.frombuffer(row["vectors"], np.float32).reshape(len(ids), -1)
                edges = np.frombuffer(row["edges"], np.int32).reshape(len(ids), -1)
                names = np.frombuffer(row["queries"], np.int64)
                asked = np.frombuffer(row["asked"], np.float32).reshape(len(names), -1)
                graph = Graph(vectors, edges, np.frombuffer(row["starts"], np.int32))
                found, _ = graph.search(asked, max(beam, k), np.zeros(len(ids), np.float32))
                found = found[:, :k]
                some = found >= 0
                # Products in double precision, summed along each row alone.
                exact = (vectors[found].astype(np.float64) * asked[:, None, :].astype(np.float64)).sum(axis=2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(names, some.sum(axis=1))), pa.array(ids[found[some]]), pa.array(exact[some])],
                    names=["query", "rep", "score"],
                )

    return search


def search(
    rows: DataFrame,
    queries: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    beam: int = SEARCH_BEAM,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its ``k`` nearest among
    ``rows``, itself left out; both have ``key`` and ``vector``."""

    def usable(df: DataFrame) -> DataFrame:
        v = F.col("vector")
        fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        df = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<float>").alias("vector"))
        return df.where(F.col("id").isNotNull() & v.isNotNull() & fine & F.exists(v, lambda x: x != 0))

    everything, asked = usable(rows), usable(queries)
    points = settle(everything.groupBy("vector").agg(F.min("id").alias("rep")), "points")
    # The smallest ids of equal vectors: one more than a result has, as one may be the query.
    order = Window.partitionBy("rep").orderBy("id")
    members = (
        everything.join(points, "vector")
        .select("rep", "id")
        .distinct()
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= k + 1)
        .select("rep", "id")
    )
    shards = max(1, math.ceil(points.count() / shard_rows))
    dealt = points.withColumn("size", F.size("vector")).withColumn("shard", F.pmod(F.xxhash64("rep"), F.lit(shards)))
    graphs = settle(
        dealt.groupBy("size", "shard").applyInPandas(
            _built, "size int, shard bigint, ids binary, vectors binary, edges binary, starts binary"
        ),
        "graphs",
    )
    heads = settle(asked.groupBy("vector").agg(F.min("id").alias("query")), "heads")
    blocks = max(1, math.ceil(heads.count() / BLOCK_QUERIES))

    def gathered(group: pd.DataFrame) -> pd.DataFrame:
        stacked = np.stack(group["vector"].to_numpy()).astype(np.float32)
        names = group["query"].to_numpy(np.int64)
        return pd.DataFrame({"size": [stacked.shape[1]], "queries": [names.tobytes()], "asked": [stacked.tobytes()]})

    block = heads.withColumn("size", F.size("vector")).withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
    packed = block.groupBy("size", "block").applyInPandas(gathered, "size int, queries binary, asked binary")
    everywhere = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>")))
    near = (
        graphs.join(everywhere, ["size", "shard"])
        .select("ids", "vectors", "edges", "starts", "queries", "asked")
        .mapInArrow(_searched(k + 1, beam), "query bigint, rep bigint, score double")
    )

    def first(df: DataFrame, by: str, n: int) -> DataFrame:
        best = Window.partitionBy(by).orderBy(F.desc("score"), "id")
        return df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)

    reps = first(near.withColumnRenamed("rep", "id"), "query", k + 1).select("query", F.col("id").alias("rep"), "score")
    nearest = first(reps.join(members, "rep").select("query", "id", "score"), "query", k + 1)
    ids = asked.join(heads, "vector").select("query", F.col("id").alias("query_id")).distinct()
    answers = nearest.drop("rank").join(ids, "query").where("id <> query_id")
    return first(answers, "query_id", k).select("query_id", F.col("rank").cast("int"), F.col("id").alias("vec_id"), "score")
