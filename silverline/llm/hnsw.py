"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Equal vectors are indexed once, by their least ids. The distinct vectors are dealt by hash into shards, of which
there are ``SHARDS`` at most until they hold ``SHARD_ROWS`` each, so the searches of a query do not grow with the table up to
that size. Every shard's graph is stored as one row of flat arrays, and searched as such. Queries meet every
shard in blocks, each shard gives its nearest, and these are merged.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverline.llm.common import materialise

LEAST_ROWS, SHARDS, SHARD_ROWS = 8192, 64, 1 << 17
QUERY_BLOCK = 4096
M = 12
EF_BUILD = 64
EF_SEARCH = 96
_SLACK = 8


def _near(vectors: np.ndarray, to: np.ndarray) -> np.ndarray:
    d = vectors - to
    return np.einsum("ij,ij->i", d, d)


def _search_layer(vectors, links, query, entry, ef):
    """The ``ef`` nearest found from ``entry`` [(distance, node)] as a sorted list."""
    seen = bytearray(len(vectors))
    for _, i in entry:
        seen[i] = 1
    todo, best = list(entry), [(-d, i) for d, i in entry]
    heapq.heapify(todo)
    heapq.heapify(best)
    while todo:
        d, i = heapq.heappop(todo)
        if d > -best[0][0] and len(best) >= ef:
            break
        fresh = [j for j in links[i] if not seen[j]]
        if not fresh:
            continue
        for j, dj in zip(fresh, _near(vectors[fresh], query).tolist(), strict=True):
            seen[j] = 1
            if len(best) < ef:
                heapq.heappush(best, (-dj, j))
                heapq.heappush(todo, (dj, j))
            elif dj < -best[0][0]:
                heapq.heapreplace(best, (-dj, j))
                heapq.heappush(todo, (dj, j))
    return sorted((-d, i) for d, i in best)


def _choose(vectors, found, m):
    """Up to ``m`` of ``found`` [(distance, node)], each nearer to the centre than to one chosen before; then the nearest left."""
    if len(found) <= m:
        return [i for _, i in found]
    nodes = [i for _, i in found]
    own = vectors[nodes]
    square = np.einsum("ij,ij->i", own, own)
    between = (square[:, None] + square[None, :] - 2 * own @ own.T)
    chosen, passed = [], []
    least = np.full(len(nodes), np.inf)
    for k, (d, _) in enumerate(found):
        if len(chosen) == m:
            break
        if d < least[k]:
            chosen.append(k)
            np.minimum(least, between[k], out=least)
        else:
            passed.append(k)
    chosen += passed[:m - len(chosen)]
    return [nodes[k] for k in chosen]


def build(ids: np.ndarray, vectors: np.ndarray, m: int = M, ef: int = EF_BUILD) -> dict:
    """The graph of one shard: nodes by falling level, and per level one flat array of ``2 m`` or ``m`` neighbours a node."""
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    u = ((mixed >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53
    levels = np.minimum((-np.log(u) / math.log(m)).astype(np.int64), 12)
    order = np.lexsort((mixed, -levels))
    ids, vectors, levels = ids[order], np.ascontiguousarray(vectors[order]), levels[order]
    n, top = len(ids), int(levels[0]) if len(ids) else 0
    sizes = [int((levels >= k).sum()) for k in range(top + 1)]
    links = [[[] for _ in range(s)] for s in sizes]
    for i in range(1, n):
        q = vectors[i]
        entry = [(float(_near(vectors[:1], q)[0]), 0)]
        for k in range(top, int(levels[i]), -1):
            entry = _search_layer(vectors, links[k], q, entry, 1)
        for k in range(min(top, int(levels[i])), -1, -1):
            most = 2 * m if k == 0 else m
            entry = _search_layer(vectors, links[k], q, entry, ef)
            links[k][i] = _choose(vectors, entry, m)
            for j in links[k][i]:
                links[k][j].append(i)
                if len(links[k][j]) > most + _SLACK:
                    near = _near(vectors[links[k][j]], vectors[j]).tolist()
                    links[k][j] = _choose(vectors, sorted(zip(near, links[k][j], strict=True)), most)
    flat = []
    for k, layer in enumerate(links):
        width = (2 * m if k == 0 else m) + _SLACK
        table = np.full((len(layer), width), -1, np.int32)
        for i, row in enumerate(layer):
            table[i, :len(row)] = row
        flat.append(table.ravel())
    return {"ids": ids, "vectors": vectors, "sizes": sizes, "m": m, "links": np.concatenate(flat) if flat else np.empty(0, np.int32)}


class _Layer:
    """The neighbours of nodes, read from a flat array when they are asked for."""

    def __init__(self, table: np.ndarray):
        self.table = table

    def __getitem__(self, i: int) -> list[int]:
        row = self.table[i]
        return row[row >= 0].tolist()


class Graph:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, sizes: list[int], links: np.ndarray, m: int):
        self.ids, self.vectors, self.layers, at = ids, vectors, [], 0
        for k, s in enumerate(sizes):
            width = (2 * m if k == 0 else m) + _SLACK
            self.layers.append(_Layer(links[at:at + s * width].reshape(s, width)))
            at += s * width

    def search(self, query: np.ndarray, k: int, ef: int) -> list[tuple[float, int]]:
        """Up to ``k`` of (distance, id), by distance in double precision, then id."""
        if not len(self.ids):
            return []
        entry = [(float(_near(self.vectors[:1], query)[0]), 0)]
        for layer in self.layers[:0:-1]:
            entry = _search_layer(self.vectors, layer, query, entry, 1)
        found = [i for _, i in _search_layer(self.vectors, self.layers[0], query, entry, max(ef, k))]
        exact = np.sqrt(_near(self.vectors[found], query))
        return sorted(zip(exact.tolist(), self.ids[found].tolist(), strict=True))[:k]


def _build_group(pdf: pd.DataFrame) -> pd.DataFrame:
    vectors = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["embedding"]])
    g = build(pdf["rep"].to_numpy(np.int64), vectors)
    return pd.DataFrame({"dim": [vectors.shape[1]], "shard": [int(pdf["shard"].iloc[0])], "ids": [g["ids"].tobytes()], "vectors": [g["vectors"].tobytes()],
                         "sizes": [g["sizes"]], "links": [g["links"].tobytes()]})


def valid_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the rows that take part, one for each id: of repeats the least vector."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = rows.where(F.col("vec_id").isNotNull() & e.isNotNull()).where(finite & F.exists(e, lambda x: x != 0))
    return ok.groupBy("vec_id").agg(F.min(e.cast("array<double>")).alias("embedding"))


def shard_count(n: int) -> int:
    """Shards for ``n`` vectors: one for each ``LEAST_ROWS`` up to ``SHARDS``, then as many as keep them under ``SHARD_ROWS``."""
    return max(1, min(SHARDS, math.ceil(n / LEAST_ROWS)), math.ceil(n / SHARD_ROWS))


def nearest(rows: DataFrame, k: int = 10, every: int = 100, shard_rows: int | None = None, ef: int = EF_SEARCH) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the queries ``vec_id % every = 0`` among all other rows.

    Null, zero and non-finite vectors and rows without an id take no part. Vectors of different
    lengths never meet. Of rows that repeat an id with other vectors the least vector takes part. Of equal vectors the ``k + 1`` least ids are enough for any answer, and only
    those are kept, which changes no result. Ties go to the smaller id. Fewer than ``k`` others give
    fewer rows; empty tables give none; further columns take no part.
    """
    everything = materialise(valid_vectors(rows), "vectors")
    by_vector = Window.partitionBy("embedding")
    members = materialise(everything.withColumn("n", F.row_number().over(by_vector.orderBy("vec_id"))).where(F.col("n") <= k + 1).drop("n"), "members")
    members = members.withColumn("rep", F.min("vec_id").over(by_vector))
    members = materialise(members, "members")
    reps = members.where("vec_id = rep").select("rep", "embedding", F.size("embedding").alias("dim"))
    n = reps.count()
    shards = shard_count(n) if shard_rows is None else max(1, math.ceil(n / shard_rows))
    dealt = reps.withColumn("shard", F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int"))
    graphs = materialise(dealt.groupBy("dim", "shard").applyInPandas(
        _build_group, "dim int, shard int, ids binary, vectors binary, sizes array<int>, links binary"), "graphs")

    queries = everything.where(F.col("vec_id") % every == 0).withColumn("dim", F.size("embedding"))
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    blocked = (queries.groupBy("dim", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"))
               .agg(F.collect_list(F.struct("vec_id", "embedding")).alias("queries"))
               .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))

    def search(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                graph = Graph(np.frombuffer(row.ids, np.int64), np.frombuffer(row.vectors, np.float64).reshape(-1, row.dim),
                              list(row.sizes), np.frombuffer(row.links, np.int32), M)
                out = []
                for q in row.queries:
                    vec_id, embedding = q["vec_id"], np.asarray(q["embedding"], dtype=np.float64)
                    out += [(vec_id, rep, score) for score, rep in graph.search(embedding, k + 1, ef)]
                yield pd.DataFrame(out, columns=["query_id", "rep", "score"])

    found = blocked.join(graphs, ["dim", "shard"]).mapInPandas(search, "query_id long, rep long, score double")
    by_query = Window.partitionBy("query_id")
    merged = found.withColumn("n", F.row_number().over(by_query.orderBy("score", "rep"))).where(F.col("n") <= k + 1)
    expanded = merged.join(members.select("rep", "vec_id"), "rep").where("vec_id <> query_id")
    ranked = expanded.withColumn("rank", F.row_number().over(by_query.orderBy("score", "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
