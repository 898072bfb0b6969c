"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, results merged.

Equal vectors are one node of the graph that carries the smallest ids it may have to return, so
thousands of copies cost one node and ties still go to the smallest ids. A shard's graph is a few flat
arrays: vectors, and for every level a table of neighbour numbers padded with -1. Points are inserted
in batches and queries run in batches: all searches of a batch walk the graph together.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import mix, written

SHARD_VECTORS = 8192
QUERY_BLOCK = 4096
WIDTH = 16
EF_BUILD = 64
EF_SEARCH = 128
BATCH = 256
EXPAND = 4


class Graph:
    """Levels of neighbour tables over unit vectors; level 0 holds every node with twice the neighbours."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors.astype(np.float32)
        n = len(vectors)
        uniform = (mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)) / float(1 << 53)
        self.level = np.minimum((-np.log(uniform + 1e-18) / np.log(WIDTH)).astype(int), 6) if n else np.zeros(0, dtype=int)
        if n:
            self.level[0] = self.level.max()
        self.tables = [np.full((n, WIDTH * (2 if k == 0 else 1)), -1, dtype=np.int32) for k in range(int(self.level.max()) + 1 if n else 1)]
        for first in range(0, n, BATCH):
            self.insert(np.arange(first, min(first + BATCH, n)))

    def insert(self, fresh: np.ndarray) -> None:
        """Link a batch: each point to the nearest found so far and to the nearest of its own batch."""
        points, old = self.vectors[fresh], int(fresh[0])
        entry = np.zeros((len(fresh), 1), dtype=np.int64)
        for level in range(len(self.tables) - 1, -1, -1):
            table = self.tables[level]
            here = self.level[fresh] >= level
            if old:
                found, alike = self.walk(points, entry, level, EF_BUILD if here.any() else 1)
                entry = found[:, : 4 if level else 1]
            if not here.any():
                continue
            own = fresh[here]
            inside = points[here] @ points[here].T
            np.fill_diagonal(inside, -np.inf)
            ids, sims = np.broadcast_to(own, inside.shape), inside
            if old:
                ids, sims = np.concatenate([found[here], ids], axis=1), np.concatenate([alike[here], sims], axis=1)
            picked_ids, picked = self.diverse(own, ids, sims, table.shape[1])
            table[own] = picked_ids
            self.link_back(table, own, picked_ids, picked)

    def diverse(self, own: np.ndarray, ids: np.ndarray, sims: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest, half of them chosen so that none is nearer to an earlier choice than to the point."""
        k = min(2 * width, ids.shape[1])
        top = np.argsort(-sims, axis=1, kind="stable")[:, :k]
        ids, sims = np.take_along_axis(ids, top, 1), np.take_along_axis(sims, top, 1)
        ids = np.where(np.isfinite(sims) & (ids >= 0), ids, -1)
        near = self.vectors[np.maximum(ids, 0)]
        between = np.einsum("bid,bjd->bij", near, near)
        chosen = np.zeros(ids.shape, dtype=bool)
        for j in range(ids.shape[1]):
            hidden = (chosen[:, :j] & (between[:, j, :j] > sims[:, j : j + 1])).any(axis=1)
            chosen[:, j] = ~hidden & (ids[:, j] >= 0)
        # diverse choices first, then the nearest of the rest
        rank = np.argsort(np.where(ids < 0, 2, ~chosen), axis=1, kind="stable")[:, :width]
        ids, sims = np.take_along_axis(ids, rank, 1), np.take_along_axis(sims, rank, 1)
        if ids.shape[1] < width:
            pad = ((0, 0), (0, width - ids.shape[1]))
            ids, sims = np.pad(ids, pad, constant_values=-1), np.pad(sims, pad, constant_values=-np.inf)
        return ids.astype(np.int32), sims

    def link_back(self, table: np.ndarray, own: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        """Add the reverse links and keep the best of each node that gained some."""
        width = table.shape[1]
        ends, starts = ids.ravel(), np.repeat(own, width)
        ok = ends >= 0
        ends, starts = ends[ok], starts[ok]
        order = np.argsort(ends, kind="stable")
        ends, starts = ends[order], starts[order]
        nodes, first, count = np.unique(ends, return_index=True, return_counts=True)
        gained = np.full((len(nodes), min(int(count.max()) if len(count) else 0, 8 * width)), -1, dtype=np.int64)
        place = np.arange(len(ends)) - np.repeat(first, count)
        fits = place < gained.shape[1]
        gained[np.repeat(np.arange(len(nodes)), count)[fits], place[fits]] = starts[fits]
        for part in range(0, len(nodes), 512):
            cut = slice(part, part + 512)
            both = np.sort(np.concatenate([table[nodes[cut]], gained[cut]], axis=1), axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            alike = np.einsum("bmd,bd->bm", self.vectors[np.maximum(both, 0)], self.vectors[nodes[cut]])
            alike[both < 0] = -np.inf
            table[nodes[cut]] = self.diverse(nodes[cut], both, alike, width)[0]

    def walk(self, queries: np.ndarray, entry: np.ndarray, level: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``ef`` nearest nodes found for each query, nearest first, from its entry nodes."""
        table, rows = self.tables[level], np.arange(len(queries))[:, None]
        seen = np.zeros((len(queries), len(self.vectors)), dtype=bool)
        ids = np.full((len(queries), ef), -1, dtype=np.int64)
        sims = np.full((len(queries), ef), -np.inf, dtype=np.float32)
        open_ = np.zeros((len(queries), ef), dtype=bool)
        fresh = entry
        while True:
            fresh = np.sort(fresh, axis=1)
            bad = fresh < 0
            bad[:, 1:] |= fresh[:, 1:] == fresh[:, :-1]
            safe = np.maximum(fresh, 0)
            bad |= seen[rows, safe]
            at, col = np.nonzero(~bad)
            seen[at, safe[at, col]] = True
            alike = np.full(fresh.shape, -np.inf, dtype=np.float32)
            alike[at, col] = np.einsum("nd,nd->n", self.vectors[safe[at, col]], queries[at])
            all_ids, all_sims = np.concatenate([ids, safe], axis=1), np.concatenate([sims, alike], axis=1)
            all_open = np.concatenate([open_, ~bad], axis=1)
            top = np.argsort(-all_sims, axis=1, kind="stable")[:, :ef]
            ids, sims, open_ = (np.take_along_axis(x, top, 1) for x in (all_ids, all_sims, all_open))
            if not open_.any():
                return np.where(np.isfinite(sims), ids, -1), sims
            # the first open places of each row are the nearest nodes not yet expanded
            rank = np.cumsum(open_, axis=1)
            take = open_ & (rank <= EXPAND)
            at, col = np.nonzero(take)
            fresh = np.full((len(queries), EXPAND, table.shape[1]), -1, dtype=np.int64)
            fresh[at, rank[at, col] - 1] = table[ids[at, col]]
            fresh = fresh.reshape(len(queries), -1)
            open_ &= ~take

    def search(self, queries: np.ndarray, k: int, ef: int = EF_SEARCH) -> np.ndarray:
        """Numbers of the ``k`` nearest nodes found for each query, -1 where there are fewer."""
        out = np.full((len(queries), k), -1, dtype=np.int64)
        for first in range(0, len(queries) if len(self.vectors) else 0, BATCH):
            part = queries[first : first + BATCH].astype(np.float32)
            entry = np.zeros((len(part), 1), dtype=np.int64)
            for level in range(len(self.tables) - 1, -1, -1):
                found, _ = self.walk(part, entry, level, ef if level == 0 else 8)
                entry = found[:, :4]
            n = min(k, found.shape[1])
            out[first : first + BATCH, :n] = found[:, :n]
        return out


def usable(df: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is not null or empty, holds finite numbers only, and is not zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(column).isNotNull() & (F.size(column) > 0)).where(finite).where(F.exists(column, lambda x: x != 0))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def shard_count(shards: dict[int, int], dim: Column) -> Column:
    """The number of shards of a dimension, null if no vector has it."""
    if not shards:
        return F.lit(None).cast("int")
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in shards.items() for x in pair]), dim)


def build_graphs(rows: DataFrame, keep: int, shard_vectors: int) -> tuple[DataFrame, dict[int, int]]:
    """One row per shard with its flat arrays, and the number of shards of each dimension."""
    hashed = rows.withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.lit(1), "vector"))
    order = Window.partitionBy("h1", "h2").orderBy("vec_id")
    # row_number() <= keep is cut on the map side too, so copies of one vector do not meet in one task
    least = hashed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    nodes = least.groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = written(nodes.withColumn("dim", F.size("vector")), "vector-nodes")
    shards = {r["dim"]: -(-r["count"] // shard_vectors) for r in nodes.groupBy("dim").count().collect()}
    dealt = nodes.withColumn("shard", F.pmod("h1", shard_count(shards, F.col("dim"))).cast("int"))

    def build(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["h1", "h2"], kind="stable")
        vectors = np.array(shard["vector"].tolist(), dtype=np.float64)
        graph = Graph(unit(vectors))
        ids = [np.asarray(i, dtype=np.int64) for i in shard["ids"]]
        return pd.DataFrame({
            "dim": [vectors.shape[1]], "shard": [int(shard["shard"].iloc[0])], "vectors": [vectors.tobytes()],
            "ids": [np.concatenate(ids).tobytes()], "sizes": [np.array([len(i) for i in ids], dtype=np.int64).tobytes()],
            "tables": [[t.tobytes() for t in graph.tables]],
        })

    schema = "dim int, shard int, vectors binary, ids binary, sizes binary, tables array<binary>"
    return written(dealt.groupBy("dim", "shard").applyInPandas(build, schema), "graphs"), shards


def load_graph(row: pd.Series) -> tuple[Graph, np.ndarray, list[np.ndarray]]:
    vectors = np.frombuffer(row["vectors"], dtype=np.float64).reshape(-1, int(row["dim"]))
    sizes = np.frombuffer(row["sizes"], dtype=np.int64)
    graph = Graph.__new__(Graph)
    graph.vectors = unit(vectors).astype(np.float32)
    graph.tables = [np.frombuffer(t, dtype=np.int32).reshape(len(vectors), -1) for t in row["tables"]]
    return graph, vectors, np.split(np.frombuffer(row["ids"], dtype=np.int64), np.cumsum(sizes)[:-1])


def nearest(base: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int = 5, shard_vectors: int = SHARD_VECTORS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of ``base`` found for each query by cosine.

    The query's own id is no candidate. Ties go to the smaller id. Vectors that are null, empty, zero
    or hold null or non-finite numbers, and rows with a null id, take no part on either side; vectors
    of another length than the query are no candidates. Repeated rows count once. Scores are computed
    in double precision on the original vectors. An empty table gives no rows.
    """
    rows = usable(base.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")), "vector")
    asked = usable(queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).cast("array<double>").alias("vector")), "vector")
    rows, asked = rows.where("vec_id is not null").distinct(), written(asked.where("query_id is not null").distinct(), "queries")
    graphs, shards = build_graphs(rows, k + 1, shard_vectors)
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    sent = asked.withColumn("shards", shard_count(shards, F.size("vector")))
    sent = sent.where("shards is not null").withColumn("dim", F.size("vector")).withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    sent = sent.select("dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "block", "query_id", "vector")
    graphs = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(key: tuple, graph_rows: pd.DataFrame, asked_rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(graph_rows) and len(asked_rows):
            graph, vectors, ids = load_graph(graph_rows.iloc[0])
            points = np.array(asked_rows["vector"].tolist(), dtype=np.float64)
            found = graph.search(unit(points), k + 1)
            lengths = np.linalg.norm(vectors, axis=1)
            for query, point, hits in zip(asked_rows["query_id"], points, found):
                hits = hits[hits >= 0]
                scores = (vectors[hits] * point).sum(axis=1) / (lengths[hits] * np.linalg.norm(point))
                rows = [(-s, int(i)) for h, s in zip(hits, scores) for i in ids[h] if i != query]
                out.extend((query, i, -s) for s, i in sorted(rows)[:k])
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    pairs = graphs.groupBy("dim", "shard", "block").cogroup(sent.groupBy("dim", "shard", "block"))
    hits = pairs.applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
