"""Approximate nearest neighbours by inner product: a navigable small-world graph per shard.

Rows are dealt to shards by hash; a task builds a shard's hierarchical graph and stores it as flat
arrays: vectors, and per level one neighbour array of node numbers.  Nodes stand in insertion
order and the nodes of a level are a prefix, so a level is (nodes, degree) numbers and nothing
else.  Equal vectors of a shard are one node with its members.

Largest inner product becomes smallest distance by one more coordinate that gives every node the
same norm.  A task searches a shard for a chunk of queries in step: each round expands every
query's best open node with array operations.  The answers of all shards are merged per query.

Shards hold a bounded number of bytes and chunks a bounded number of queries; their number grows
with the input.  Defined results: vectors that are null, empty, zero or hold null or non-finite
components and rows with a null id neither ask nor answer; vectors are compared with those of equal length only; a row is
no answer to itself, but other rows with its vector or id are; rows equal in id and vector ask
once; fewer candidates than k are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide.runtime import spread, stage

DEGREE = 16
BREADTH = 96
BUILD_BREADTH = 64
SHARD_BYTES = 32 << 20
LEAST_SHARDS = 8
CHUNK = 1 << 16
CELLS = 1 << 24


class Graph:
    """``nodes`` (n, d) with equal norms; ``levels[l]`` (n_l, degree) neighbour numbers, -1 for none."""

    def __init__(self, nodes: np.ndarray, levels: list[np.ndarray]) -> None:
        self.nodes, self.levels = nodes, levels

    @classmethod
    def built(cls, vectors: np.ndarray) -> Graph:
        """Insert vectors in the given (random) order, the highest level first."""
        square = (vectors.astype(np.float64) ** 2).sum(1)
        extra = np.sqrt(np.maximum(square.max(initial=0) - square, 0))
        nodes = np.concatenate([vectors, extra[:, None]], 1).astype(np.float32)
        sizes = [len(nodes)]
        while sizes[-1] > 4 * DEGREE:
            sizes.append(sizes[-1] // DEGREE)
        graph = cls(nodes, [np.zeros((0, 2 * DEGREE), np.int32) for _ in sizes])
        for level in range(len(sizes) - 1, -1, -1):
            # The nodes of the level above stand here too and start with the links they have there.
            done = sizes[level + 1] if level + 1 < len(sizes) else 0
            if done:
                graph.levels[level] = graph.levels[level + 1]
            while done < sizes[level]:
                step = min(max(64, done), 1024, sizes[level] - done)
                graph.insert(level, done, done + step)
                done += step
        return graph

    def insert(self, level: int, lo: int, hi: int) -> None:
        """Link nodes lo..hi - 1 on a level that holds the nodes before them."""
        new = self.nodes[lo:hi]
        links = np.full((hi, 2 * DEGREE), -1, np.int32)
        links[:lo] = self.levels[level]
        inside = new @ new.T
        np.fill_diagonal(inside, -np.inf)
        most = min(BUILD_BREADTH // 2, hi - lo - 1) if lo else min(BUILD_BREADTH, hi - lo - 1)
        near = np.argsort(-inside, axis=1, kind="stable")[:, :most]
        ids, scores = near + lo, np.take_along_axis(inside, near, 1)
        if lo:
            found, values = self.search(new, BUILD_BREADTH, level)
            ids, scores = np.concatenate([found, ids], 1), np.concatenate([values, scores], 1)
        links[lo:hi, :DEGREE] = self.chosen(ids, scores, DEGREE)
        # Arcs back, pruned to the level's degree by the same rule.
        source = np.repeat(np.arange(lo, hi), DEGREE)
        target = links[lo:hi, :DEGREE].ravel()
        source, target = source[target >= 0], target[target >= 0]
        if len(target):
            score = np.einsum("nd,nd->n", self.nodes[source], self.nodes[target])
            order = np.lexsort((-score, target))
            source, target = source[order], target[order]
            touched, begin = np.unique(target, return_index=True)
            place = np.arange(len(target)) - np.repeat(begin, np.diff([*begin, len(target)]))
            fresh = np.full((len(touched), 2 * DEGREE), -1, np.int64)
            ok = place < 2 * DEGREE
            fresh[np.searchsorted(touched, target[ok]), place[ok]] = source[ok]
            for at in range(0, len(touched), 2048):
                own = touched[at:at + 2048]
                ids = np.concatenate([links[own], fresh[at:at + 2048]], 1).astype(np.int64)
                scores = np.matmul(self.nodes[ids], self.nodes[own][:, :, None])[:, :, 0]
                twice = (ids[:, 2 * DEGREE:, None] == ids[:, None, :2 * DEGREE]).any(2)
                scores[ids < 0] = -np.inf
                scores[:, 2 * DEGREE:][twice] = -np.inf
                links[own] = self.chosen(ids, scores, 2 * DEGREE)
        self.levels[level] = links

    def chosen(self, ids: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
        """Per row up to ``most`` candidates: first those nearer to the row's node than to any
        chosen one, then the nearest of the rest."""
        order = np.argsort(-scores, axis=1, kind="stable")
        ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
        out = np.full((len(ids), most), -1, np.int32)
        for at in range(0, len(ids), 512):
            a, s = ids[at:at + 512], scores[at:at + 512]
            real = np.isfinite(s)
            points = self.nodes[np.where(real, a, 0)]
            between = np.matmul(points, points.transpose(0, 2, 1))
            keep = np.zeros(a.shape, bool)
            for j in range(a.shape[1]):
                blocked = ((between[:, j] > s[:, j, None]) & keep).any(1)
                keep[:, j] = real[:, j] & ~blocked
            rank = np.argsort(np.where(keep, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :most]
            picked = np.where(np.take_along_axis(real, rank, 1), np.take_along_axis(a, rank, 1), -1)
            out[at:at + 512, :picked.shape[1]] = picked
        return out

    def search(self, queries: np.ndarray, breadth: int, level: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Per query ``breadth`` nodes of a level (-1: none) and their products, best first."""
        ids = np.empty((len(queries), breadth), np.int64)
        scores = np.empty((len(queries), breadth), np.float32)
        size = max(16, min(2048, CELLS // max(1, len(self.levels[level]))))
        for at in range(0, len(queries), size):
            ids[at:at + size], scores[at:at + size] = self._search(queries[at:at + size], breadth, level)
        return ids, scores

    def _search(self, queries: np.ndarray, breadth: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        top = len(self.levels) - 1
        if level == top:
            entry = np.zeros((len(queries), 1), np.int64)
        else:
            entry = (queries @ self.nodes[:len(self.levels[top])].T).argmax(1)[:, None]
            for upper in range(top - 1, level, -1):
                entry = self._beam(queries, entry, 4, upper)[0][:, :1]
        return self._beam(queries, entry, breadth, level)

    def _beam(self, queries: np.ndarray, entry: np.ndarray, breadth: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        links, nodes, n = self.levels[level], self.nodes, len(queries)
        ids = np.full((n, breadth), -1, np.int64)
        scores = np.full((n, breadth), -np.inf, np.float32)
        is_open = np.zeros((n, breadth), bool)
        ids[:, 0], is_open[:, 0] = entry[:, 0], True
        scores[:, 0] = np.einsum("qd,qd->q", queries, nodes[entry[:, 0]])
        seen = np.zeros((n, len(links) + 1), bool)
        seen[np.arange(n), entry[:, 0]] = True
        seen[:, -1] = True
        live = np.arange(n)
        while len(live):
            waiting = np.where(is_open[live], scores[live], -np.inf)
            slot = waiting.argmax(1)
            go = np.isfinite(waiting[np.arange(len(live)), slot])
            live, slot = live[go], slot[go]
            if not len(live):
                break
            is_open[live, slot] = False
            near = links[ids[live, slot]].astype(np.int64)
            fresh = ~seen[live[:, None], near]
            seen[live[:, None], near] = True
            value = np.matmul(nodes[near], queries[live][:, :, None])[:, :, 0]
            value[~fresh] = -np.inf
            all_scores = np.concatenate([scores[live], value], 1)
            best = np.argpartition(-all_scores, breadth - 1, axis=1)[:, :breadth]
            scores[live] = np.take_along_axis(all_scores, best, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], near], 1), best, 1)
            is_open[live] = np.take_along_axis(np.concatenate([is_open[live], fresh], 1), best, 1)
        order = np.argsort(-scores, axis=1, kind="stable")
        scores = np.take_along_axis(scores, order, 1)
        return np.where(np.isfinite(scores), np.take_along_axis(ids, order, 1), -1), scores


def usable(embedding: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & fine & F.exists(embedding, lambda x: x != 0)


def _prepared(embeddings: DataFrame) -> DataFrame:
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    rows = embeddings.select(F.col("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    assert kind in ("tinyint", "smallint", "int", "bigint"), "vec_id must be a whole number"
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "vector", F.size("vector").alias("dim"),
                       F.xxhash64("vec_id", "vector").alias("print"))


def build(embeddings: DataFrame, shard_bytes: int = SHARD_BYTES, least: int = LEAST_SHARDS) -> DataFrame:
    """Index table: dim, shard, shards, n, degree sizes, and flat arrays as binary columns."""
    rows = _prepared(embeddings)
    sizes = rows.groupBy("dim").count().withColumn(
        "shards", F.greatest(F.lit(least), F.ceil(F.col("count") * F.col("dim") * 4 / F.lit(shard_bytes))).cast("int"))
    dealt = rows.join(sizes.select("dim", "shards"), "dim").withColumn(
        "shard", F.pmod(F.col("print"), F.col("shards")).cast("int"))

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["print", "vec_id"], kind="stable")
        vectors = np.stack(frame["vector"].to_numpy())
        unique, node = np.unique(vectors, axis=0, return_inverse=True)
        node = node.ravel()
        # First appearance in hash order: a random insertion order, the same on every run.
        first = np.full(len(unique), len(vectors))
        np.minimum.at(first, node, np.arange(len(vectors)))
        order = np.argsort(first)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        unique, node = unique[order], place[node]
        ids = frame["vec_id"].to_numpy(np.int64)
        members = np.lexsort((ids, node))
        graph = Graph.built(unique)
        starts = np.searchsorted(node[members], np.arange(len(unique) + 1))
        return pd.DataFrame([{
            "dim": int(vectors.shape[1]), "shard": int(frame["shard"].iloc[0]), "n": len(unique),
            "level_sizes": [len(x) for x in graph.levels], "vectors": unique.tobytes(),
            "neighbours": b"".join(x.tobytes() for x in graph.levels),
            "members": ids[members].tobytes(), "first_member": starts.astype(np.int64).tobytes()}])

    # A fixed number of tasks: by bytes, graphs that take long to build would meet in one.
    return spread(dealt, "dim", "shard").groupBy("dim", "shard").applyInPandas(
        one, "dim int, shard int, n long, level_sizes array<long>, vectors binary, neighbours binary, "
             "members binary, first_member binary")


def opened(row: pd.Series) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    """Graph, original vectors, member ids and first members of an index row."""
    n, dim = int(row["n"]), int(row["dim"])
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(n, dim)
    flat = np.frombuffer(row["neighbours"], np.int32).reshape(-1, 2 * DEGREE)
    ends = np.cumsum([0, *row["level_sizes"]])
    square = (vectors ** 2).sum(1)
    nodes = np.concatenate([vectors, np.sqrt(np.maximum(square.max(initial=0) - square, 0))[:, None]], 1)
    graph = Graph(nodes.astype(np.float32), [flat[a:b] for a, b in zip(ends, ends[1:])])
    return graph, vectors, np.frombuffer(row["members"], np.int64), np.frombuffer(row["first_member"], np.int64)


def search(index: DataFrame, queries: DataFrame, k: int = 20, breadth: int = BREADTH, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows but its own, best first.

    ``queries``: vec_id, embedding.  A task takes one shard's graph and one chunk of queries.
    """
    asked = _prepared(queries).dropDuplicates(["vec_id", "print"])
    counts = asked.groupBy("dim").agg(F.ceil(F.count("*") / F.lit(chunk)).cast("int").alias("chunks"))
    places = index.select("dim", "shard")
    sent = (asked.join(counts, "dim").withColumn("chunk", F.pmod(F.xxhash64("print"), F.col("chunks")).cast("int"))
            .join(places, "dim").select(F.col("dim").alias("of_dim"), F.col("shard").alias("of_shard"),
                                        F.col("chunk").alias("of_chunk"), "vec_id", "print", "vector"))
    graphs = index.join(counts, "dim").withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)"))).drop("chunks")

    def one(graph_rows: pd.DataFrame, asked_rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, ...]] = []
        if len(graph_rows) and len(asked_rows):
            graph, vectors, members, first = opened(graph_rows.iloc[0])
            for at in range(0, len(asked_rows), 1024):
                part = asked_rows.iloc[at:at + 1024]
                wanted = np.stack(part["vector"].to_numpy())
                padded = np.concatenate([wanted, np.zeros((len(wanted), 1))], 1).astype(np.float32)
                ids, _ = graph.search(padded, max(breadth, k + 1))
                # Summed in one order, so equal vectors tie exactly wherever they stand.
                exact = (vectors[ids] * wanted[:, None, :]).sum(-1)
                exact[ids < 0] = -np.inf
                best = np.argsort(-exact, axis=1, kind="stable")[:, :k + 1]
                for q, (own, prints) in enumerate(zip(part["vec_id"].to_numpy(), part["print"].to_numpy())):
                    score, who = [], []
                    for b in best[q]:
                        node = ids[q, b]
                        if node < 0:
                            break
                        # Ties go to smaller ids, so a node's first k + 1 members are all that can count.
                        group = members[first[node]:min(first[node + 1], first[node] + k + 1)]
                        at_own = np.flatnonzero(group == own)
                        whole = members[first[node]:first[node + 1]]
                        if len(at_own) and (vectors[node] == wanted[q]).all():
                            group = np.delete(whole[:k + 2], np.flatnonzero(whole[:k + 2] == own)[0])
                        who.append(group)
                        score.append(np.full(len(group), exact[q, b]))
                    who_all, score_all = np.concatenate([np.zeros(0, np.int64), *who]), np.concatenate([np.zeros(0), *score])
                    take = np.lexsort((who_all, -score_all))[:k]
                    out.append((np.full(len(take), own), np.full(len(take), prints), who_all[take], score_all[take]))
        columns = ["query_id", "print", "vec_id", "score"]
        if not out:
            return pd.DataFrame({c: np.zeros(0, np.float64 if c == "score" else np.int64) for c in columns})
        return pd.DataFrame({c: np.concatenate([o[i] for o in out]) for i, c in enumerate(columns)})

    found = graphs.groupBy("dim", "shard", "chunk").cogroup(
        sent.groupBy("of_dim", "of_shard", "of_chunk")).applyInPandas(
        one, "query_id long, print long, vec_id long, score double")
    best = Window.partitionBy("query_id", "print").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def neighbours(embeddings: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """Index every row, ask for rows whose id is divisible by ``every``."""
    return search(stage(build(embeddings)), embeddings.where(F.col("vec_id") % every == 0), k)
