"""Approximate nearest neighbours by inner product: a navigable small-world graph per shard.

Vectors that are equal are indexed once, with the least ids that have them.  Distinct
vectors go to shards of about ``shard_vectors`` by a hash of their least id; a task
builds a shard's hierarchical graph and stores it as one row of flat arrays: vectors,
and for each layer the nodes and ``degree`` neighbours of each node.  Queries, in
chunks of about ``chunk_queries``, meet every shard; shard results are merged by rank.

Largest inner product becomes nearest neighbour by one more component that brings all
vectors of a shard to the same length (0 for queries).

Graphs are built layer by layer from the top, nodes entering in batches: a batch is
searched for in the graph so far, all its nodes at once, and linked by the usual rule
that a neighbour must be closer to the node than to the neighbours chosen before it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch, ship_package
from .common import q

LEVEL_SHRINK = 16  # each layer has about one node in so many of the one below
FIRST_NODES = 64  # linked by comparing all of them
BATCH_NODES = 512
SEARCH_QUERIES = 256  # searched together, to bound memory


def best_first(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's ``k`` largest, largest first."""
    k = min(k, scores.shape[1])
    part = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    order = np.argsort(-np.take_along_axis(scores, part, axis=1), axis=1, kind="stable")
    return np.take_along_axis(part, order, axis=1)


def beam_search(
    vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, starts: np.ndarray, width: int, expand: int = 4
) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, scores), best first, of a best-first search of every query at once; -1 where fewer were met.

    ``links``: neighbours of each node, -1 for none.  ``starts``: entry nodes, a row a query.
    """
    n, m = len(queries), starts.shape[1]
    seen = np.zeros((n, len(links)), dtype=bool)
    seen[np.arange(n)[:, None], starts] = True
    nodes = np.full((n, max(width, m)), -1, dtype=np.int64)
    scores = np.full(nodes.shape, -np.inf, dtype=np.float32)
    nodes[:, :m] = starts
    scores[:, :m] = np.einsum("nd,nmd->nm", queries, vectors[starts])
    done = nodes < 0
    claim = np.zeros((n, len(links)), dtype=np.int32)
    while True:
        open_ = np.where(done, -np.inf, scores)
        active = np.flatnonzero(open_.max(axis=1) > -np.inf)
        if not len(active):
            return nodes[:, :width], scores[:, :width]
        pick = best_first(open_[active], expand)
        real = np.take_along_axis(open_[active], pick, axis=1) > -np.inf
        done[active[:, None], pick] = True
        at = np.take_along_axis(nodes[active], pick, axis=1)
        near = np.where(real[:, :, None], links[at], -1).reshape(len(active), -1)
        place = np.arange(near.shape[1], dtype=np.int32)[None, :] + 1
        rows = active[:, None]
        new = (near >= 0) & ~seen[rows, near]
        claim[rows, np.where(new, near, 0)] = place  # of nodes met twice, the last place claims it
        new &= claim[rows, near] == place
        hit_row, hit_col = np.nonzero(new)
        seen[active[hit_row], near[hit_row, hit_col]] = True
        found = np.full(near.shape, -np.inf, dtype=np.float32)
        found[hit_row, hit_col] = np.einsum("hd,hd->h", queries[active[hit_row]], vectors[near[hit_row, hit_col]])
        all_scores = np.concatenate([scores[active], found], axis=1)
        all_nodes = np.concatenate([nodes[active], np.where(new, near, -1)], axis=1)
        all_done = np.concatenate([done[active], ~new], axis=1)
        keep = best_first(all_scores, nodes.shape[1])
        scores[active] = np.take_along_axis(all_scores, keep, axis=1)
        nodes[active] = np.take_along_axis(all_nodes, keep, axis=1)
        done[active] = np.take_along_axis(all_done, keep, axis=1)


def choose_links(vectors: np.ndarray, nodes: np.ndarray, near: np.ndarray, scores: np.ndarray, degree: int) -> np.ndarray:
    """Neighbours for each of ``nodes`` from candidates ``near`` (best first, -1 for none).

    A candidate is taken if no taken one is nearer to it than the node is; what is
    left fills up the rest, best first.
    """
    n, m = near.shape
    sides = vectors[np.maximum(near, 0)]
    between = np.einsum("nad,nbd->nab", sides, sides)
    taken = np.zeros((n, m), dtype=bool)
    for c in range(m):
        blocked = ((between[:, c, :] > scores[:, c, None]) & taken).any(axis=1)
        taken[:, c] = (near[:, c] >= 0) & ~blocked & (taken.sum(axis=1) < degree)
    # taken ones first, then the others, each best first
    order = np.argsort(np.where(near < 0, 3, np.where(taken, 1, 2)), axis=1, kind="stable")[:, :degree]
    out = np.full((n, degree), -1, dtype=np.int64)
    out[:, : order.shape[1]] = np.take_along_axis(near, order, axis=1)
    return out


class Layer:
    """A graph over some of the shard's vectors: ``links[i]`` are numbers within the layer."""

    def __init__(self, nodes: np.ndarray, links: np.ndarray):
        self.nodes, self.links = nodes, links

    @classmethod
    def build(cls, vectors: np.ndarray, nodes: np.ndarray, upper: list[Layer], degree: int, width: int) -> Layer:
        own = vectors[nodes]
        links = np.full((len(nodes), degree), -1, dtype=np.int64)
        place = {int(v): i for i, v in enumerate(nodes)}
        size = min(len(nodes), FIRST_NODES)
        cls._link(own, links, np.arange(size), *cls._all(own, np.arange(size), np.arange(size), width), degree)
        while size < len(nodes):
            batch = np.arange(size, min(len(nodes), size + min(size, BATCH_NODES)))
            entry = descend(vectors, upper, own[batch])
            inside = np.array([place[int(v)] for v in entry])
            starts = np.where(inside < size, inside, 0)[:, None]
            near, scores = beam_search(own, links, own[batch], starts, width)
            peers, peer_scores = cls._all(own, batch, batch, width // 2)
            near = np.concatenate([near, peers], axis=1)
            scores = np.concatenate([scores, peer_scores], axis=1)
            keep = best_first(scores, width)
            near, scores = np.take_along_axis(near, keep, axis=1), np.take_along_axis(scores, keep, axis=1)
            cls._link(own, links, batch, near, scores, degree)
            size = int(batch[-1]) + 1
        return cls(nodes, links)

    @staticmethod
    def _all(own: np.ndarray, queries: np.ndarray, others: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        scores = own[queries] @ own[others].T
        scores[queries[:, None] == others[None, :]] = -np.inf
        keep = best_first(scores, k)
        scores = np.take_along_axis(scores, keep, axis=1)
        return np.where(scores > -np.inf, others[keep], -1), scores

    @staticmethod
    def _link(own, links, batch, near, scores, degree) -> None:
        """Link ``batch`` to its candidates, half the degree each, and the candidates back."""
        links[batch, : degree // 2] = choose_links(own, batch, near, scores, degree // 2)
        source = np.repeat(batch, degree // 2)
        target = links[batch, : degree // 2].ravel()
        source, target = source[target >= 0], target[target >= 0]
        hosts = np.unique(target)
        old_host = np.repeat(hosts, degree)
        old = links[hosts].ravel()
        host = np.r_[old_host[old >= 0], target]
        guest = np.r_[old[old >= 0], source]
        pair = np.unique(np.stack([host, guest]), axis=1)
        host, guest = pair[0], pair[1]
        score = np.einsum("nd,nd->n", own[host], own[guest])
        order = np.lexsort((-score, host))
        host, guest, score = host[order], guest[order], score[order]
        first = np.searchsorted(host, hosts)
        rank = np.arange(len(host)) - np.repeat(first, np.diff(np.r_[first, len(host)]))
        row = np.searchsorted(hosts, host)
        most = 2 * degree
        ok = rank < most
        table = np.full((len(hosts), most), -1, dtype=np.int64)
        values = np.full((len(hosts), most), -np.inf, dtype=np.float32)
        table[row[ok], rank[ok]], values[row[ok], rank[ok]] = guest[ok], score[ok]
        full = (table >= 0).sum(axis=1) > degree
        out = table[:, :degree].copy()
        for i in range(0, int(full.sum()), BATCH_NODES):
            part = np.flatnonzero(full)[i : i + BATCH_NODES]
            out[part] = choose_links(own, hosts[part], table[part], values[part], degree)
        links[hosts] = out


def descend(vectors: np.ndarray, upper: list[Layer], queries: np.ndarray) -> np.ndarray:
    """The best node (as the shard's number) that each query finds from the top layer down."""
    entry = np.zeros(len(queries), dtype=np.int64)  # node 0 is in every layer
    for layer in upper:
        inside = np.searchsorted(layer.nodes, entry)
        nodes, _ = beam_search(vectors[layer.nodes], layer.links, queries, inside[:, None], 4, 1)
        entry = layer.nodes[nodes[:, 0]]
    return entry


class Graph:
    """Hierarchical navigable small world over one shard's vectors; node 0 is the entry of every layer."""

    def __init__(self, vectors: np.ndarray, layers: list[Layer]):
        self.vectors, self.layers = vectors, layers

    @classmethod
    def build(cls, vectors: np.ndarray, degree: int = 32, width: int = 64, seed: int = 3) -> Graph:
        lengths = (vectors.astype(np.float64) ** 2).sum(axis=1)
        rest = np.sqrt(np.maximum(lengths.max() - lengths, 0)) if len(vectors) else lengths
        scale = np.sqrt(lengths.max()) if len(vectors) else 1.0
        even = (np.c_[vectors.astype(np.float64), rest] / scale).astype(np.float32)
        rng = np.random.default_rng([seed, len(vectors)])
        level = np.floor(-np.log(1 - rng.random(len(vectors))) / np.log(LEVEL_SHRINK)).astype(int)
        if len(level):
            level[0] = level.max()
        layers: list[Layer] = []
        for height in range(int(level.max()) if len(level) else -1, -1, -1):
            nodes = np.flatnonzero(level >= height)
            layers.append(Layer.build(even, nodes, layers, degree, width))
        return cls(even, layers)

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        """Nodes (numbers within the shard) near each query, best first by the graph's own scores; -1 for none."""
        length = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
        flat = np.c_[queries / length, np.zeros(len(queries))].astype(np.float32)
        out = np.full((len(queries), width), -1, dtype=np.int64)
        base = self.layers[-1]
        for i in range(0, len(flat), SEARCH_QUERIES):
            part = flat[i : i + SEARCH_QUERIES]
            starts = descend(self.vectors, self.layers[:-1], part)[:, None]
            nodes, _ = beam_search(self.vectors, base.links, part, starts, width)
            out[i : i + SEARCH_QUERIES, : nodes.shape[1]] = nodes
        return out

    def flat(self) -> dict:
        return {
            "vectors": self.vectors.ravel(),
            "sizes": np.array([len(x.nodes) for x in self.layers], dtype=np.int32),
            "nodes": np.concatenate([x.nodes for x in self.layers]).astype(np.int32),
            "links": np.concatenate([x.links.ravel() for x in self.layers]).astype(np.int32),
        }

    @classmethod
    def of(cls, vectors: np.ndarray, sizes: np.ndarray, nodes: np.ndarray, links: np.ndarray) -> Graph:
        degree = len(links) // len(nodes)
        ends = np.cumsum(sizes)
        table = links.reshape(-1, degree).astype(np.int64)
        nodes = nodes.astype(np.int64)
        layers = [Layer(nodes[e - s : e], table[e - s : e]) for s, e in zip(sizes, ends, strict=True)]
        return cls(vectors.reshape(sizes[-1], -1), layers)


GRAPH = (
    "dim int, shard long, original array<float>, ids array<bigint>, first_id array<int>, "
    "vectors array<float>, sizes array<int>, nodes array<int>, links array<int>"
)
FOUND = "query_id long, vec_id long, score double"


def _numpy(column) -> np.ndarray:
    return column.combine_chunks().values.to_numpy(zero_copy_only=False)


def build_graphs(distinct: DataFrame, shards: int, degree: int, width: int) -> DataFrame:
    """One row a shard, from ``distinct(ids, vector)``."""
    keyed = distinct.select(
        F.size("vector").alias("dim"),
        F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).alias("shard"),
        "ids",
        "vector",
    )

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        rows = rows.take(pa.array(np.argsort([i[0] for i in rows["ids"].to_pylist()], kind="stable")))
        original = np.array(rows["vector"].to_pylist(), dtype=np.float32).reshape(-1, dim)
        ids = rows["ids"].to_pylist()
        flat = Graph.build(original, degree, width).flat()
        columns = {
            "original": original.ravel(),
            "ids": np.array([i for x in ids for i in x], dtype=np.int64),
            "first_id": np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32),
            **flat,
        }
        lists = {k: pa.array([v], pa.list_(pa.from_numpy_dtype(v.dtype))) for k, v in columns.items()}
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int64()), **lists})

    return keyed.groupBy("dim", "shard").applyInArrow(build, GRAPH)


def search_graphs(graphs: DataFrame, queries: DataFrame, shards: int, n_chunks: int, k: int, width: int) -> DataFrame:
    """The ``k`` best of every shard for every query of ``queries(query_id, vector)``, exactly scored."""
    chunk = F.pmod(F.xxhash64("query_id"), F.lit(n_chunks))
    every_shard = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))
    asked = queries.select(
        F.size("vector").alias("dim"), chunk.alias("chunk"), every_shard.alias("shard"), "query_id", "vector"
    )
    every_chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_chunks - 1).cast("bigint")))
    held = graphs.select("*", every_chunk.alias("chunk"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not len(left) or not len(right):
            return kind.empty_table()
        dim = left["dim"][0].as_py()
        graph = Graph.of(*[_numpy(left[c]) for c in ("vectors", "sizes", "nodes", "links")])
        original = _numpy(left["original"]).reshape(-1, dim)
        ids, first = _numpy(left["ids"]), _numpy(left["first_id"])
        query_ids = right["query_id"].to_numpy()
        asked = _numpy(right["vector"]).reshape(-1, dim)
        found = graph.search(asked, max(width, k + 1))
        out: list[list[np.ndarray]] = [[], [], []]
        for own, vector, nodes in zip(query_ids, asked.astype(np.float64), found, strict=True):
            nodes = nodes[nodes >= 0]
            scores = original[nodes].astype(np.float64) @ vector
            counts = first[nodes + 1] - first[nodes]
            members = np.concatenate([ids[first[n] : first[n + 1]] for n in nodes]) if len(nodes) else ids[:0]
            scores = np.repeat(scores, counts)
            other = members != own
            members, scores = members[other], scores[other]
            best = np.lexsort((members, -scores))[:k]
            out[0].append(np.full(len(best), own))
            out[1].append(members[best])
            out[2].append(scores[best])
        return pa.table([pa.array(np.concatenate(x)) for x in out], schema=kind)

    return (
        held.groupBy("dim", "shard", "chunk").cogroup(asked.groupBy("dim", "shard", "chunk")).applyInArrow(search, FOUND)
    )


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part, once each."""
    rows = table.select(q(id_col).cast("bigint").alias("vec_id"), q(vector_col).cast("array<float>").alias("vector"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return rows.where(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & ~F.exists("vector", bad)
        & F.exists("vector", lambda x: x != 0)
    )


def nearest(
    table: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    shard_vectors: int = 8192,
    chunk_queries: int = 4096,
    degree: int = 32,
    build_width: int = 64,
    search_width: int = 128,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query row the ``k`` rows found of largest inner product.

    ``is_query`` maps the id column to a boolean column.  A row takes part unless its id or
    vector is null, the vector is empty or zero, or a component is null or not finite.  A
    query's candidates are the rows of other ids whose vectors have its length; ties go
    to the smaller id, and rows that repeat an id and its vector count once.  Other columns are
    ignored; an empty table gives an empty result.
    """
    spark = table.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    rows = valid_vectors(table, id_col, vector_col)
    # a query needs at most k + 1 of the rows that share a vector; each task drops the rest before the exchange
    least = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("n", F.dense_rank().over(least)).where(F.col("n") <= k + 1).select("vec_id", "vector").distinct()
    distinct = scratch.save(
        few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select("ids", "vector"), "vectors"
    )
    queries = scratch.save(
        rows.where(is_query(F.col("vec_id"))).distinct().select(F.col("vec_id").alias("query_id"), "vector"), "queries"
    )
    shards = max(1, -(-distinct.count() // shard_vectors))
    n_chunks = max(1, -(-queries.count() // chunk_queries))
    graphs = scratch.save(build_graphs(distinct, shards, degree, build_width), "graphs")
    found = search_graphs(graphs, queries, shards, n_chunks, k, search_width)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
