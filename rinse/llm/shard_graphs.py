"""Approximate nearest neighbours by inner product: a hierarchical navigable small-world graph for each shard.

Rows are dealt to shards of about `shard_rows` rows by a checksum of their numbers. In a shard, equal vectors are one
node that names all its rows. One more component makes all nodes equally long, so that the largest inner product is
the nearest neighbour and neighbours can be pruned as in any metric space. Nodes are numbered by falling level: layer
l of the graph is the first `layers[l]` nodes, and its neighbours are one flat array of `layers[l]` times the layer's
width of numbers, -1 where there are fewer. A shard is one row of a table in the shared folder: vectors, rows and
neighbours as flat arrays.

Layers are built from the top. Nodes are inserted in batches; a batch searches the layer as it is, adds its own
members as candidates, and keeps those that are nearer to the new node than to a neighbour it already has. Lists that
overflow by links back are pruned by the same rule.

The stated queries meet every shard in blocks of `query_block`. A search descends the layers and then keeps the
`breadth` nearest nodes of the lowest layer, for all queries of a batch at once; the best `k` rows of each shard are
scored in double precision on the original vectors and merged by rank. Where a shard has no more than `breadth` nodes,
or a search finds fewer than it needs, its vectors are all compared. Measured recall is in the README and held by a test.

Null vectors, empty ones, those of zeros alone and those with a null or non-finite component take no part. Vectors
are compared with those of the same length. A query meets every row but its own; rows with a repeated vec_id are rows
of their own. Ties go to the smaller vec_id, null last. Null vec_ids are candidates and no queries. No rows and no
queries give no result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rinse.llm.bytewords import mix
from rinse.llm.shared import written
from rinse.llm.vectors import counted, ids_of, matrix, numbered, packed

_STEP = 4  # nodes that a search opens at once
_CELLS = 1 << 23

GRAPHS = "dim int, shard bigint, layers array<int>, neighbours binary, x binary, first binary, rows binary, ids binary, unnamed binary"


def beam(
    space: np.ndarray, neighbours: np.ndarray, queries: np.ndarray, entries: np.ndarray, breadth: int
) -> tuple[np.ndarray, np.ndarray]:
    """The `breadth` nodes most similar to each query that a search from its entry finds, best first, and similarities.

    -1 and minus infinity where there are fewer.
    """
    count, nodes = len(queries), len(space)
    ids = np.full((count, breadth), -1, dtype=np.int32)
    alike = np.full((count, breadth), -np.inf, dtype=np.float32)
    unopened = np.zeros((count, breadth), dtype=bool)
    seen = np.zeros((count, nodes + 1), dtype=bool)  # the last column stands for no node
    seen[:, nodes] = True
    ids[:, 0], unopened[:, 0] = entries, True
    alike[:, 0] = np.einsum("rd,rd->r", space[entries], queries)
    seen[np.arange(count), entries] = True
    step = min(_STEP, breadth)
    while True:
        promise = np.where(unopened, alike, -np.inf)
        rows = np.flatnonzero(unopened.any(axis=1))
        if not len(rows):
            break
        best = np.argpartition(-promise[rows], step - 1, axis=1)[:, :step]
        chosen = ids[rows[:, None], best]
        chosen[~unopened[rows[:, None], best]] = -1
        unopened[rows[:, None], best] = False
        lists = []
        for j in range(step):
            found = np.where(chosen[:, j, None] >= 0, neighbours[chosen[:, j]], -1)
            new = ~seen[rows[:, None], found]
            seen[rows[:, None], found] = True
            lists.append(np.where(new, found, -1))
        near = np.concatenate(lists, axis=1)
        there = near >= 0
        near = near[:, there.any(axis=0)] if not there.all() else near
        there = near >= 0
        like = np.einsum("rwd,rd->rw", space[near], queries[rows])
        like[~there] = -np.inf
        every_id = np.concatenate([ids[rows], near], axis=1)
        every_like = np.concatenate([alike[rows], like], axis=1)
        every_open = np.concatenate([unopened[rows], there], axis=1)
        top = np.argpartition(-every_like, breadth - 1, axis=1)[:, :breadth]
        ids[rows], alike[rows] = np.take_along_axis(every_id, top, 1), np.take_along_axis(every_like, top, 1)
        unopened[rows] = np.take_along_axis(every_open, top, 1)
    order = np.argsort(-alike, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(alike, order, 1)


def pruned(space: np.ndarray, candidates: np.ndarray, alike: np.ndarray, width: int) -> np.ndarray:
    """Of each row's candidates, best first, those more similar to the row's node than to any kept before; -1 at the end."""
    out = np.full((len(candidates), width), -1, dtype=np.int32)
    several = max(1, _CELLS // max(1, candidates.shape[1] ** 2))
    for low in range(0, len(candidates), several):
        rows = candidates[low : low + several]
        vectors = space[rows]
        among = vectors @ vectors.transpose(0, 2, 1)
        nearest_kept = np.full(rows.shape, -np.inf, dtype=np.float32)
        kept = np.zeros(len(rows), dtype=np.int64)
        for c in range(rows.shape[1]):
            take = np.flatnonzero((rows[:, c] >= 0) & (alike[low : low + several, c] > nearest_kept[:, c]) & (kept < width))
            out[low + take, kept[take]] = rows[take, c]
            kept[take] += 1
            nearest_kept[take] = np.maximum(nearest_kept[take], among[take, :, c])
    return out


def _insert(space: np.ndarray, graph: np.ndarray, degree: np.ndarray, first: int, links: np.ndarray) -> None:
    """Links the nodes from `first` on to these neighbours, and back."""
    width = graph.shape[1]
    new = np.arange(first, first + len(links))
    graph[new, : links.shape[1]] = links
    degree[new] = (links >= 0).sum(axis=1)
    to, source = links[links >= 0], np.repeat(new, degree[new])
    back = ~(graph[to] == source[:, None]).any(axis=1)
    order = np.argsort(to[back], kind="stable")
    to, source = to[back][order], source[back][order]
    nodes, at, counts = np.unique(to, return_index=True, return_counts=True)
    if not len(nodes):
        return
    wide = int((degree[nodes] + counts).max())
    union = np.full((len(nodes), max(wide, width)), -1, dtype=np.int32)
    union[:, :width] = graph[nodes]
    union[np.repeat(np.arange(len(nodes)), counts), np.arange(len(to)) - np.repeat(at, counts) + np.repeat(degree[nodes], counts)] = source
    fits = degree[nodes] + counts <= width
    graph[nodes[fits]] = union[fits][:, :width]
    degree[nodes[fits]] += counts[fits]
    if not fits.all():
        rows, full = union[~fits], nodes[~fits]
        alike = np.full(rows.shape, -np.inf, dtype=np.float32)
        several = max(1, _CELLS // (rows.shape[1] * space.shape[1]))
        for low in range(0, len(rows), several):
            part = slice(low, low + several)
            alike[part] = np.einsum("rwd,rd->rw", space[rows[part]], space[full[part]])
        alike[rows < 0] = -np.inf
        order = np.argsort(-alike, axis=1, kind="stable")
        kept = pruned(space, np.take_along_axis(rows, order, 1), np.take_along_axis(alike, order, 1), width)
        graph[full], degree[full] = kept, (kept >= 0).sum(axis=1)


def _layer(space: np.ndarray, nodes: int, width: int, links: int, breadth: int, batch: int, above: list[np.ndarray]) -> np.ndarray:
    """Neighbours of the first `nodes` nodes; `above` holds the finished layers above, the topmost first."""
    graph = np.full((nodes, width), -1, dtype=np.int32)
    degree = np.zeros(nodes, dtype=np.int64)
    first = 0
    while first < nodes:
        end = min(nodes, first + min(batch, max(64, first)))
        queries = space[first:end]
        among = queries @ queries.T
        np.fill_diagonal(among, -np.inf)
        own = min(breadth, end - first)
        best = np.argpartition(-among, own - 1, axis=1)[:, :own]
        candidates, alike = (first + best).astype(np.int32), np.take_along_axis(among, best, 1)
        candidates[alike == -np.inf] = -1
        if first:
            entries = descend(space, above, queries, first)
            ids, like = beam(space[:first], graph[:first], queries, entries, breadth)
            candidates, alike = np.concatenate([candidates, ids], axis=1), np.concatenate([alike, like], axis=1)
        order = np.argsort(-alike, axis=1, kind="stable")[:, :breadth]
        candidates, alike = np.take_along_axis(candidates, order, 1), np.take_along_axis(alike, order, 1)
        _insert(space, graph, degree, first, pruned(space, candidates, alike, links))
        first = end
    return graph


def descend(space: np.ndarray, above: list[np.ndarray], queries: np.ndarray, below: int | None = None) -> np.ndarray:
    """The node that each query reaches in the layers above, or the first node where that is not among the first `below`."""
    at = np.zeros(len(queries), dtype=np.int64)
    for graph in above:
        ids, _ = beam(space[: len(graph)], graph, queries, at, _STEP)
        at = ids[:, 0].astype(np.int64)
    return at if below is None else np.where(at < below, at, 0)


def scaled(x: np.ndarray) -> tuple[np.ndarray, float]:
    """The vectors as 32-bit numbers of length 1 at most, and the largest component, by which they were divided first."""
    top = float(np.abs(x).max())
    small = x / top
    small /= math.sqrt((small**2).sum(axis=1).max())
    return small.astype(np.float32), top


def lifted(x: np.ndarray) -> np.ndarray:
    """One more component, so that all vectors have length 1."""
    return np.column_stack([x, np.sqrt(np.maximum(0, 1 - (x.astype(np.float64) ** 2).sum(axis=1)))]).astype(np.float32)


def build(x: np.ndarray, *, links: int, breadth: int, batch: int = 512) -> tuple[np.ndarray, list[np.ndarray]]:
    """(order of the nodes, layers of neighbours with the lowest first) of the graph of different vectors."""
    draw = mix(np.arange(1, len(x) + 1, dtype=np.uint64)).astype(np.float64) / 2.0**64
    level = np.floor(-np.log(np.maximum(draw, 2.0**-64)) / math.log(links)).astype(np.int64)
    order = np.argsort(-level, kind="stable")
    level = level[order]
    space = lifted(scaled(x[order])[0])
    layers: list[np.ndarray] = []
    for l in range(int(level[0]), -1, -1):
        nodes = int((level >= l).sum())
        layers.append(_layer(space, nodes, 2 * links if l == 0 else links, links, breadth, batch, layers))
    return order, layers[::-1]


def _index(rows: DataFrame, links: int, breadth: int) -> DataFrame:
    """One row for each (dim, shard) of `rows` (dim, shards, row, vec_id, x)."""

    def make(group: pa.Table) -> pa.Table:
        row = group.column("row").to_numpy()
        ids, unnamed = ids_of(group.column("vec_id").combine_chunks())
        order = np.lexsort((row, ids, unnamed))
        x = matrix(group.column("x").combine_chunks(), len(row))[order] + 0.0  # no negative zeros
        # Equal vectors are one node, its rows in the order of their ids.
        _, sample, which = np.unique(x.view(f"V{8 * x.shape[1]}").ravel(), return_index=True, return_inverse=True)
        nodes, layers = build(x[sample], links=links, breadth=breadth)
        place = np.empty(len(nodes), dtype=np.int64)
        place[nodes] = np.arange(len(nodes))
        which = place[which]
        by_node = np.argsort(which, kind="stable")
        first = np.searchsorted(which[by_node], np.arange(len(nodes) + 1))
        order = order[by_node]
        blob = lambda a, kind: pa.array([np.ascontiguousarray(a, dtype=kind).tobytes()], pa.binary())
        return pa.table(
            {
                "dim": pa.array([x.shape[1]], pa.int32()),
                "shard": group.column("shard").slice(0, 1),
                "layers": pa.array([[len(g) for g in layers]], pa.list_(pa.int32())),
                "neighbours": blob(np.concatenate([g.ravel() for g in layers]), "<i4"),
                "x": blob(x[sample[nodes]], "<f8"),
                "first": blob(first, "<i8"),
                "rows": blob(row[order], "<i8"),
                "ids": blob(ids[order], "<i8"),
                "unnamed": blob(unnamed[order], "u1"),
            }
        )

    shard = F.pmod(F.xxhash64("row", F.lit(3)), F.col("shards"))
    return rows.select("dim", shard.alias("shard"), "row", "vec_id", "x").groupBy("dim", "shard").applyInArrow(make, GRAPHS)


class Shard:
    """A shard's graph, as read from its row."""

    def __init__(self, row: dict[str, pa.Scalar], links: int) -> None:
        flat = lambda name, kind: np.frombuffer(row[name].as_py(), dtype=kind)
        self.x = flat("x", "<f8").reshape(-1, row["dim"].as_py())
        self.first, self.rows = flat("first", "<i8"), flat("rows", "<i8")
        self.ids, self.unnamed = flat("ids", "<i8"), flat("unnamed", "u1").astype(bool)
        small, _ = scaled(self.x)
        self.space = lifted(small)
        flat_neighbours, self.layers, at = flat("neighbours", "<i4"), [], 0
        for level, nodes in enumerate(row["layers"].as_py()):
            size = nodes * (links if level else 2 * links)
            self.layers.append(flat_neighbours[at : at + size].reshape(nodes, -1))
            at += size

    def best(self, queries: np.ndarray, query_rows: np.ndarray, k: int, breadth: int, batch: int = 256) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its number, the places (in `rows`) of the best k rows found, and their scores."""
        copies = np.diff(self.first)
        small, _ = scaled(queries)
        small = np.column_stack([small, np.zeros(len(small), dtype=np.float32)])
        for low in range(0, len(queries), batch):
            part = small[low : low + batch]
            entries = descend(self.space, self.layers[:0:-1], part)
            ids, _ = beam(self.space, self.layers[0], part, entries, max(breadth, k + 1))
            for q, nodes in enumerate(ids, start=low):
                nodes = nodes[nodes >= 0]
                if len(self.x) <= breadth or len(nodes) < min(len(self.x), k + 1):
                    nodes = np.arange(len(self.x))
                with np.errstate(over="ignore", invalid="ignore"):
                    scores = (self.x[nodes] * queries[q]).sum(axis=1)
                # No more than k + 1 rows of a node can be among the best k, as they have one score.
                taken = np.minimum(copies[nodes], k + 1)
                own = np.repeat(self.first[nodes], taken) + np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken)
                scores = np.repeat(scores, taken)
                other = self.rows[own] != query_rows[q]
                own, scores = own[other], scores[other]
                top = np.lexsort((self.rows[own], self.ids[own], self.unnamed[own], -scores))[:k]
                yield q, own[top], scores[top]


def nearest(
    vectors: DataFrame,
    queries: Column,
    *,
    k: int = 20,
    shard_rows: int = 16384,
    query_block: int = 4096,
    links: int = 16,
    breadth: int = 128,
    build_breadth: int = 64,
) -> DataFrame:
    """The nearest k rows found in `vectors` (vec_id, embedding) for each row for which `queries`, a condition on vec_id, holds.

    query_id, rank (from 1), vec_id, score.
    """
    not_zero = vectors.where(F.exists("embedding", lambda v: v != 0))
    rows = numbered(not_zero, "graph-rows", queries.alias("asks"))
    rows = counted(rows, shards=(F.lit(True), shard_rows), blocks=(F.col("asks"), query_block))
    graphs = written(_index(rows.where("blocks > 0"), links, build_breadth), "graph-shards")
    asked = packed(rows.where("asks"), "blocks", 4, "row", "vec_id", "x").withColumnsRenamed({"members": "questions", "block": "query_block"})
    # The stated queries against all shards, block by block.
    to_all = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    sizes = rows.where("blocks > 0").groupBy("dim").agg(F.first("shards").alias("shards"), F.first("blocks").alias("blocks"))
    work = graphs.join(sizes.select("dim", "blocks"), "dim").withColumn("query_block", to_all("blocks")).drop("blocks")
    asked = asked.join(sizes.select("dim", "shards"), "dim").withColumn("shard", to_all("shards")).drop("shards")
    pairs = work.join(asked.hint("shuffle_hash"), ["dim", "shard", "query_block"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                shard = Shard({name: batch.column(name)[at] for name in batch.schema.names}, links)
                asked = batch.column("questions")[at].values
                query_rows, query_ids = asked.field("row").to_numpy(), asked.field("vec_id").to_numpy()
                x = matrix(asked.field("x"), len(query_rows))
                out: list[list[np.ndarray]] = [[], [], [], [], [], []]
                for q, own, scores in shard.best(x, query_rows, k, breadth):
                    n = len(own)
                    found = (np.full(n, query_rows[q]), np.full(n, query_ids[q]), shard.rows[own], shard.ids[own], shard.unnamed[own], scores)
                    for to, values in zip(out, found):
                        to.append(values)
                query_row, query_id, row, vec_id, unnamed, score = map(np.concatenate, out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_row), pa.array(query_id), pa.array(row), pa.array(vec_id, mask=unnamed), pa.array(score)],
                    names=["query_row", "query_id", "row", "vec_id", "score"],
                )

    found = pairs.mapInArrow(search, "query_row bigint, query_id bigint, row bigint, vec_id bigint, score double")
    by_score = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
