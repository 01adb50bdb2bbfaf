from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rinse.llm import queries, shard_graphs

DRAW = np.random.default_rng(12)
ROWS = (
    [(i, DRAW.normal(size=6).round(2).tolist()) for i in range(600)]
    + [(700 + i, [0.5] * 6) for i in range(300)]  # one vector holds a third of the rows
    + [(1200, None), (1220, []), (1240, [1.0] * 5 + [None]), (1260, [float("nan")] * 6), (1280, [float("inf")] * 6), (1300, [0.0] * 6)]
    + [(None, [2.0] * 6), (40, [0.1] * 6), (40, [0.1] * 6)]
    + [(1400 + i, DRAW.normal(size=3).tolist()) for i in range(25)] + [(1440, [1.0, 2.0])]
)


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "z") for i, v in rows], "vec_id bigint, embedding array<double>, row int, dim int, shard string")


def plain(rows, k):
    kept = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = defaultdict(list)
    for a, (q, v) in enumerate(kept):
        if q is not None and q % 20 == 0:
            scored = [(-sum(x * y for x, y in zip(v, w)), i is None, i) for b, (i, w) in enumerate(kept) if a != b and len(v) == len(w)]
            out[q].append([(round(-s, 9), i) for s, _, i in sorted(scored, key=lambda r: (r[0], r[1], r[2] or 0))[:k]])
    return out


def found(spark, rows, k=20, **settings):
    out = defaultdict(list)
    got = shard_graphs.nearest(table_of(spark, rows).repartition(3), F.col("vec_id") % 20 == 0, k=k, **settings)
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r["rank"])):
        out[r.query_id].append((r["rank"], round(r.score, 9), r.vec_id))
    return out


@pytest.mark.parametrize("shard_rows", [100, 16384])
def test_small_tables_are_searched_exactly(spark, shard_rows):
    # Ties at the last rank and ids that occur twice are compared by scores.
    want, got = plain(ROWS, 20), found(spark, ROWS, shard_rows=shard_rows, breadth=1000, query_block=7)
    assert got.keys() == {q for q, lists in want.items() if lists[0]}
    for q, rows in got.items():
        assert sorted(s for _, s, _ in rows) == sorted(s for one in want[q] for s, _ in one), q
        if len(want[q]) == 1:
            assert [(s, i) for _, s, i in rows] == want[q][0] and [r for r, _, _ in rows] == list(range(1, len(rows) + 1))


def test_no_rows_and_no_queries(spark):
    assert not found(spark, []) and not found(spark, [(1, [1.0]), (2, [1.0])]) and not found(spark, [(20, [1.0])])
    assert found(spark, [(20, [1.0]), (3, [2.0])]) == {20: [(1, 2.0, 3)]}


def test_huge_and_tiny_vectors(spark):
    rows = [(i, (DRAW.normal(size=4) * 10.0 ** (i % 5 * 30 - 60)).tolist()) for i in range(60)]
    want, got = plain(rows, 3), found(spark, rows, 3)
    assert {q: [i for _, _, i in r] for q, r in got.items()} == {q: [i for _, i in r[0]] for q, r in want.items()}


def test_recall_on_the_given_vectors(spark):
    """Against brute force, all 2,000 vectors."""
    given = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    x = np.stack(given.column("embedding").to_numpy()).astype(np.float64)
    ids = given.column("vec_id").to_numpy()
    got = defaultdict(set)
    for r in queries.QUERIES["op12_shard_graphs"](spark, "/root/testdata/sf0.1").collect():
        got[r.query_id].add(r.vec_id)
        assert abs(r.score - float(x[ids == r.query_id][0] @ x[ids == r.vec_id][0])) < 1e-12
    hits = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(got[int(ids[q])] & set(ids[np.argsort(-scores)[:20]].tolist()))
    assert hits >= 0.95 * 20 * len(got) and len(got) == (ids % 20 == 0).sum()


def test_graph_reaches_every_node():
    x = np.unique(DRAW.normal(size=(5000, 32)).round(3), axis=0)
    order, layers = shard_graphs.build(x, links=8, breadth=32)
    assert sorted(order.tolist()) == list(range(len(x))) and len(layers[0]) == len(x) and len(layers) > 1
    for graph in layers:
        reached, edge = {0}, [0]
        while edge:
            edge = [int(n) for n in set(graph[edge].ravel().tolist()) - reached if n >= 0]
            reached |= set(edge)
        assert len(reached) >= (0.99 if graph is layers[0] else 0.9) * len(graph)
