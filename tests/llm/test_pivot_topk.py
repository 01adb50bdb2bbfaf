from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rinse.llm import pivot_topk
from tests.llm.sqlcheck import same_as_sql

RNG = random.Random(9)


def vectors(n, dim=8, spread=1.0):
    return [[round(RNG.gauss(0, spread), 2) for _ in range(dim)] for _ in range(n)]


ROWS = (
    [(i, v) for i, v in enumerate(vectors(400))]
    + [(500 + i, [0.5] * 8) for i in range(30)]  # ties
    + [(600, None), (601, []), (602, [1.0] * 7 + [None]), (650, [float("nan")] * 8), (700, [float("inf")] * 8)]
    + [(None, [2.0] * 8), (50, [0.1] * 8), (50, [0.1] * 8)]
    + [(800 + i, v) for i, v in enumerate(vectors(6, 3))] + [(1000, [1.0, 2.0])]
)


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<float>, label int, dim int")


def plain(rows, k=5):
    whole = []
    for i, v in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = Counter()
    for a, (q, v) in enumerate(whole):
        if q is not None and q % 50 == 0:
            scored = [(-sum(x * y for x, y in zip(v, w)), i is None, i) for b, (i, w) in enumerate(whole) if a != b and len(v) == len(w)]
            for rank, (score, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
                out[(q, rank, i, -score)] += 1
    return out


def found(spark, rows, **settings):
    return Counter(map(tuple, pivot_topk.top_k(table_of(spark, rows), F.col("vec_id") % 50 == 0, **settings).collect()))


def test_same_as_comparing_all(spark):
    want = plain(ROWS)
    assert found(spark, ROWS) == want
    assert found(spark, ROWS, block=40, query_block=3, step=7, pivots=4, pilot=30) == want
    assert found(spark, ROWS, block=40, query_block=3, step=7, pivots=4) == want


def test_large_values_are_exact(spark):
    rows = [(i, [x * 4000 for x in v]) for i, v in enumerate(vectors(120))] + [(200, [2.0**18] * 8), (300, [2.0**21] * 8)]
    assert found(spark, rows) == plain(rows)


def test_no_finite_vector_is_dropped(spark):
    rows = [(50, [2.0**19, 1.0]), (1, [1.0, 2.0]), (2, [-1.0, 0.5]), (100, [2.0**60, 0.0]), (3, [0.0, 2.0**18]), (4, [0.0, -(2.0**18)])]
    rows += [(10 + i, v) for i, v in enumerate(vectors(20, 2))]
    with pytest.raises(Exception, match="does not fit a long"):
        found(spark, rows)
    rows[3] = (100, [0.0, 2.0**28])
    got = found(spark, rows)
    assert got == plain(rows) and sum(1 for q, *_ in got if q == 50) == 5


def test_search_stops_early():
    x = np.array(vectors(3000, 4, 50.0))
    x = np.floor(x)
    seen = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.dtype == np.int64 and key.ndim == 1:
                seen.append(len(key))
            return super().__getitem__(key)

    rows = np.arange(3000)
    best = list(pivot_topk.best_of_block(x[:5], rows[:5], x.view(Counting), rows, rows, 5, 16, 64))
    for q, at, scores in best:
        order = sorted((r for r in rows.tolist() if r != q), key=lambda r: (-(x[r] @ x[q]), r))[:5]
        assert at.tolist() == order and scores.tolist() == [x[r] @ x[q] for r in order]
    assert sum(seen) < 0.9 * 5 * 3000


def test_no_rows_and_no_queries(spark):
    assert not found(spark, []) and not found(spark, [(1, [1.0]), (2, [1.0])]) and not found(spark, [(50, [1.0])])


def test_same_as_sql(spark, tmp_path):
    same_as_sql(spark, "op6_pivot_topk", "/root/testdata/sf0.001", ["embeddings"])
    unique = {i: (i, v) for i, v in ROWS if i is not None}
    table_of(spark, list(unique.values())).write.parquet(str(tmp_path / "embeddings.parquet"))
    same_as_sql(spark, "op6_pivot_topk", tmp_path, ["embeddings"])


def test_a_bound_from_the_pilot_skips_blocks():
    draw = np.random.default_rng(3)
    x = np.floor(draw.normal(0, 30, (2000, 4)))
    rows = np.arange(2000)
    stored = pivot_topk.pivot_table(x, 16)
    scores = np.sort(x @ x[7])[::-1]
    best = [at.tolist() for _, at, _ in pivot_topk.best_of_block(x[7:8], rows[7:8], x, rows, rows, 5, 16, 64, stored, np.array([scores[5]]))]
    plain_best = [at.tolist() for _, at, _ in pivot_topk.best_of_block(x[7:8], rows[7:8], x, rows, rows, 5, 16, 64)]
    assert best == plain_best
    nothing = list(pivot_topk.best_of_block(x[7:8], rows[7:8], x, rows, rows, 5, 16, 64, stored, np.array([10.0**9])))
    assert [len(at) for _, at, _ in nothing] == [0]
