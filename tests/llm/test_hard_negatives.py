from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rinse.llm import hard_negatives
from tests.llm.sqlcheck import same_as_sql

RNG = random.Random(33)


def vectors(n, dim=6, spread=1.0):
    return [[round(RNG.gauss(0.4, spread), 1) for _ in range(dim)] for _ in range(n)]


ROWS = (
    [(i, v, i % 5) for i, v in enumerate(vectors(500))]
    + [(600 + i, [0.5] * 6, i % 2) for i in range(250)]  # one vector holds a third of the rows
    + [(900, None, 1), (950, [], 1), (1000, [1.0] * 5 + [None], 1), (1050, [float("nan")] * 6, 1), (1100, [1.0] * 6, None)]
    + [(None, [2.0] * 6, 3), (50, [0.1] * 6, 2), (50, [0.1] * 6, 2), (1150, [0.0] * 6, 1), (1200, [-5.0] * 6, 8)]
    + [(2000 + i, v, i % 2) for i, v in enumerate(vectors(12, 3))] + [(2050, [1.0, 2.0, 1.0], 0), (2100, [1.0, 2.0], 0)]
)


def table_of(spark, rows, kind="float"):
    data = [(i, v, label, 1, 2, "z") for i, v, label in rows]
    return spark.createDataFrame(data, f"vec_id bigint, embedding array<{kind}>, label int, row int, dim int, score string")


def plain(rows, single=True, positives=5, negatives=3, low=50, high=95):
    number = (lambda x: float(np.float32(x))) if single else float
    kept = [
        (i, [math.floor(256 * number(x)) for x in v], label)
        for i, v, label in rows
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = Counter()
    for a, (anchor, q, own) in enumerate(kept):
        if anchor is None or anchor % 50:
            continue
        scored = [(sum(x * y for x, y in zip(q, v)), i, label) for b, (i, v, label) in enumerate(kept) if a != b and len(v) == len(q)]
        scored.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        for p, positive, _ in [r for r in scored if r[2] == own][:positives]:
            window = [r for r in scored if r[2] != own and low * p <= 100 * r[0] <= high * p]
            for rank, (n, negative, _) in enumerate(window[:negatives], 1):
                out[(anchor, positive, rank, negative, p, n)] += 1
    return out


def found(spark, rows, kind="float", **settings):
    got = hard_negatives.hard_negatives(table_of(spark, rows, kind).repartition(3), F.col("vec_id") % 50 == 0, **settings)
    return Counter(map(tuple, got.collect()))


def test_same_as_comparing_all(spark):
    want = plain(ROWS)
    assert len(want) > 100 and found(spark, ROWS) == want


def test_blocks_and_falling_thresholds_give_the_same(spark):
    # A pilot of a few rows fills no window, so thresholds fall to the lower ends.
    assert found(spark, ROWS, block=64, anchor_block=5, pilot=8) == plain(ROWS)
    assert found(spark, ROWS, positives=2, negatives=9, low=30, high=100) == plain(ROWS, True, 2, 9, 30, 100)


def test_large_components_are_exact(spark):
    rows = [(i, [x * 2.0**22 for x in v], label) for i, v, label in ROWS[:120]] + ROWS[120:200]
    assert found(spark, rows, "double") == plain(rows, single=False)
    with pytest.raises(Exception, match="does not fit a long"):
        found(spark, [(0, [1e12] * 3, 1), (1, [1e12] * 3, 1)], "double")


def test_no_rows_no_anchors_no_positives(spark):
    assert not found(spark, []) and not found(spark, [(1, [1.0], 1), (2, [1.0], 2), (50, [1.0, 1.0], 1), (3, [1.0, 1.0], 2)])


def test_threshold_join_leaves_out_and_prunes():
    draw = np.random.default_rng(8)
    x = np.floor(draw.normal(0, 40, (2000, 64)))
    x[:5] = x[100]
    block = hard_negatives.Block(x)
    anchors = x[100:110]
    least = np.full(10, 0.6 * (anchors**2).sum(axis=1).min())
    at, row, score = block.above(anchors, least)
    exact = anchors @ x.T
    assert {*zip(at.tolist(), row.tolist(), score.tolist())} == {(a, r, exact[a, r]) for a, r in zip(*np.nonzero(exact >= least[:, None]))}
    norms = np.sqrt(np.cumsum(anchors[:, block.heavy] ** 2, axis=1))
    left_out = block.left_out(np.column_stack([np.zeros(10), norms]), least.min())
    assert left_out.mean() > 16 and len(at) < 100  # a quarter of the index and more
    every = block.above(anchors, np.full(10, -float(2**63)))
    assert len(every[0]) == 10 * 2000


def test_same_as_sql(spark):
    assert same_as_sql(spark, "op11_hard_negatives", "/root/testdata/sf0.001", ["embeddings"]).num_rows > 100
