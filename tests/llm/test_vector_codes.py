from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from rinse.llm import vector_codes
from tests.llm.sqlcheck import same_as_sql

RNG = random.Random(21)


def vectors(n, dim=8, spread=1.0):
    return [[round(RNG.gauss(0, spread), 1) for _ in range(dim)] for _ in range(n)]


ROWS = (
    [(1000 - i, v, i % 4) for i, v in enumerate(vectors(300))]
    + [(2000 + i, [0.5] * 8, None) for i in range(150)]  # one vector holds a third of the rows
    + [(7, None, 1), (8, [], 1), (9, [1.0] * 7 + [None], 1), (10, [float("nan")] * 8, 1), (11, [float("-inf")] * 8, 2)]
    + [(None, [2.0] * 8, 3), (701, [0.3] * 8, 3), (701, [0.1] * 8, 3), (701, [0.1] * 8, None)]
)


def table_of(spark, rows, kind="float"):
    data = [(i, v, label, "x", "y") for i, v, label in rows]
    return spark.createDataFrame(data, f"vec_id bigint, embedding array<{kind}>, label int, code string, key string")


def plain(rows, parts, entries, rounds=2, single=True):
    kept = []
    for i, v, label in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * float(np.float32(x)) if single else 256 * x) for x in v], label, v))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[3]))
    width = len(kept[0][1]) // parts
    books = [[kept[e][1][p * width : (p + 1) * width] for e in range(min(entries, len(kept)))] for p in range(parts)]

    def assign(v, p):
        part = v[p * width : (p + 1) * width]
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v, _, _ in kept:
            for p in range(parts):
                members[p, assign(v, p)[1]].append(v[p * width : (p + 1) * width])
        for (p, e), those in members.items():
            books[p][e] = [sum(c) // len(those) for c in zip(*those)]
    out, by_label = [], defaultdict(int)
    for i, v, label, _ in kept:
        found = [assign(v, p) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
        by_label[label] += out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for entry in b for x in entry).encode()).hexdigest()
    return sorted([(i, c, d, by_label[label]) for i, c, d, label in out], key=repr), digest


def found(spark, rows, kind="float", **settings):
    coded, digest = vector_codes.vector_codes(table_of(spark, rows, kind).repartition(5), **settings)
    return sorted(map(tuple, coded.collect()), key=repr), digest


@pytest.mark.parametrize(("parts", "entries"), [(4, 64), (8, 200), (1, 3)])
def test_same_as_measuring_every_entry(spark, parts, entries):
    assert found(spark, ROWS, parts=parts, entries=entries) == plain(ROWS, parts, entries)


def test_large_components(spark):
    rows = ROWS[:80] + [(1, [1e12, -3.0] + [0.25] * 6, 0), (2, [-(2.0**60)] + [1e-300] * 7, 9)]
    with pytest.raises(Exception, match="does not fit a long"):
        found(spark, rows, "double", parts=4, entries=1)
    rows = ROWS[:80] + [(1, [1e6, -3.0] + [0.25] * 6, 0), (2, [-(2.0**20)] + [1e-300] * 7, 9)]
    for entries in (1, 2, 64):
        assert found(spark, rows, "double", parts=4, entries=entries) == plain(rows, 4, entries, single=False)


def test_fewer_vectors_than_entries(spark):
    assert found(spark, ROWS[:3], parts=2) == plain(ROWS[:3], 2, 64)
    assert found(spark, ROWS[450:455])[0] == [] and found(spark, [])[0] == []


def test_lengths_and_entries_are_checked(spark):
    for rows in ([(1, [1.0] * 6, 0)], [(1, [1.0] * 8, 0), (2, [1.0] * 4, 0)]):
        with pytest.raises(ValueError, match="components"):
            found(spark, rows, parts=4)
    with pytest.raises(Exception, match="of 4 and of 8"):
        found(spark, [(1, [1.0] * 8, 0), (2, [1.0] * 4, 0)], parts=4, entries=1)
    with pytest.raises(ValueError, match="256"):
        found(spark, ROWS, entries=257)


def test_slices_measure_few_entries():
    draw = np.random.default_rng(4)
    entries = draw.integers(-300, 300, (64, 4))
    entries[40] = entries[3]
    slices = vector_codes.Slices(entries)
    x = np.concatenate([draw.integers(-300, 300, (3000, 4)), entries, [[10**6] * 4]])
    best, far = slices.nearest(x)
    d = ((x[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    assert (best == d.argmin(axis=1)).all() and (far == d.min(axis=1)).all() and best[3000 + 40] == 3
    bits = np.unpackbits(slices.within(x, np.full(len(x), slices.radius)).view(np.uint8), axis=1)
    assert bits.sum() < 0.2 * bits.size


def test_same_as_sql(spark):
    assert same_as_sql(spark, "op13_vector_codes", "/root/testdata/sf0.001", ["embeddings"]).num_rows == 500
