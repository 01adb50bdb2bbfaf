from __future__ import annotations

from collections import Counter

import pytest

from rinse.llm import mixing
from tests.llm.sqlcheck import same_as_sql


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 2) for r in rows], "doc_id bigint, source string, text string, words string, k int")


def words(n):
    return " ".join(["w"] * n)


ROWS = [(i, f"s{i % 4}", words(i % 13)) for i in range(300)] + [
    (1, None, "a b\tc"), (2, None, None), (None, "s0", "x y"), (None, "s0", "x y"), (7, "tiny", "one"), (9, "none", " \n"),
    (10, "big", words(30_000)), (11, "s1", "a"), (11, "s1", "a b"),
]


def plain_targets(sizes, cycle=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: cycle[i % 3] for i, s in enumerate(names)}
    target, full = {}, set()
    budget = share * sum(sizes.values())
    while True:
        left = budget - sum(target[s] for s in full)
        rest = sum(weight[s] for s in names if s not in full)
        over = [s for s in names if s not in full and left * weight[s] / rest > most * sizes[s]]
        if not over:
            return {s: target[s] if s in full else left * weight[s] / rest for s in names}
        for s in over:
            target[s] = most * sizes[s]
            full.add(s)


def test_targets_and_taken(spark):
    mixed = mixing.mix_sources(table_of(spark, ROWS), least_slots=500)
    rows = mixed.documents.collect()
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter((d, s, len((t or "").split())) for d, s, t in ROWS)
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    targets = plain_targets(sizes)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.passes == -(-r.taken // r.size if r.size else 0)
        taken[r.source] += r.taken
    for s, t in targets.items():
        assert t - 1 < taken[s] <= t + 1e-6


def test_schedule_reads_blocks_in_low_discrepancy_order(spark):
    mixed = mixing.mix_sources(table_of(spark, ROWS), least_slots=2000)
    slots = mixed.schedule.orderBy("slot").collect()
    total = sum(r.words for r in slots)
    shares = Counter()
    for r in slots:
        shares[r.source] += r.words / total
    seen = Counter()
    for n, r in enumerate(slots[: int(len(slots) * 0.95)], 1):
        seen[r.source] += 1
        assert all(abs(seen[s] - n * shares[s]) < 8 for s in shares)
    passes = Counter((r.source, r.block) for r in slots)
    assert max(passes.values()) <= 2
    assert mixed.schedule.orderBy("slot").collect() == slots


def test_given_weights(spark):
    weights = spark.createDataFrame([("s0", 1.0), ("s1", 5.0), (None, 1.0)], "source string, weight double")
    rows = mixing.mix_sources(table_of(spark, ROWS), weights=weights, share=0.5, least_slots=100).documents.collect()
    assert {r.source for r in rows} == {"s0", "s1", None}


def test_empty_and_wordless(spark):
    assert mixing.mix_sources(table_of(spark, [])).documents.count() == 0
    rows = mixing.mix_sources(table_of(spark, [(1, "a", ""), (2, None, None)])).documents.collect()
    assert [(r.taken, r.size, r.target) for r in rows] == [(0, 0, 0.0)] * 2


def test_same_as_sql(spark, tmp_path):
    same_as_sql(spark, "op4_mixing", "/root/testdata/sf0.001", ["documents"])
    table_of(spark, ROWS).write.parquet(str(tmp_path / "documents.parquet"))
    same_as_sql(spark, "op4_mixing", tmp_path, ["documents"])


def test_no_python_in_the_plan(spark):
    mixed = mixing.mix_sources(table_of(spark, ROWS))
    plan = mixed.documents._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
