from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from rinse.llm import chosen_path
from rinse.llm import components as stars
from rinse.llm.components import components
from rinse.llm.shared import written

RNG = random.Random(11)
WORDS = [f"w{i}" for i in range(3000)]


def some(n):
    return [RNG.choice(WORDS) for _ in range(n)]


def edited(words, times):
    out = list(words)
    for _ in range(times):
        out[RNG.randrange(len(out))] = RNG.choice(WORDS)
    return out


def made():
    rows, base, passage = [], some(120), some(60)
    rows += [edited(base, RNG.randint(0, 4)) for _ in range(150)]  # one large group
    for _ in range(25):
        own = some(RNG.randint(20, 200))
        rows += [own, edited(own, 1), edited(own, 2), own]
    rows += [some(40) + passage + some(40) for _ in range(120)]  # a passage alone makes no link
    rows += [some(RNG.randint(1, 8)) for _ in range(40)]
    texts = [" ".join(x) for x in rows] + ["", "", "  ", None, None, "one two", "One TWO", "one  two"] + [" ".join(base)] * 60
    return [(i * 3, t) for i, t in enumerate(texts)]


def gram_set(text, n=5):
    words = text.translate({i: i + 32 for i in range(65, 91)}).split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def plain(rows, threshold=0.8):
    """Links and classes by comparing every two rows."""
    sets = [None if t is None else gram_set(t) for _, t in rows]
    parent, links = list(range(len(rows))), Counter()

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] is None or rows[j][1] is None:
                continue
            same = rows[i][1] == rows[j][1]
            both = len(sets[i] & sets[j])
            if same or both and both >= threshold * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[max(top(i), top(j))] = min(top(i), top(j))
    return {d: (rows[top(i)][0], links[i]) for i, (d, _) in enumerate(rows)}


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, "n", 5) for d, t in rows], "doc_id bigint, text string, node string, size int")


@pytest.mark.parametrize("settings", [{}, {"bucket": 4, "tile": 30, "signature_tile": 20}])
def test_every_link_and_class(spark, settings):
    rows = made()
    docs = docs_of(spark, rows)
    found = chosen_path.jaccard_classes(docs, **settings)
    got = {r.doc_id: (r.class_id, r.n_links) for r in chosen_path.with_classes(docs, found).collect()}
    assert got == plain(rows)
    kept = chosen_path.one_of_each(docs, found)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c, _ in got.values()})


def test_odd_rows(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f"), (2, None), (None, None), (5, "x " * 300_000), (5, "x " * 300_000), (6, "")]
    docs = docs_of(spark, rows)
    found = chosen_path.jaccard_classes(docs)
    got = Counter(map(tuple, chosen_path.with_classes(docs, found).collect()))
    assert got == Counter({(None, 1, 2): 2, (1, 1, 2): 1, (2, 2, 0): 1, (None, None, 0): 1, (5, 5, 1): 2, (6, 6, 0): 1})
    assert Counter(r.doc_id for r in chosen_path.one_of_each(docs, found).collect()) == Counter([1, 2, None, 5, 6])
    empty = docs.limit(0)
    assert chosen_path.with_classes(empty, chosen_path.jaccard_classes(empty)).count() == 0


def test_runs_reach_the_recall():
    assert chosen_path.runs_for(0.99999, 0.8, 4) == 5
    lost, rng = 0, np.random.default_rng(2)

    def survives(depth):
        return depth == 0 or any(rng.random() < 0.8 and survives(depth - 1) for _ in range(2))

    lost = np.mean([not survives(4) for _ in range(5000)])
    assert abs(lost - 0.0615) < 0.015


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1000, 1060)] + [(0, k) for k in range(1, 900)] + [(2000, 2000), (3000, 3001), (3001, 3000)]
    rows = components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    got = {r.node: r.component for r in rows}
    want = {k: 0 for k in range(900)} | {k: 1000 for k in range(1000, 1061)} | {3000: 3000, 3001: 3000}
    assert got == want and len(rows) == len(want)


def test_components_of_finished_stars_take_no_round(spark, monkeypatch):
    def star(*_):
        raise AssertionError("a round")

    monkeypatch.setattr(stars, "_star", star)
    edges = [(0, k) for k in range(1, 40)] + [(7000, 50), (60, 50), (50, 60), (8, 8)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {k: 0 for k in range(40)} | {k: 50 for k in (50, 60, 7000)}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_few_rows_make_few_files(spark):
    rows = spark.range(100).repartition(8)
    for about, files in ((100, 1), (12_000, 3), (10**9, 8), (None, 8)):
        out = written(rows, "few", about)
        assert (len(out.inputFiles()), out.count()) == (files, 100)


def test_later_levels_read_open_sets_alone(spark, monkeypatch):
    rng, passage, read = random.Random(29), some(60), []

    def counting(df, name, *about):
        if name == "path-sized":
            read.append({f.split("/")[-2].rsplit("-", 1)[0] for f in df.inputFiles()})
        return written(df, name, *about)

    monkeypatch.setattr(chosen_path, "written", counting)
    words = lambda n: [rng.choice(WORDS) for _ in range(n)]
    rows = list(enumerate(" ".join(words(30) + passage + words(30)) for _ in range(60)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = chosen_path.with_classes(docs, chosen_path.jaccard_classes(docs, bucket=4, signature_tile=20))
    assert {r.doc_id: (r.class_id, r.n_links) for r in found.collect()} == plain(rows)
    assert len(read) > 1 and "path-texts" in read[0] and not any("path-texts" in x for x in read[1:])


def thue_morse(n, other=0):
    return "".join("ab"[(bin(i).count("1") + other) % 2] for i in range(n))


def test_words_are_told_apart(spark):
    rows = [(k, f"{thue_morse(2048, k)} is one word") for k in range(2)] + [(2 + k, thue_morse(1024, k)) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = chosen_path.with_classes(docs, chosen_path.jaccard_classes(docs))
    assert {(r.doc_id, r.class_id, r.n_links) for r in found.collect()} == {(k, k, 0) for k in range(4)}


def test_a_large_group_is_not_carried_through_the_levels(spark, monkeypatch):
    base = some(150)
    texts = {" ".join(edited(base, RNG.randint(1, 3))) for _ in range(600)}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(sorted(texts))], "doc_id bigint, text string")
    rows = []
    counted = chosen_path._children

    def counting(paths, coordinates):
        out = counted(paths, coordinates)
        rows.append(out.count())
        return out

    monkeypatch.setattr(chosen_path, "_children", counting)
    found = chosen_path.with_classes(docs, chosen_path.jaccard_classes(docs))
    assert Counter(r.n_links for r in found.collect()) == Counter(n for _, n in plain([(i, t) for i, t in enumerate(sorted(texts))]).values())
    assert rows[0] >= 10 * len(texts) and sum(rows[1:]) == 0


def test_a_large_group_with_some_others_is_not_carried_through_the_levels(spark, monkeypatch):
    rng = random.Random(23)
    passage, base = some(100), some(110)
    near = {" ".join(passage + base[:k] + [rng.choice(WORDS)] + base[k + 1 :]) for k in [rng.randrange(110) for _ in range(500)]}
    rows = list(enumerate(sorted(near) + [" ".join(passage + some(60)) for _ in range(200)]))
    counts = []
    counted = chosen_path._children

    def counting(paths, coordinates):
        out = counted(paths, coordinates)
        counts.append(out.count())
        return out

    monkeypatch.setattr(chosen_path, "_children", counting)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = chosen_path.with_classes(docs, chosen_path.jaccard_classes(docs))
    assert {r.doc_id: (r.class_id, r.n_links) for r in found.collect()} == plain(rows)
    assert counts[0] == 10 * len(rows) and sum(counts[1:]) == 0


def test_leaders():
    assert chosen_path._joined_leaders([]) == 1
    assert chosen_path._joined_leaders([0b0011, 0b0110, 0b1000, 0]) == 0b0111
    assert chosen_path._joined_leaders([0b1100, 0b0110, 0b0011]) == 0b1111
