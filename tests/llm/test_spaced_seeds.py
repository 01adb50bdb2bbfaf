from __future__ import annotations

import random
from itertools import combinations

from rinse.llm import spaced_seeds
from tests.llm.sqlcheck import same_as_sql

WORDS = [f"w{i}" for i in range(400)]
RNG = random.Random(7)


def some(n):
    return [RNG.choice(WORDS) for _ in range(n)]


ITEMS = [(i, some(n)) for i, n in enumerate([40, 25, 20, 15, 12, 11, 10, 7, 5, 4, 3])]


def spoiled(words, every):
    return [f"x{i}" if i % every == every - 1 else w for i, w in enumerate(words)]


def inserted(words):
    return " ".join(some(30) + words + some(20))


def plain_overlap(item, doc, stretch=15, identity=0.8):
    """Whether some stretch of the item agrees along some shift, seeds aside."""
    n = min(stretch, len(item))
    for shift in range(-len(item), len(doc)):
        for t in range(len(item) - n + 1):
            pairs = [(item[t + k], doc[t + k + shift]) for k in range(n) if 0 <= t + k + shift < len(doc)]
            if len(pairs) == n and sum(a == b for a, b in pairs) >= -(-n * identity // 1):
                return True
    return False


DOCS = (
    [(100 + i, inserted(w)) for i, w in ITEMS]
    + [(200 + i, inserted(spoiled(w, 9))) for i, w in ITEMS]
    + [(300, " ".join(ITEMS[0][1][:20])), (301, " ".join(ITEMS[0][1][:13])), (302, " ".join(ITEMS[1][1][8:]) + " " + inserted([]))]
    + [(400 + i, " ".join(some(300))) for i in range(20)]
    + [(500, None), (501, ""), (502, "  "), (None, inserted(ITEMS[2][1]).upper()), (503, "the " * 100_000), (504, inserted(ITEMS[1][1])), (504, "clean text")]
)


def tables(spark):
    docs = spark.createDataFrame([(d, t, "z", 1) for d, t in DOCS], "doc_id bigint, text string, item_id string, seed int")
    rows = [(i, " ".join(w)) for i, w in ITEMS] * 2 + [(77, None), (78, "")]
    return docs, spark.createDataFrame(rows, "item_id bigint, text string")


def test_planted_passages(spark):
    docs, items = tables(spark)
    found = {(r.doc_id, r.item_id) for r in spaced_seeds.overlaps(docs, items).collect()}
    for i, w in ITEMS:
        assert (100 + i, i) in found
        assert (200 + i, i) in found, len(w)  # one word in nine differs
    assert {(300, 0), (302, 1), (None, 2), (504, 1)} <= found and (301, 0) not in found
    assert not any(d and 400 <= d < 504 for d, _ in found)
    long_enough = {i: w for i, w in ITEMS if len(w) >= 15}
    for d, t in DOCS:
        if t and len(t) < 10_000:
            want = {i for i, w in long_enough.items() if plain_overlap(w, t.lower().split())}
            assert {i for doc, i in found if doc == d and i in long_enough} >= want


def substituted(lengths):
    """Items of these lengths, and documents with every placement of the allowed unequal words, and of one more, in 15 words at most."""
    items, docs = [], []
    for item, n in enumerate(lengths):
        words, short = [f"q{item}_{k}" for k in range(n)], min(n, 15)
        items.append((item, " ".join(words)))
        allowed = short - -(-short * 4 // 5)
        for places in [*combinations(range(short), allowed), *combinations(range(short), allowed + 1)]:
            text = ["y", *["z" if k in places else w for k, w in enumerate(words[:short])], "y"]
            docs.append((len(docs), " ".join(text)))
    return items, docs


def missed(spark, items, docs):
    """Pairs that only one of overlaps and the comparison without seeds finds."""
    words = {i: t.split() for i, t in items}
    own = {t.split("_")[0]: i for i, t in items}
    want = set()
    for d, t in docs:
        item = next(own[w.split("_")[0]] for w in t.split() if w.startswith("q"))
        if plain_overlap(words[item], t.split()):
            want.add((d, item))
    found = spaced_seeds.overlaps(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string"))
    return want, {(r.doc_id, r.item_id) for r in found.collect()} ^ want


def test_no_allowed_substitution_is_lost(spark):
    want, other = missed(spark, *substituted([11, 12, 13, 14, 15]))
    assert len(want) >= 55 + 66 + 78 + 91 + 455 and not other


def test_no_allowed_substitution_is_lost_in_short_items(spark):
    want, other = missed(spark, *substituted([5, 6, 7, 8, 9, 10]))
    assert len(want) >= 5 + 6 + 7 + 8 + 9 + 45 and not other


def test_every_fourth_word_replaced(spark):
    _, items = tables(spark)
    doc = spark.createDataFrame([(600, inserted(spoiled(ITEMS[0][1], 4)))], "doc_id int, text string")
    assert [(r.item_id, r.agree) for r in spaced_seeds.overlaps(doc, items).collect()] == [(0, 12)]


def test_blocks_give_the_same(spark):
    docs, items = tables(spark)
    rows = [sorted(spaced_seeds.overlaps(docs, items, block_seeds=n).collect(), key=repr) for n in (100, 10**6)]
    assert rows[0] == rows[1]


def test_clean_documents_stay(spark):
    docs, items = tables(spark)
    kept = spaced_seeds.without_overlaps(docs, items)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert {r.doc_id for r in rows} >= {500, 501, 502, 503, 504, 400} and [r.text for r in rows if r.doc_id == 504] == ["clean text"]
    assert None not in {r.doc_id for r in rows} and len(rows) == len(DOCS) - len({(r.doc_id, r.text_hash) for r in spaced_seeds.overlaps(docs, items).collect()})


def test_empty_tables(spark):
    docs, items = tables(spark)
    assert spaced_seeds.overlaps(docs.limit(0), items).count() == 0
    assert spaced_seeds.overlaps(docs, items.limit(0)).count() == 0


def test_same_as_sql(spark, tmp_path):
    assert same_as_sql(spark, "op8_spaced_seeds", "/root/testdata/sf0.001", ["documents", "benchmark"]).num_rows > 0
    docs, items = tables(spark)
    docs.where("doc_id is null or doc_id != 503").write.parquet(str(tmp_path / "documents.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    same_as_sql(spark, "op8_spaced_seeds", tmp_path, ["documents", "benchmark"])


def test_short_items_match_whole_or_not_at_all(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b x d"), (3, "c"), (4, "d c")], "doc_id int, text string")
    items = spark.createDataFrame([(7, "a b c d"), (8, "d"), (9, "c d")], "item_id int, text string")
    found = sorted((r.doc_id, r.item_id) for r in spaced_seeds.overlaps(docs, items).collect())
    assert found == [(1, 7), (1, 8), (1, 9), (2, 8), (4, 8)]
    assert spaced_seeds.overlaps(docs, items, fewest=5).count() == 0


def test_clashing_names(spark):
    docs, items = tables(spark)
    docs = docs.withColumnsRenamed({"item_id": "leak_doc", "seed": "LEAK_TEXT"})
    kept = spaced_seeds.without_overlaps(docs, items)
    assert kept.columns == docs.columns and kept.where("leak_doc = 'z' and leak_text = 1").count() == kept.count() > 0


def test_no_python_in_the_plan(spark):
    plan = spaced_seeds.overlaps(*tables(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
