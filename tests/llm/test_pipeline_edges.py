"""The stages of corpus_pipeline on tables that are empty, odd, or have columns of the operators' own names."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from rinse.llm.shared import written

FOLDER = "/root/testdata/sf0.001"
PROSE = "the people of the town went down to the river in the morning and the children of the school sang all the way to the bridge "


def through(spark, docs):
    """What each stage but the last keeps, and the last one's rows."""
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, FOLDER)
        if k + 1 < len(corpus_pipeline.STAGES):
            docs = written(docs, f"edge-{name}")
            kept.append(docs)
    return kept, docs


@pytest.fixture(scope="module")
def odd(spark):
    """A few documents of the given table, among them a very long one, copies of one in a third of all rows, null ids, texts
    and sources, and columns with names that the operators use."""
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    rows = [(9000 + k, PROSE * 3, "en", "src0", 1) for k in range(40)]
    rows += [(9100, " ".join(f"{PROSE} part{k} of{k} it{k}" for k in range(20_000)), "en", "src1", 2), (9101, None, None, None, None), (9102, "", "en", "s", 0)]
    rows += [(None, f"{PROSE} without any id at all", "en", None, 3), (9103, "one word after the other", None, None, 5)]
    docs = given.unionByName(spark.createDataFrame(rows, given.schema))
    clashing = {n: "n_chars" for n in ("row", "own", "node", "key", "asked", "passes", "language_mixture", "_own", "_key", "_size", "class_id", "_leak_doc_id")}
    return written(docs.selectExpr("*", *[f"concat('mine ', coalesce({of}, 0)) as {n}" for n, of in clashing.items()]), "odd")


def test_odd_documents(spark, odd):
    kept, index = through(spark, odd)
    before = {(r.doc_id, r.text): r for r in odd.collect()}
    for docs in kept:
        assert docs.columns == odd.columns
        for r in docs.collect():  # every column comes back as it was
            assert r == before[(r.doc_id, r.text)]
    ids = [Counter(r.doc_id for r in docs.collect()) for docs in kept]
    assert 9101 not in ids[0] and 9102 not in ids[0] and {9100, 9103, None} <= set(ids[0])
    assert [d for d in ids[1] if d and 9000 <= d < 9040] == [9000] and {9100, 9103, None} <= set(ids[1])
    assert max(ids[3].values()) <= 2 and sum(ids[3].values()) == index.count()
    assert Counter(r.doc_id for r in index.collect()) == ids[3]


def test_no_documents(spark, odd):
    kept, index = through(spark, odd.limit(0))
    assert [docs.count() for docs in kept] == [0, 0, 0, 0] and index.count() == 0
