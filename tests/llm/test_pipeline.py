from __future__ import annotations

from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from rinse.llm import language_mixture, mixing
from rinse.llm.shared import written
from tests.llm.test_chosen_path import plain
from tests.llm.test_mixing import plain_targets
from tests.llm.test_spaced_seeds import plain_overlap

FOLDER = "/root/testdata/sf0.001"


def test_each_stage_against_a_plain_version(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = [(9001, None, "en", "src0", 0), (9002, "12 34", "en", "src0", 5), (9003, None, None, None, None)]
    docs = written(documents.unionByName(spark.createDataFrame(extra, documents.schema)), "in")
    items = [r.text.lower().split() for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = written(stage(spark, docs, FOLDER), name)
        assert docs.columns == documents.columns
        after = docs.collect()
        seen.append(len(after))
        if name == "language":
            assert {r.doc_id for r in before} - {r.doc_id for r in after} == {9001, 9002, 9003}
        elif name == "near_duplicates":
            want = {c for c, _ in plain([(r.doc_id, r.text) for r in before]).values()}
            assert sorted(r.doc_id for r in after) == sorted(want) and len(after) < len(before)
        elif name == "decontaminate":
            bags = {r.doc_id: r.text.lower().split() for r in before}
            near = [(d, w, i) for d, w in bags.items() for i in items if len(set(i) & set(w)) >= 0.7 * min(15, len(set(i)))]
            # Where few distinct words of an item occur at all, there is nothing to compare.
            rare = {w for w, n in Counter(w for x in bags.values() for w in set(x)).items() if n < 30}
            leaks = {d for d, w, i in near if set(i) & set(w) & rare and plain_overlap(i, w)}
            assert {r.doc_id for r in before} - {r.doc_id for r in after} == leaks
        else:
            size = {r.doc_id: len(r.text.split()) for r in before}
            source = {r.doc_id: r.source for r in before}
            sizes = Counter()
            for d, n in size.items():
                sizes[source[d]] += n
            taken, longest = Counter(), Counter()
            times = Counter(r.doc_id for r in after)
            assert max(times.values()) <= 2
            for d, n in times.items():
                taken[source[d]] += n * size[d]
                longest[source[d]] = max(longest[source[d]], size[d])
            for s, target in plain_targets(sizes).items():
                # Documents at both ends of a reading stand whole.
                assert target - 1 < taken[s] < target + 2 * longest[s]
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).orderBy("start").collect()
    want = sorted((r.doc_id, len(encode(r.text, add_special_tokens=False).ids) + 1) for r in docs.collect())
    assert [(r.doc_id, r.n_tokens) for r in rows] == want
    assert [r.start for r in rows] == [sum(n for _, n in want[:k]) for k in range(len(want))]
    assert seen == sorted(seen[:3], reverse=True) + seen[3:]


def test_mixed_rows_keep_odd_rows(spark):
    rows = [(1, None, "a b", 1), (1, None, "a b", 1), (None, "s", "x", 2), (None, "s", "y", 3), (3, "s", None, 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, taken int")
    got = mixing.mixed_rows(docs, share=2.0).collect()
    assert Counter(map(tuple, got)) == Counter({rows[0]: 4, rows[2]: 2, rows[3]: 2})
    assert mixing.mixed_rows(docs.limit(0)).count() == 0


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 50
    assert language_mixture.UNKNOWN == "und"
