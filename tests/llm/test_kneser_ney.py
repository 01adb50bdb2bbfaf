from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import pytest

from rinse.llm import kneser_ney as kn
from rinse.llm import queries

FOLDER = "/root/testdata/sf0.001"
END, START = ("end",), ("start",)


def plain_tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), END]


class Plain:
    def __init__(self, texts):
        rows = [plain_tokens(t) for t in texts]
        self.count = Counter(w for r in rows for w in r)
        self.pair = Counter(p for r in rows for p in zip([START, *r], r))
        self.total = sum(self.count.values())
        self.before = Counter(w for _, w in self.pair)
        self.after = {}
        for (v, _), n in self.pair.items():
            self.after.setdefault(v, []).append(n)
        of = lambda c: kn.discounts([sum(n == k for n in c.values()) for k in (1, 2, 3, 4)])
        self.d, self.lower = of(self.pair), of(self.before)
        self.v = len(self.count)
        self.left = sum(self.lower[min(n, 3) - 1] for n in self.before.values())
        self.sums = {v: (sum(n), sum(self.d[min(k, 3) - 1] for k in n)) for v, n in self.after.items()}

    def single(self, w):
        cut = lambda n, d: max(n - ([0, *d][min(n, 3)]), 0)
        if not self.pair:
            return 1 / (self.v + 1)
        return cut(self.before[w], self.lower) / len(self.pair) + self.left / len(self.pair) / (self.v + 1)

    def chance(self, v, w):
        if v not in self.after:
            return self.single(w)
        n, (total, left) = self.pair[v, w], self.sums[v]
        return (max(n - self.d[min(n, 3) - 1], 0) if n else 0) / total + left / total * self.single(w)

    def score(self, text):
        row = plain_tokens(text)
        base = sum(math.log10((self.count[w] + 0.5) / (self.total + 0.5 * (self.v + 1))) for w in row)
        known = sum(self.count[w] > 0 for w in row)
        return len(row), known, base, sum(math.log10(self.chance(v, w)) for v, w in zip([START, *row], row))


def made():
    rng = random.Random(3)
    pool = [f"w{int(rng.paretovariate(0.7))}" for _ in range(3000)]
    return [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 60))).title() for _ in range(200)] + [None, "", " \n", "a b é É A"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "m", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, lm string, bucket int")


@pytest.mark.parametrize("settings", [{}, {"pairs_in_bucket": 50}])
def test_same_as_a_plain_model(spark, settings):
    texts = made()
    plain, model = Plain(texts[:150]), kn.train(frame(spark, texts[:150]), **settings)
    assert (model.train_tokens, model.vocabulary, model.pairs) == (plain.total, plain.v, len(plain.pair))
    rows = kn.score(frame(spark, texts), kn.load(model.folder)).orderBy("doc_id").collect()
    assert rows[0].__fields__ == ["doc_id", "text", "bucket", "lm"]
    for r, text in zip(rows, texts, strict=True):
        assert tuple(r.lm)[:4] == pytest.approx(plain.score(text))
    assert rows[3].lm.perplexity == pytest.approx(10 ** (-rows[3].lm.score / rows[3].lm.n_tokens))


def test_chances_sum_to_one():
    plain = Plain(made()[:40])
    for v in [START, "w1", "w2", "never", *list(plain.count)[:5]]:
        assert sum(plain.chance(v, w) for w in plain.count) + plain.chance(v, "unknown") == pytest.approx(1)


def test_nothing_to_learn_and_long_texts(spark):
    model = kn.train(frame(spark, made()).limit(0))
    rows = kn.score(frame(spark, ["a b", None]), model).collect()
    assert [tuple(r.lm)[:4] for r in rows] == [(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)]
    texts = ["x y " * 400_000, "x y"] * 2
    plain = Plain(texts)
    for r in kn.score(frame(spark, texts), kn.train(frame(spark, texts))).collect():
        assert tuple(r.lm)[:4] == pytest.approx(plain.score(r.text), rel=1e-6)
    assert kn.score(frame(spark, []), model).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    held = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 5 == 1 for d in docs}
    plain = Plain([d.text for d in docs if not held[d.doc_id]])
    rows = {r.doc_id: r for r in queries.QUERIES["op3_kneser_ney"](spark, FOLDER).collect()}
    assert len(rows) == len(docs)
    for d in docs:
        r = rows[d.doc_id]
        assert (r.held_out, r.train_tokens) == (held[d.doc_id], plain.total)
        assert (r.n_tokens, r.n_known, r.base_score, r.score) == pytest.approx(plain.score(d.text))
    unseen = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_words_of_equal_sums_are_told_apart(spark):
    words = ["".join("ab"[(bin(i).count("1") + k) % 2] for i in range(2048)) for k in range(2)]
    docs = spark.createDataFrame([(0, f"{words[0]} {words[0]}"), (1, words[1])], "doc_id bigint, text string")
    model = kn.train(docs.where("doc_id = 0"))
    found = {r.doc_id: r.lm.n_known for r in kn.score(docs, model).select("doc_id", "lm").collect()}
    assert found == {0: 3, 1: 1}  # the end is known
