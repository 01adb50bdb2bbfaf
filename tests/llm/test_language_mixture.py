from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from rinse.llm import language_mixture as lm
from rinse.llm import queries
from rinse.llm.bytewords import text_slices

FOLDER = "/root/testdata/sf0.01"
ENGLISH = "the house and the garden were there when they walked with nothing to say about weather".split()
GERMAN = "das haus und der garten waren noch nicht fertig als wir durch die strasse gingen weil".split()


def some(words, n, rng):
    return " ".join(rng.choice(words) for _ in range(n))


def model_of(spark, extra=()):
    rng = random.Random(3)
    rows = [(some(ENGLISH, 30, rng), "en") for _ in range(20)] + [(some(GERMAN, 30, rng), "de") for _ in range(20)]
    return lm.learn_languages(spark.createDataFrame(rows + list(extra), "text string, lang string"))


def plain_gram_counts(rows):
    code = {chr(c): c - 96 for c in range(97, 123)}
    out = {}
    for text, lang in rows:
        symbols = [0] + [code.get(chr(b).lower(), b - 101 if b > 127 else 0) for b in text.encode()] + [0]
        for i in range(1, len(symbols) - 1):
            if symbols[i]:
                gram = (symbols[i - 1] * 155 + symbols[i]) * 155 + symbols[i + 1]
                bucket = ((gram * 0x9E3779B97F4A7C15) % 2**64) >> (64 - lm.BITS)
                out[lang, bucket] = out.get((lang, bucket), 0) + 1
    return out


def test_counts_are_those_of_a_plain_count(spark):
    rows = [("Ab c! dé", "x"), ("ab", "y"), ("", "x"), (None, "x"), ("zz", None), ("q" * 3000, "y")] * 3
    model = lm.learn_languages(spark.createDataFrame(rows, "text string, lang string"), smoothing=0.5)
    counts = plain_gram_counts([r for r in rows if None not in r])
    assert model.languages == ("x", "y")
    for k, lang in enumerate(model.languages):
        total = sum(n for (own, _), n in counts.items() if own == lang)
        for (own, bucket), n in counts.items():
            if own == lang:
                assert abs(model.log_likelihood[bucket, k] - np.log((n + 0.5) / (total + 0.5 * 2**lm.BITS))) < 1e-5


def plain_em(chances, rounds):
    share = np.full(chances.shape[1], 1 / chances.shape[1])
    for _ in range(rounds):
        share = np.mean([(c * share) / (c * share).sum() for c in chances], axis=0)
    return share


def test_mixture_is_plain_em():
    rng = np.random.default_rng(1)
    chances = rng.random((30, 3))
    starts = np.array([0, 7, 20])
    row = np.repeat([0, 1, 2], [7, 13, 10])
    shares, fit = lm.mixture(np.ones(30), chances, row, starts, 9)
    for k, part in enumerate(np.split(chances, starts[1:])):
        assert np.allclose(shares[k], plain_em(part, 9))
        assert np.isclose(fit[k], np.log(part @ plain_em(part, 9)).sum())


def test_shares_of_mixed_documents(spark):
    rng = random.Random(4)
    texts = [some(ENGLISH, 60, rng), some(GERMAN, 60, rng), some(ENGLISH, 60, rng) + " " + some(GERMAN, 30, rng)]
    found = lm.predict_languages(spark.createDataFrame([(t,) for t in texts], "text string"), model_of(spark)).collect()
    assert [[x.lang for x in r.language.languages] for r in found] == [["en"], ["de"], ["de", "en"]]
    assert abs({x.lang: x.share for x in found[2].language.languages}["en"] - 2 / 3) < 0.12
    assert all(r.language.fits for r in found)


def test_six_languages_in_one_document(spark):
    rng = random.Random(8)
    letters = ["abc", "defg", "hijk", "lmno", "pqrs", "tuvw"]
    words = [["".join(rng.choice(own) for _ in range(5)) for _ in range(12)] for own in letters]
    rows = [(some(w, 40, rng), f"l{k}") for k, w in enumerate(words) for _ in range(10)]
    model = lm.learn_languages(spark.createDataFrame(rows, "text string, lang string"))
    docs = spark.createDataFrame([(" ".join(some(w, 60, rng) for w in words),)], "text string")
    found = lm.predict_languages(docs, model).first().language
    assert sorted(x.lang for x in found.languages) == [f"l{k}" for k in range(6)]
    assert all(abs(x.share - 1 / 6) < 0.05 for x in found.languages)


def test_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "12 !? —", 5), (None, "the house", None), (4, "the " * 200_000, 1), (4, "das haus", 1), (4, "das haus", 1)]
    docs = spark.createDataFrame([(d, t, n, "x") for d, t, n in rows], "doc_id int, text string, language int, score string")
    found = lm.predict_languages(docs, model_of(spark)).collect()
    assert found[0].__fields__ == ["doc_id", "text", "score", "language"]
    assert [r.language.pred for r in found] == ["und", "und", "und", "en", "en", "de", "de"]
    assert [r.language.score for r in found[:3]] == [0, 0, 0] and not any(r.language.fits for r in found[:3])
    assert all(r.language.languages == [] for r in found[:3])
    empty = lm.predict_languages(docs.limit(0), model_of(spark))
    assert empty.count() == 0
    nothing = lm.learn_languages(docs.select("text", F_null()).limit(0))
    assert {r.language.pred for r in lm.predict_languages(docs, nothing).collect()} == {"und"}


def F_null():
    from pyspark.sql import functions as F

    return F.lit(None).cast("string").alias("lang")


def test_noise_does_not_fit(spark):
    rng = random.Random(8)
    noise = " ".join("".join(rng.choice("qxzjkvwq") for _ in range(9)) for _ in range(60))
    found = lm.predict_languages(spark.createDataFrame([(noise,), ("und das haus",)], "text string"), model_of(spark)).collect()
    assert [r.language.fits for r in found] == [False, True]


def test_slices_do_not_change_results(spark):
    rng = random.Random(6)
    model = model_of(spark)
    texts = [some(ENGLISH + GERMAN, rng.randint(0, 40), rng) for _ in range(50)]
    results = []
    for most in (50, 1 << 20):
        got = [lm._infer(model, d, o, 4, 15, 3.0)[0] for _, _, d, o in text_slices(pa.array(texts), most)]
        results.append(np.concatenate(got))
    assert np.allclose(*results)


def test_held_out_accuracy(spark):
    found = queries.QUERIES["op2_language_mixture"](spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    assert found.count() == truth.count()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows) > 100
