from __future__ import annotations

import random
import re

from rinse.llm import license_rules as lr
from rinse.llm import queries

FOLDER = "/root/testdata/sf0.001"


def plain_words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def plain_base(words):
    return sorted((k, label) for phrase, label in lr.BASE for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split())


def plain_detections(words):
    """Every rule on every text, and every interval against every other."""
    text, found = f" {' '.join(words)} ", []
    for k, (rule, _, pattern) in enumerate(lr.rules()):
        for m in re.finditer(pattern.pattern.decode(), text):
            found.append((text[: m.start()].count(" ") - 1, text[: m.end()].count(" "), rule.priority, k))
    key = lambda x: (-x[2], x[0] - x[1], x[0], x[3])
    kept = []
    for x in sorted(found, key=key):
        if not any(y[0] <= x[0] and x[1] <= y[1] for y in kept):
            kept.append(x)
    return sorted(kept)


TEXTS = [
    None, "", " -- ", "MIT License", "the MIT  license. Apache-License GNU General Public License, version 2 or later",
    "GNU Lesser General Public License version 2.1", "cc by cc by-sa 4.0 CC-BY", "gnu general public license " * 4000,
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "apache license version 2.0 apache license",
    "Redistribution and use in source and binary forms, with or without modification, are permitted all rights reserved", "ümit license mit licenseé",
]


def test_scan_is_that_of_every_rule():
    rng = random.Random(2)
    pool = [w for r, _, _ in lr.rules() for w in re.findall(r"[a-z0-9]+", r.pattern.replace("[sc]", "s"))] + ["zz", "MIT", "License,"]
    texts = TEXTS + [" ".join(rng.choice(pool) for _ in range(60)) for _ in range(60)]
    for text in texts:
        words = plain_words(text)
        n, base, found = lr.scan(text)
        assert (n, sorted(base)) == (len(words), plain_base(words))
        if len(words) < 1000:
            assert found == plain_detections(words)


def test_hundreds_of_rules_with_sound_keywords():
    assert len(lr.rules()) > 250
    for rule, keyword, _ in lr.rules():
        assert keyword.decode().strip() in re.sub(r"\W+", " ", rule.pattern), rule


def test_specific_rules_win():
    label = lambda t: [lr.rules()[k][0].label for *_, k in lr.scan(t)[2]]
    assert label("GNU Lesser General Public License version 2.1") == ["lgpl-2.1"]
    assert label("Apache License, Version 2.0") == ["apache-2.0"]
    assert label("CC BY-NC-SA 4.0") == ["cc-by-nc-sa-4.0"]
    assert label("under the GPL v3 or later")[-1] in ("gpl-3+", "gpl-3")


def test_frame(spark):
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(TEXTS)] + [(None, "mit license", "k", 2)] * 2, "doc_id bigint, text string, licenses string, n_words int")
    rows = lr.license_scan(docs).collect()
    assert rows[0].__fields__ == ["doc_id", "text", "n_words", "licenses"] and len(rows) == len(TEXTS) + 2
    assert [len(r.licenses.base) for r in rows][-2:] == [1, 1] and rows[7].licenses.n_words == 16000 and len(rows[7].licenses.base) == 4000
    assert lr.license_scan(docs.limit(0)).count() == 0


def test_query(spark):
    rows = queries.QUERIES["op9_license_rules"](spark, FOLDER).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        words = plain_words(texts[r.doc_id])
        base = plain_base(words)
        labels = sorted({x for _, x in base})
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(base), ",".join(labels))
        assert (r.first_word, r.last_word) == ((base[0][0], base[-1][0]) if base else (None, None))
        more = {lr.rules()[k][0].label for *_, k in plain_detections(words)}
        assert r.labels == ",".join(sorted(more | set(labels))) and 0 <= r.score <= 1
