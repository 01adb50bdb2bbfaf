from __future__ import annotations

import random

from rinse.llm import line_spread
from tests.llm.sqlcheck import same_as_sql

RNG = random.Random(4)


def made():
    rows = []
    for i in range(600):
        lines = [f"own line {i} {k}" for k in range(RNG.randint(0, 4))]
        lines += [f" spread {n}\t" for n in range(1, 12) if i % 40 < n] + ["everywhere"] + ["", "  "]
        RNG.shuffle(lines)
        rows.append((i, "\n".join(lines), f"site{i % 40}"))
    rows += [(700, None, "a"), (701, "", None), (702, "\n\n", "b"), (None, "everywhere\r\nleft", None), (703, "everywhere", "c"), (703, "everywhere", "c")]
    rows += [(800 + i, "often on one site", "one") for i in range(50)] + [(900, "long " * 300_000 + "\neverywhere", "x")]
    return rows


def plain(rows, min_sites):
    sites = {}
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            sites.setdefault(line.strip(" \t\r"), set()).add(site)
    bad = {x for x, s in sites.items() if x and len(s) >= min_sites}
    out = []
    for doc, text, _ in rows:
        lines = [] if text is None else text.split("\n")
        left = [x for x in lines if x.strip(" \t\r") not in bad]
        out.append((doc, len(lines), [k for k, x in enumerate(lines) if x.strip(" \t\r") in bad], None if text is None else "\n".join(left)))
    return sorted(out, key=repr)


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "k", 0) for r in rows], "doc_id bigint, text string, source string, line string, n int")


def test_every_threshold(spark):
    rows = made()
    for least in (3, 5, 30):
        found = line_spread.without_spread_lines(docs_of(spark, rows), min_sites=least)
        assert found.columns == ["doc_id", "text", "source", "line", "n", "line_spread"]
        got = sorted([(r.doc_id, *r.line_spread) for r in found.collect()], key=repr)
        assert got == plain(rows, least)


def test_lines_far_from_the_threshold_are_estimated(spark):
    rows = made()
    found = {r.exact for r in line_spread.line_spreads(docs_of(spark, rows), 5, "source").collect()}
    assert found == {True, False}
    assert {round(r.sites) for r in line_spread.line_spreads(docs_of(spark, rows), 30, "source").collect()} <= {41, 42, 43, 44, 45, 46}


def test_empty_table(spark):
    assert line_spread.without_spread_lines(docs_of(spark, [])).count() == 0


def test_same_as_sql(spark, tmp_path):
    same_as_sql(spark, "op7_line_spread", "/root/testdata/sf0.001", ["documents"])
    docs_of(spark, made()).write.parquet(str(tmp_path / "documents.parquet"))
    same_as_sql(spark, "op7_line_spread", tmp_path, ["documents"])
