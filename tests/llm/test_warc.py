from __future__ import annotations

import base64
import hashlib
from collections import Counter

from rinse.llm import warc
from tests.llm.sqlcheck import same_as_sql

PAGES = [
    (1, "http://a.example/x?y=1", "<p>one</p>"), (2, "http://b.example/", "<p>one</p>"), (7, "bad url\r\nEvil: 1", "<p>one</p>"),
    (3, None, None), (4, "", ""), (5, "http://[", "crlf\r\n\r\nWARC/1.1\r\n\r\nin it é"), (6, "u", "x" * 3_000_000),
    (8, "u", "twice"), (8, "u", "twice"), (9, "u", "\n"), (None, "u", "lonely"), (None, "u", "<p>one</p>"),
]


def pages_of(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "k", 1) for r in rows], "page_id bigint, url string, html string, key string, row int")


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(spark, tmp_path):
    warc.write_archive(pages_of(spark), str(tmp_path / "out"), records_per_file=7)
    got = Counter(map(tuple, warc.page_captures(spark, str(tmp_path / "out")).collect()))
    last, want = {}, Counter()
    for page, _, html in PAGES:
        last[html or ""] = max(last.get(html or "", -1), -1 if page is None else page)
    seen = set()
    for page, _, html in sorted(PAGES, key=lambda x: -1 if x[0] is None else x[0], reverse=True):
        own = html or ""
        kind = "revisit" if own in seen else "response"
        seen.add(own)
        want[(page, len(own.encode()), digest(html), kind, last[own] if kind == "revisit" else None)] += 1
    assert got == want


def test_small_payloads_are_all_responses(spark, tmp_path):
    warc.write_archive(pages_of(spark), str(tmp_path / "out"), least_bytes=6)
    rows = warc.page_captures(spark, str(tmp_path / "out")).collect()
    assert all(r.record_type == "response" for r in rows if r.payload_bytes < 6)
    assert sum(r.record_type == "revisit" for r in rows) == 3


def test_records_and_captures(spark, tmp_path):
    warc.write_archive(pages_of(spark), str(tmp_path / "out"))
    records = warc.read_records(spark, str(tmp_path / "out"))
    kinds = Counter(r.record_type for r in records.select("record_type").collect())
    assert kinds == {"response": 7, "revisit": 5, "request": 12, "metadata": 12}
    rows = warc.captures(records).collect()
    assert len(rows) == 12 and all(r.request.block.startswith("GET ") and r.metadata is not None for r in rows)
    payloads = Counter(bytes(r.response.payload).decode() for r in rows if r.response.record_type == "response")
    assert payloads == Counter({(html or "") for _, _, html in PAGES})
    assert all(r.response.payload_digest == r.response.computed_digest for r in rows if r.response.payload is not None)
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert len(list(warc.parse_records(raw))) == 36
    lonely = records.where("record_type != 'metadata'")
    assert {r.metadata for r in warc.captures(lonely).collect()} == {None}


def test_empty_table(spark, tmp_path):
    warc.write_archive(pages_of(spark, []), str(tmp_path / "out"))
    assert warc.page_captures(spark, str(tmp_path / "out")).count() == 0


def test_same_as_sql(spark, tmp_path):
    same_as_sql(spark, "op10_warc", "/root/testdata/sf0.001", ["pages"])
    unique = {r[0]: r for r in PAGES if r[0] is not None}
    pages_of(spark, list(unique.values())).write.parquet(str(tmp_path / "pages.parquet"))
    same_as_sql(spark, "op10_warc", tmp_path, ["pages"])


def test_shuffled_rows_lose_no_payload(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<p>{i % 200}</p>") for i in range(600)]
    pages = pages_of(spark, rows + rows[:100]).repartition(5).dropDuplicates(["page_id"])
    warc.write_archive(pages, str(tmp_path / "out"), file_bytes=20_000)
    got = warc.page_captures(spark, str(tmp_path / "out")).collect()
    assert Counter(r.record_type for r in got) == {"response": 200, "revisit": 400}
    assert {r.page_id: r.refers_to for r in got} == {i: (i % 200 + 400 if i < 400 else None) for i in range(600)}
    sizes = [p.stat().st_size for p in (tmp_path / "out").glob("part-*")]
    assert len(sizes) > 3 and max(sizes) <= 20_000


def test_what_lost_tasks_left_is_not_read(spark, tmp_path):
    warc.write_archive(pages_of(spark), str(tmp_path / "out"))
    some = next((tmp_path / "out").glob("part-*"))
    (tmp_path / "out" / "part-lost.warc.gz").write_bytes(some.read_bytes())
    assert warc.page_captures(spark, str(tmp_path / "out")).count() == len(PAGES)


def test_one_member_per_record(spark, tmp_path):
    import zlib

    warc.write_archive(pages_of(spark), str(tmp_path / "out"))
    members = []
    for path in (tmp_path / "out").glob("part-*.warc.gz"):
        raw = path.read_bytes()
        while raw:
            unpacker = zlib.decompressobj(31)
            members.append(unpacker.decompress(raw))
            raw = unpacker.unused_data
    assert len(members) == 36 and all(m.startswith(b"WARC/1.1\r\n") and m.endswith(b"\r\n\r\n") for m in members)


def test_archives_of_others(spark, tmp_path):
    def record(kind, more, block):
        return f"WARC/1.0\r\nWARC-Type:{kind}\r\n{more}\r\n\r\n".encode() + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nX: \xe9\r\n\r\nbody"
    records = [
        record("warcinfo", "Content-Length:5", b"a: b\n"),
        record("response", f"WARC-Record-ID: <1>\r\nContent-Length: {len(http)}", http),
        record("response", "WARC-Record-ID: <2>\r\nContent-Length: 46", b"HTTP/1.1 200 OK\r\nContent-Length: 99999999999\r\n\r\nx"[:46] + b""),
        record("revisit", "WARC-Record-ID: <3>\r\nWARC-Refers-To: <1>\r\nContent-Length: 17", b"HTTP/1.1 200 OK\r\n"),
        record("metadata", "WARC-Concurrent-To: <3>\r\nContent-Length: 11", b"page-id: 12"),
        record("response", "WARC-Record-ID: <4>", b"no length"),
        record("request", "WARC-Record-ID: <5>\r\nContent-Length: 500", b"cut off"),
    ]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    found = {r.record_id: r for r in warc.read_records(spark, str(tmp_path)).collect() if r.record_id}
    assert found["<1>"].payload_bytes == 4 and found["<1>"].http_header.endswith("X: \xe9")
    assert found["<3>"].payload_bytes is None and found["<4>"].payload_bytes == 0 and found["<5>"].block.startswith("cut off")
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc.page_captures(spark, str(tmp_path)).collect()}
    assert got == {(None, "response", None), (12, "revisit", None)}
