"""WARC archives: writing captures, reading records, and assembling transactions.

A capture is a request, a response (or a revisit, which leaves out a payload kept elsewhere) and a metadata record;
the request and the metadata name the response in WARC-Concurrent-To. Reading joins the three on that identifier into
one nested row per capture.

Tasks write files of about `file_bytes` and at most `records_per_file` records, each record a gzip member of its own, under
names of their own; a table of the names that counts only what tasks that succeeded returned lies beside them, so
what a lost or repeated task left is never read. Of captures with equal payloads of at least `least_bytes` the one with
the largest page_id (of equal ids, the last url; of equal rows, one) is the response, and the others revisit it: its
record is named after the payload's checksum, so that nobody has to look it up. Null html is an empty payload, null or
blank urls are `urn:page:` and a number; line breaks and spaces in urls are percent-coded. Null page_ids are the
smallest and come back as null. Extra columns are ignored.

Archives of others are read as they are: zipped or not, headers that are no UTF-8 are read as Latin-1, a false or
missing length in the HTTP header is ignored, a record that is cut off has what is left of its block, and fields that
are missing are null. `payload_bytes` is the length of a response's payload as it stands in the archive; of a revisit,
whose payload stands elsewhere, what its header says, if it does.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rinse.llm.components import join_hot
from rinse.llm.shared import store_of as _store
from rinse.llm.shared import written

_BREAK = b"\r\n\r\n"
_LEVEL = 4
#: Folder of the table of names; Spark does not take it for part of the archive.
_NAMES = "_names"
_FIELDS = {
    "warc-record-id": "record_id",
    "warc-type": "record_type",
    "warc-concurrent-to": "concurrent_to",
    "warc-target-uri": "target_uri",
    "warc-date": "date",
    "warc-payload-digest": "payload_digest",
    "warc-refers-to": "refers_to",
}
RECORDS = ", ".join(f"{name} string" for name in _FIELDS.values()) + (
    ", http_header string, payload binary, payload_bytes bigint, block string, computed_digest string"
)


def _record_id(kind: str, name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{kind} {name}')}>"


def _digest(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(head: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as a gzip member."""
    lines = [f"{name}: {value}" for name, value in [*head, ("Content-Length", str(len(block)))]]
    whole = "\r\n".join(["WARC/1.1", *lines]).encode() + _BREAK + block + _BREAK
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def _capture(page: int | None, url: str | None, html: str | None, kind: str, date: str) -> tuple[bytes, int]:
    """The response or revisit, the request and the metadata of one page, and how many records that are.

    `kind` is `only` (a response that nothing revisits), `kept` (a response that may be revisited) or `revisit`.
    """
    raw = (html or "").encode()
    digest = _digest(raw)
    own = _record_id("response", digest if kind == "kept" else uuid.uuid4().hex)
    uri = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url.strip()) if url and url.strip() else f"urn:page:{uuid.uuid4().hex}"
    try:
        place = urlsplit(uri)
        host, path = place.netloc, (place.path or "/") + (f"?{place.query}" if place.query else "")
    except ValueError:
        host, path = "", uri
    common = [("WARC-Target-URI", uri), ("WARC-Date", date)]
    about = [("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response")]
    header = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(raw)}".encode() + _BREAK
    if kind == "revisit":
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        refers = [("WARC-Refers-To", _record_id("response", digest)), ("WARC-Profile", profile)]
        main = _record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, *about, *refers], header)
    else:
        main = _record([("WARC-Type", "response"), ("WARC-Record-ID", own), *common, *about], header + raw)

    def other(name: str, mime: str, block: str) -> bytes:
        head = [("WARC-Type", name), ("WARC-Record-ID", _record_id(name, own)), *common, ("WARC-Concurrent-To", own), ("Content-Type", mime)]
        return _record(head, block.encode())

    request = other("request", "application/http; msgtype=request", f"GET {path} HTTP/1.1\r\nHost: {host}\r\n\r\n")
    fields = "" if page is None else f"page-id: {page}\r\n"
    return main + request + other("metadata", "application/warc-fields", fields), 3


def _with_kinds(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, url, html and kind of each page; no row number is needed, so rows may come from anywhere."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = rows.withColumn("key", F.when(F.length(payload) >= least_bytes, F.sha1(payload)))
    # Equal payloads shrink to one row for each page and task, and then to one, before they meet.
    same = rows.where("key is not null").groupBy("key", "page_id", "url").agg(F.count("*").alias("equal"))
    last = F.max(F.struct("page_id", "url", "equal")).alias("last")
    groups = same.groupBy("key").agg(last, F.sum("equal").alias("n")).where("n > 1")
    groups = written(groups.select("key", F.col("last.page_id").alias("last_page"), F.col("last.url").alias("last_url"), F.col("last.equal").alias("equal"), "n"), "warc-groups")
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    several = join_hot(rows.where("key is not null"), groups, "key", "n", total)
    is_last = F.col("page_id").eqNullSafe(F.col("last_page")) & F.col("url").eqNullSafe(F.col("last_url"))
    # Where several equal rows are the last, one of them is kept and the others revisit it.
    equal = several.where(is_last & (F.col("equal") > 1)).groupBy("key", "page_id", "url", "equal").agg(F.first("html").alias("html"))
    numbered = equal.withColumn("number", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("equal"))))
    one = numbered.withColumn("kind", F.when(F.col("number") == 1, "kept").otherwise("revisit"))
    rest = several.where(~is_last | (F.col("equal") == 1)).withColumn("kind", F.when(is_last, "kept").otherwise("revisit"))
    alone = rows.join(groups.select("key"), "key", "left_anti").withColumn("kind", F.lit("only"))
    names = ["page_id", "url", "html", "kind"]
    return alone.select(*names).unionByName(rest.select(*names)).unionByName(one.select(*names))


def write_archive(
    pages: DataFrame,
    folder: str,
    *,
    least_bytes: int = 0,
    date: str = "2000-01-01T00:00:00Z",
    records_per_file: int = 100_000,
    file_bytes: int = 32 << 20,
) -> None:
    """Writes the captures of `pages` (page_id, url, html). The folder is one that the workers can write to."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        out, name, size, count = None, "", 0, 0
        for batch in batches:
            for first in range(0, batch.num_rows, 100):
                part = batch.slice(first, 100)
                for row in zip(*[c.to_pylist() for c in part.columns]):
                    made, records = _capture(*row, date)
                    if out is not None and (size + len(made) > file_bytes or count + records > records_per_file):
                        out.close()
                        yield _named(name, count, size)
                        out = None
                    if out is None:
                        name, size, count = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = store.open_output_stream(f"{path}/{name}", compression=None)  # records are zipped already
                    out.write(made)
                    size, count = size + len(made), count + records
        if out is not None:
            out.close()
            yield _named(name, count, size)

    files = _with_kinds(pages, least_bytes).mapInArrow(write, "name string, records bigint, bytes bigint")
    files.write.parquet(f"{folder}/{_NAMES}")


def _named(name: str, count: int, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count]), pa.array([size])], names=["name", "records", "bytes"])


def _text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _fields(lines: list[str]) -> dict[str, str]:
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}


def _length(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.isdigit() else None


def _unzipped(content: bytes) -> bytes:
    """The content, unzipped if it is zipped; what is left of a member that is cut off is kept."""
    if content[:2] != b"\x1f\x8b":
        return content
    view, at, out = memoryview(content), 0, []
    while content[at : at + 2] == b"\x1f\x8b":
        # In small pieces, as what is left of a piece behind a member is copied.
        unpacker, piece = zlib.decompressobj(31), 2048
        while not unpacker.eof and at < len(content):
            out.append(unpacker.decompress(view[at : at + piece]))
            at += min(piece, len(content) - at)
            piece = 1 << 16
        at -= len(unpacker.unused_data)
    return b"".join(out)


def parse_records(content: bytes) -> Iterator[dict]:
    """The records of a WARC file, zipped or not. Lengths come from the headers, so payloads may hold anything."""
    content, at = _unzipped(content), 0
    while (at := _skip_breaks(content, at)) < len(content):
        head_end = content.find(_BREAK, at)
        head_end = len(content) if head_end < 0 else head_end
        lines = _text(content[at:head_end]).split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = _fields(lines[1:])
        start = head_end + len(_BREAK)
        length = _length(head.get("content-length"))
        if length is None:  # up to the next record
            following = content.find(_BREAK + b"WARC/", start)
            length = (len(content) if following < 0 else following) - start
        block = content[start : start + length]
        at = max(start, start + len(block))
        out = {column: head.get(name) for name, column in _FIELDS.items()}
        out |= {"http_header": None, "payload": None, "payload_bytes": None, "computed_digest": None, "block": None}
        if out["record_type"] in ("response", "revisit"):
            http, _, payload = block.partition(_BREAK)
            out["http_header"] = _text(http)
            if out["record_type"] == "response":
                out |= {"payload": payload, "payload_bytes": len(payload), "computed_digest": _digest(payload)}
            else:
                out["payload_bytes"] = _length(_fields(out["http_header"].split("\r\n")[1:]).get("content-length"))
        else:
            out["block"] = _text(block)
        yield out


def _skip_breaks(content: bytes, at: int) -> int:
    while content[at : at + 1] in (b"\r", b"\n"):
        at += 1
    return at


def _archives(spark: SparkSession, folder: str) -> DataFrame:
    """The files of the folder, as (content); of what write_archive wrote, those that count."""
    try:
        names = spark.read.parquet(f"{folder}/{_NAMES}")
    except AnalysisException:
        return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder).select("content")
    # As many names as Spark's own list of the files has.
    paths = [f"{folder}/{r.name}" for r in names.select("name").collect()]
    if not paths:
        return spark.createDataFrame([], "content binary")
    return spark.read.format("binaryFile").load(paths).select("content")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of all archives in the folder."""
    schema = pa.schema(
        [pa.field(name, pa.string()) for name in _FIELDS.values()]
        + [pa.field("http_header", pa.string()), pa.field("payload", pa.binary()), pa.field("payload_bytes", pa.int64())]
        + [pa.field("block", pa.string()), pa.field("computed_digest", pa.string())]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                found: list[dict] = []
                size = 0
                for record in parse_records(content.as_py()):
                    found.append(record)
                    size += len(record["payload"] or b"")
                    if len(found) == 500 or size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found, size = [], 0
                yield pa.RecordBatch.from_pylist(found, schema)

    return _archives(spark, folder).mapInArrow(parse, RECORDS)


_MAIN = ("record_id", "record_type", "target_uri", "date", "payload_digest", "computed_digest", "refers_to", "http_header", "payload", "payload_bytes")
_SIDE = ("record_id", "target_uri", "date", "block")


def captures(records: DataFrame, main: tuple[str, ...] = _MAIN, side: tuple[str, ...] = _SIDE) -> DataFrame:
    """One nested row per response or revisit: response, request, metadata (null where there is none).

    Records are read once and meet by the identifier of their response. `main` and `side` choose the fields.
    """
    is_main = F.col("record_type").isin("response", "revisit")
    transaction = F.when(is_main, F.col("record_id")).otherwise(F.col("concurrent_to"))
    wanted = records.where(is_main | F.col("record_type").isin("request", "metadata")).select(
        transaction.alias("transaction"),
        "record_type",
        F.when(is_main, F.struct(*main)).alias("main"),
        F.when(~is_main, F.struct(*side)).alias("side"),
    )
    met = wanted.where("transaction is not null").groupBy("transaction").agg(F.collect_list(F.struct("record_type", "main", "side")).alias("parts"))
    of = lambda kind: F.get(F.filter("parts", lambda x: x["record_type"] == kind), F.lit(0))["side"]
    response = F.explode(F.filter("parts", lambda x: x["main"].isNotNull()))
    return met.select(response.alias("found"), of("request").alias("request"), of("metadata").alias("metadata")).select(
        F.col("found.main").alias("response"), "request", "metadata"
    )


def page_captures(spark: SparkSession, folder: str) -> DataFrame:
    """Of each capture: page_id, payload_bytes, payload_digest, record_type, and the page_id that a revisit refers to."""
    narrow = ("record_id", "record_type", "payload_digest", "computed_digest", "refers_to", "payload_bytes")
    found = captures(read_records(spark, folder), narrow, ("block",))
    page = F.expr("try_cast(regexp_extract(metadata.block, 'page-id: (-?[0-9]+)', 1) as bigint)")
    digest = F.coalesce("response.computed_digest", "response.payload_digest")
    rows = found.select(
        page.alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.regexp_replace(digest, "^sha1:", "").alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        F.col("response.record_id").alias("record_id"),
        F.col("response.refers_to").alias("of"),
    )
    rows = written(rows, "warc-captures")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    nothing = F.lit(None).cast("bigint").alias("refers_to")
    revisits = rows.where("record_type = 'revisit' and of is not null")
    asked = revisits.groupBy("of").agg(F.count("*").alias("n"))
    kept = rows.where("record_type = 'response'").select(F.col("record_id").alias("of"), F.col("page_id").alias("refers_to"))
    referred = join_hot(revisits, asked.join(kept, "of", "left"), "of", "n", revisits.count())
    rest = rows.where("record_type = 'response' or of is null").select(*names, nothing)
    return rest.unionByName(referred.select(*names, "refers_to"))
