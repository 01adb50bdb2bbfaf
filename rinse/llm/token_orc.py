"""Token-ID output: ORC stripes of run-length encoded ids, in ascending document order.

A table folder holds ORC files with the columns

    doc_id bigint, part int, start bigint, n_tokens int, ids array<int>

`part` numbers the files in document order and `start` counts the ids that stand before the document in its
part, so that a task that reads any stripe knows where its ids stand. ORC encodes the integers by runs and keeps
a row index and Bloom filters of doc_id for each group of rows; as the rows are sorted, a search for one document
skips nearly all files, stripes and groups by their statistics.

Texts are encoded as the tokenizer does by default, with nothing put around them: the string of an added token, such
as `<|endoftext|>`, becomes that token's id. Null and empty texts are documents of the end id alone. Null doc_ids stand first. Repeated doc_ids are kept, and
stand next to each other in the order of their texts. Ids need not fit 31 bits to be kept: they are stored as they
are, as 32-bit patterns.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rinse.llm.bytewords import eights, lists, mix, text_slices
from rinse.llm.shared import smaller_batches, tasks, written

STORED = "doc_id bigint, part int, start bigint, n_tokens int, ids array<int>"

# Classes of bytes. Letters of two bytes are recognised below; any other byte over 127 is FOREIGN.
_LETTER, _DIGIT, _MARK, _SPACE, _BREAK, _FOREIGN = range(1, 7)
_CLASS = np.full(256, _MARK, dtype=np.uint8)
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[32] = _SPACE
_CLASS[9:14] = _BREAK
_CLASS[128:] = _FOREIGN
_QUOTE = 39
#: A unit takes about 50 bytes, and workers live on between tasks.
_REMEMBERED = 1 << 19
_SHORT = 15
_FRONT = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where a unit begins, which rows hold characters this can't judge).

    A unit is a stretch of text that byte-level BPE with the usual splitting rule never joins with its neighbours:
    a word, number or run of marks with at most one space before it, or white space that belongs to no word.
    """
    n = len(data)
    kind = _CLASS[data]
    high = np.flatnonzero(kind == _FOREIGN)
    foreign = np.zeros(len(offsets) - 1, dtype=bool)
    if len(high):
        lead = high[(data[high] >= 0xC3) & (data[high] <= 0xC9)]
        follow = data[lead + 1]
        lead = lead[~((data[lead] == 0xC3) & ((follow == 0x97) | (follow == 0xB7)))]  # signs of multiplication and division
        kind[lead] = kind[lead + 1] = _LETTER
        rest = np.flatnonzero(kind == _FOREIGN)
        foreign[np.searchsorted(offsets, rest, side="right") - 1] = True
    begin = np.zeros(n + 1, dtype=bool)
    begin[offsets] = True
    blank = (kind == _SPACE) | (kind == _BREAK)
    before, here = kind[:-1], kind[1:]
    blank_before, blank_here = blank[:-1], blank[1:]
    starts = np.zeros(n, dtype=bool)
    starts[1:] = (
        (~blank_here & ~blank_before & (before != here) & ~((data[:-1] == _QUOTE) & (here == _LETTER)))
        | (~blank_here & (before == _BREAK))
        | (blank_here & ~blank_before)
    )
    word_next = np.zeros(n, dtype=bool)
    word_next[:-1] = ~blank_here & ~begin[1:-1]
    starts[1:] |= blank_here & blank_before & word_next[1:]
    starts |= begin[:-1]
    return starts, foreign


class Encoder:
    """Encodes texts with a tokenizer of the tokenizers library, and remembers the ids of units of up to 15 bytes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Their strings in a text become their single ids, as the tokenizer does by default.
        self.added = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        rules = json.loads(self.tokenizer.to_str())
        split = rules["pre_tokenizer"] or {}
        self.by_units = (
            rules["normalizer"] is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split["add_prefix_space"]
        )
        self.forget()

    def forget(self) -> None:
        # Each remembered unit by a key, its bytes and length as two integers, and where its ids stand.
        self.keys, self.front, self.back = (np.zeros(0, np.uint64) for _ in range(3))
        self.at, self.n = np.zeros(0, np.int32), np.zeros(0, np.int8)
        self.ids = np.zeros(0, np.int32)
        self.again = np.zeros(0, bool)  # which have been looked up after they were learned

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _with_added(self, raw: bytes, offsets: np.ndarray) -> set[int]:
        """Rows that hold the string of an added token; also rows whose end makes one with the next row."""
        rows = set()
        for content in self.added:
            at = raw.find(content)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, side="right")) - 1
                rows.add(row)
                at = raw.find(content, int(offsets[row + 1]))
        return rows

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of these rows, and how many each row has."""
        rows = len(offsets) - 1
        raw = data.tobytes()
        if not self.by_units:
            found = self._whole([raw[offsets[i] : offsets[i + 1]].decode() for i in range(rows)])
            flat = np.array([i for ids in found for i in ids], dtype=np.int64).astype(np.int32)
            return flat, np.array([len(ids) for ids in found], dtype=np.int64)
        starts, foreign = unit_starts(data, offsets)
        foreign[list(self._with_added(raw, offsets))] = True
        for row in np.flatnonzero(foreign):  # such a row is one unit
            starts[offsets[row] : offsets[row + 1]] = False
            starts[offsets[row]] = True
        starts = np.flatnonzero(starts)
        ends = np.append(starts[1:], len(data))
        length = ends - starts
        short = np.flatnonzero(length <= _SHORT)
        counts, first_id = np.zeros(len(starts), dtype=np.int64), np.zeros(len(starts), dtype=np.int64)
        at = self._remembered(data, raw, starts[short], ends[short])
        if at is None:
            own = np.arange(len(starts))
        else:
            counts[short], first_id[short] = self.n[at], self.at[at]
            own = np.flatnonzero(length > _SHORT)
        # Long units, once each.
        pieces = [raw[s:e] for s, e in zip(starts[own].tolist(), ends[own].tolist())]
        different = list(dict.fromkeys(pieces))
        found = self._whole([x.decode() for x in different])
        sizes = np.array([len(x) for x in found], dtype=np.int64)
        place = {piece: k for k, piece in enumerate(different)}
        which = np.array([place[piece] for piece in pieces], dtype=np.int64)
        more = np.fromiter((i for ids in found for i in ids), dtype=np.int64, count=int(sizes.sum())).astype(np.int32)
        if len(own):
            counts[own], first_id[own] = sizes[which], (np.cumsum(sizes) - sizes)[which]
        first = np.zeros(len(starts) + 1, dtype=np.int64)
        np.cumsum(counts, out=first[1:])
        ids_at = np.repeat(first_id - first[:-1], counts) + np.arange(first[-1])
        of_own = np.zeros(len(starts), dtype=bool)
        of_own[own] = True
        of_own = np.repeat(of_own, counts)
        flat = np.empty(len(ids_at), dtype=np.int32)
        flat[~of_own], flat[of_own] = self.ids[ids_at[~of_own]], more[ids_at[of_own]]
        unit_of = np.searchsorted(starts, offsets)
        return flat, np.diff(first[unit_of])

    def _remembered(self, data: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        """Where the memory has these short units, which it learns if need be.

        Units are looked up by a key and compared byte by byte; None where two of them share a key.
        """
        length, words = ends - starts, eights(data)
        front = words[starts] & _FRONT[np.minimum(length, 8)]
        back = words[np.minimum(starts + 8, len(data))] & _FRONT[np.maximum(length - 8, 0)] | length.astype(np.uint64) << np.uint64(56)
        keys = mix(front ^ mix(back))
        distinct, sample, which = np.unique(keys, return_index=True, return_inverse=True)
        if (front != front[sample][which]).any() or (back != back[sample][which]).any():
            return None
        at, known = self._find(distinct)
        if not known.all():
            new = sample[~known]
            self._learn(raw, distinct[~known], front[new], back[new], starts[new], ends[new])
            at, _ = self._find(distinct)
        if (self.front[at] != front[sample]).any() or (self.back[at] != back[sample]).any():
            return None
        self.again[at[known]] = True
        return at[which]

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        inside = np.minimum(at, max(len(self.keys) - 1, 0))
        known = self.keys[inside] == keys if len(self.keys) else np.zeros(len(keys), dtype=bool)
        return inside, known

    def _learn(self, raw: bytes, keys: np.ndarray, front: np.ndarray, back: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        texts = [raw[s:e].decode() for s, e in zip(starts.tolist(), ends.tolist())]
        found = self._whole(texts)
        n = np.array([len(x) for x in found], dtype=np.int64)
        at = len(self.ids) + np.cumsum(n) - n
        new = np.fromiter((i for ids in found for i in ids), dtype=np.int64, count=int(n.sum())).astype(np.int32)
        self.ids = np.concatenate([self.ids, new])
        place = np.searchsorted(self.keys, keys)
        for name, x in (("keys", keys), ("front", front), ("back", back), ("at", at), ("n", n), ("again", False)):
            setattr(self, name, np.insert(getattr(self, name), place, x))

    def tidy(self) -> None:
        """Keeps the memory bounded; called between slices. Units that were met in one slice alone go first."""
        if len(self.keys) <= _REMEMBERED:
            return
        kept = self.again
        if kept.sum() > _REMEMBERED // 2:
            self.forget()
            return
        n = self.n[kept].astype(np.int64)
        first = np.cumsum(n) - n
        self.ids = self.ids[np.repeat(self.at[kept] - first, n) + np.arange(int(n.sum()))]
        self.keys, self.front, self.back, self.n = (x[kept] for x in (self.keys, self.front, self.back, self.n))
        self.at, self.again = first.astype(np.int32), np.zeros(len(n), bool)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    *,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    parts: int | None = None,
    index_stride: int = 1000,
    bloom_fpp: float = 0.01,
    codec: str = "zstd",
) -> None:
    """Encodes every whole text and writes the ids with `end_id` after each document."""
    spark = docs.sparkSession
    parts = parts or tasks(spark)
    picked = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    ordered = picked.repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, start = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text")):
                flat, counts = encoder.encode(data, offsets)
                ends = np.cumsum(counts)
                flat = np.insert(flat, ends, np.array(end_id, dtype=np.int64).astype(np.int32))
                counts = counts + 1
                starts = start + np.cumsum(counts) - counts
                start += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, end - first),
                        pa.array(np.full(end - first, part, dtype=np.int32)),
                        pa.array(starts),
                        pa.array(counts.astype(np.int32)),
                        lists(flat, counts, pa.int32()),
                    ],
                    names=["doc_id", "part", "start", "n_tokens", "ids"],
                )
                encoder.tidy()

    with smaller_batches(spark):
        (
            ordered.mapInArrow(encode, STORED)
            .write.option("orc.compress", codec.upper())
            .option("orc.bloom.filter.columns", "doc_id")
            .option("orc.bloom.filter.fpp", str(bloom_fpp))
            .option("orc.row.index.stride", str(index_stride))
            .option("orc.encoding.strategy", "COMPRESSION")
            .orc(folder)
        )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a token folder; filters on doc_id reach the files' statistics and Bloom filters."""
    return spark.read.schema(STORED).orc(folder)


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """One row per stored document, computed from the ids in the files.

    doc_id, start (ids of all documents before it, over all parts), n_tokens, ids_crc32 (unsigned, over the ids as
    little-endian unsigned 32-bit integers), part.
    """
    stored = read_tokens(spark, folder)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            ends = ids.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), dtype="<i4")).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("part"),
                    batch.column("start"),
                    pa.array(np.diff(ends).astype(np.int64)),
                    pa.array(sums, type=pa.int64()),
                ],
                names=["doc_id", "part", "start", "n_tokens", "ids_crc32"],
            )

    rows = stored.select("doc_id", "part", "start", "ids").mapInArrow(
        measure, "doc_id bigint, part int, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
    with smaller_batches(spark):
        rows = written(rows, "token-index")
    # One row per file: its ids, and those of the files before it.
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    places = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(places, "part").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "part"
    )
