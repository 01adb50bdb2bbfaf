"""Interpolated modified Kneser-Ney bigram model: counted in Spark, stored as sorted hash arrays, memory-mapped for scoring.

    P(w|v) = (c(v w) - D(c(v w))) / c(v) + (D1 N1(v) + D2 N2(v) + D3 N3+(v)) / c(v) * P(w)
    P(w)   = (k(w) - D'(k(w))) / K + (D1' n1 + D2' n2 + D3' n3+) / K * 1 / (V + 1)

where k(w) is the number of different words before w, K their sum, N1(v) the number of different words that follow v
once, n1 that of words with k = 1, and each D comes from the numbers of counts of 1 to 4. After a word that is never
seen before another, P(w) stands for itself. The unknown word has the chance of 1 / (V + 1) alone.

Tokens are words (stretches without space or the characters 9 to 13, with A-Z as a-z) and one end for each text; null
texts have the end alone. Words are 64-bit hashes. Tasks count what they read into blobs of sorted distinct pairs, dealt
by hash to buckets; a bucket merges its blobs into one sorted array of pair hashes and counts, written as a file of
the model's folder. Pairs are dealt by their first word, so that its numbers are complete in one bucket; words that are
more than a 65536th of all tokens are dealt by the pair instead, and their numbers are added up. Scoring tasks map the
files and look up what each slice of texts needs, in order. A folder in a store that can't be mapped is copied file by
file to nameless temporary files.

The model is not pruned: it grows with the different pairs of the corpus, and no task or driver holds more than a bucket.
Order two is fixed: higher orders need continuation counts of pairs, a shuffle of all n-grams for each order more.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rinse.llm.bytewords import mix, span_hashes, spans, text_slices
from rinse.llm.shared import shared_folder, store_of as _store, tasks, written

_START, _END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_FLUSH = 4_000_000
_SLICE = 4 << 20
_HOT = 65536
_MAPPED = 4096
_TOTALS, _WORDS, _CONTEXTS, _BEFORE = -1, 0, 1, 2


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of these rows, each row ending with the end, and the number of tokens of each row."""
    starts, ends, first = spans(data, offsets)
    words = span_hashes(data, starts, ends)
    return np.insert(words, first[1:], _END), np.diff(first) + 1


def contexts(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The token before each, and the start before the first of a row."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.cumsum(counts) - counts] = _START
    return before


def pair_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + words)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Even stretches of the hashes, in order."""
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _pair_bucket(before: np.ndarray, keys: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    at = np.minimum(np.searchsorted(hot, before), max(len(hot) - 1, 0))
    is_hot = hot[at] == before if len(hot) else np.zeros(len(before), dtype=bool)
    return _bucket(np.where(is_hot, keys, mix(before)), buckets)


def _blob(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *[len(a) for a in arrays]], dtype="<i8")
    kinds = "".join(a.dtype.str.ljust(4) for a in arrays).encode()
    return head.tobytes() + kinds + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _arrays(blob) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, dtype="<i8", count=1)[0])
    sizes = np.frombuffer(blob, dtype="<i8", count=n, offset=8)
    at = 8 * (n + 1)
    kinds = [bytes(blob[at + 4 * k : at + 4 * k + 4]).decode().strip() for k in range(n)]
    at, out = at + 4 * n, []
    for size, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(blob, dtype=kind, count=size, offset=at))
        at += out[-1].nbytes
    return out


def _blobs(column: pa.ChunkedArray) -> Iterator[list[np.ndarray]]:
    for x in column:
        yield _arrays(x.as_buffer().to_pybytes())


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of each one's values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    sums = [np.add.reduceat(v[order].astype(np.int64), starts) if len(keys) else v.astype(np.int64) for v in values]
    return keys[starts], *sums


def _by_bucket(kind: int, buckets: int, keys: np.ndarray, *values: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Blobs of sorted keys, one for each bucket that has any."""
    cuts = np.searchsorted(_bucket(keys, buckets), np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        here = slice(cuts[b], cuts[b + 1])
        yield b, kind, _blob(keys[here], *[v[here] for v in values])


def _rows(found: list[tuple[int, int, bytes]]) -> pa.Table:
    buckets, kinds, blobs = zip(*found) if found else ((), (), ())
    return pa.table([pa.array(buckets, pa.int32()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "kind", "blob"])


_ROWS = "bucket int, kind int, blob binary"


def _write(folder: str, name: str, content: bytes) -> None:
    """Writes a file whole; a repeated task puts the same content in its place."""
    store, path = _store(folder)
    store.create_dir(path, recursive=True)
    own = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(content)
    store.move(own, f"{path}/{name}")


def _mapped(folder: str, name: str) -> list[np.ndarray]:
    """The arrays of a file of the model, mapped; none where there is no such file."""
    store, path = _store(folder)
    file = f"{path}/{name}"
    if store.get_file_info(file).type == fs.FileType.NotFound:
        return []
    if isinstance(store, fs.LocalFileSystem):
        return _arrays(np.memmap(file, dtype=np.uint8, mode="r").data)
    handle, local = tempfile.mkstemp()
    with os.fdopen(handle, "wb") as out, store.open_input_stream(file) as source:
        while part := source.read(1 << 24):
            out.write(part)
    arrays = _arrays(np.memmap(local, dtype=np.uint8, mode="r").data)
    os.unlink(local)
    return arrays


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """D1, D2 and D3+ from the numbers of counts of 1, 2, 3 and 4; a half for what these can't tell."""
    n1, n2, n3, n4 = counts
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.0
    found = [k - (k + 1) * y * more / n if n else 0.0 for k, n, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(d if 0 < d < k else 0.5 for k, d in enumerate(found, 1))


@dataclass(frozen=True)
class KneserNey:
    folder: str
    word_buckets: int
    pair_buckets: int
    hot: np.ndarray
    train_tokens: int
    vocabulary: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    #: number of different pairs, and the mass of the lower order that goes to the uniform distribution
    pairs: int
    uniform: float


def train(docs: DataFrame, *, text_column: str = "text", pairs_in_bucket: int = 1_000_000) -> KneserNey:
    """Counts all tokens and pairs of `docs` and writes the model to the shared folder."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_column).alias("text"))
    folder, word_buckets = shared_folder(spark, "kneser-ney"), tasks(spark)

    def flushed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Tokens and the tokens before them, many rows at a time."""
        words, before, n = [], [], 0
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column("text")):
                found, counts = tokens(data, offsets)
                words.append(found)
                before.append(contexts(found, counts))
                n += len(found)
                if n > _FLUSH:
                    yield np.concatenate(words), np.concatenate(before)
                    words, before, n = [], [], 0
        if n:
            yield np.concatenate(words), np.concatenate(before)

    def batches_of(found: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        part, size = [], 0
        for row in found:
            part.append(row)
            size += len(row[2])
            if size > 1 << 24:
                yield from _rows(part).to_batches()
                part, size = [], 0
        if part:
            yield from _rows(part).to_batches()

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _ in flushed(batches):
            keys, n = np.unique(words, return_counts=True)
            yield from batches_of(_by_bucket(_WORDS, word_buckets, keys, n.astype("<u4")))

    def merge_words(group: pa.Table) -> pa.Table:
        parts = list(_blobs(group.column("blob")))
        keys, n = _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        return _rows([(group.column("bucket")[0].as_py(), _WORDS, _blob(keys, n))])

    words = texts.mapInArrow(count_words, _ROWS).groupBy("bucket").applyInArrow(merge_words, _ROWS)
    words = written(words, "kneser-ney-words")

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n in _blobs(batch.column("blob")):
                yield pa.RecordBatch.from_pydict({"words": [len(keys)], "tokens": [int(n.sum())]})

    vocabulary, train_tokens = (x or 0 for x in words.mapInArrow(sizes, "words bigint, tokens bigint").agg(F.sum("words"), F.sum("tokens")).first())

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n in _blobs(batch.column("blob")):
                yield pa.RecordBatch.from_pydict({"word": keys[n > train_tokens / _HOT].astype(np.int64)})

    # At most 65536 words, as each is more than a 65536th of all tokens; the start may be one.
    hot = words.mapInArrow(frequent, "word bigint").toArrow().column("word").to_numpy().astype(np.int64).view(np.uint64)
    hot = np.sort(np.append(hot, _START))
    pair_buckets = max(word_buckets, train_tokens // pairs_in_bucket)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, before in flushed(batches):
            keys, first, n = np.unique(pair_keys(before, words), return_index=True, return_counts=True)
            before, words = before[first], words[first]
            bucket = _pair_bucket(before, keys, hot, pair_buckets)
            order = np.lexsort((before, bucket))
            before, words, n, bucket = before[order], words[order], n[order].astype("<u4"), bucket[order]
            cuts = np.searchsorted(bucket, np.arange(pair_buckets + 1))

            def blobs() -> Iterator[tuple[int, int, bytes]]:
                for b in np.flatnonzero(np.diff(cuts)).tolist():
                    here = slice(cuts[b], cuts[b + 1])
                    own = before[here]
                    starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                    lengths = np.diff(np.append(starts, len(own))).astype("<u4")
                    yield b, 0, _blob(own[starts], lengths, words[here], n[here])

            yield from batches_of(blobs())

    def merge_pairs(group: pa.Table) -> pa.Table:
        parts = list(_blobs(group.column("blob")))
        before = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
        words = np.concatenate([p[2] for p in parts])
        n = np.concatenate([p[3] for p in parts]).astype(np.int64)
        keys = pair_keys(before, words)
        order = np.argsort(keys, kind="stable")
        keys, before, words, n = keys[order], before[order], words[order], n[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, before, words, n = keys[starts], before[starts], words[starts], np.add.reduceat(n, starts)
        _write(folder, f"pairs-{group.column('bucket')[0].as_py():08d}", _blob(keys, n.astype("<u4") if n.max() < 1 << 32 else n))
        found = [(_TOTALS, _TOTALS, _blob(np.array([*[(n == k).sum() for k in (1, 2, 3, 4)], len(n)], dtype=np.int64)))]
        found += _by_bucket(_CONTEXTS, word_buckets, *_summed(before, n, n == 1, n == 2, n > 2))
        found += _by_bucket(_BEFORE, word_buckets, *_summed(words, np.ones(len(words), dtype="<u4")))
        return _rows(found)

    def merge_all(group: pa.Table) -> pa.Table:
        kinds = np.array(group.column("kind").to_pylist())
        parts = list(_blobs(group.column("blob")))
        bucket = group.column("bucket")[0].as_py()
        if bucket == _TOTALS:
            return _rows([(bucket, 1, _blob(np.sum([p[0] for p in parts], axis=0)))])
        of = lambda kind: [p for p, k in zip(parts, kinds) if k == kind]
        # Each kind's arrays after the key, side by side: count; total, N1, N2, N3 as a context; words before.
        table = []
        for kind, width, at in ((_WORDS, 1, 0), (_CONTEXTS, 4, 1), (_BEFORE, 1, 5)):
            for p in of(kind):
                block = np.zeros((6, len(p[0])), dtype=np.int64)
                block[at : at + width] = p[1:]
                table.append((p[0], block))
        keys, *values = _summed(np.concatenate([k for k, _ in table]), *np.concatenate([b for _, b in table], axis=1))
        _write(folder, f"words-{bucket:08d}", _blob(keys, *values))
        k = values[5]
        return _rows([(bucket, 2, _blob(np.array([*[(k == j).sum() for j in (1, 2, 3, 4)], (k > 2).sum()], dtype=np.int64)))])

    pairs = texts.mapInArrow(count_pairs, _ROWS).groupBy("bucket").applyInArrow(merge_pairs, _ROWS)
    merged = pairs.unionByName(words).groupBy("bucket").applyInArrow(merge_all, _ROWS)
    # A row of five numbers for each bucket.
    sums = {1: np.zeros(5, dtype=np.int64), 2: np.zeros(5, dtype=np.int64)}
    for row in merged.select("kind", "blob").toLocalIterator():
        sums[row.kind] = sums[row.kind] + _arrays(bytes(row.blob))[0]
    total, by_word = sums[1], sums[2]
    lower = discounts(by_word[:4].tolist())
    left = lower[0] * by_word[0] + lower[1] * by_word[1] + lower[2] * by_word[4]
    pairs_n = int(total[4])
    model = KneserNey(
        folder, word_buckets, pair_buckets, hot, train_tokens, vocabulary, discounts(total[:4].tolist()), lower, pairs_n,
        float(left / pairs_n) if pairs_n else 1.0,
    )
    _write(folder, "model.json", json.dumps({k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in vars(model).items()}).encode())
    return model


def load(folder: str) -> KneserNey:
    store, path = _store(folder)
    with store.open_input_stream(f"{path}/model.json") as source:
        found = json.loads(source.read())
    pairs = {k: tuple(found[k]) for k in ("pair_discounts", "word_discounts")}
    return KneserNey(**{**found, **pairs, "folder": folder, "hot": np.array(found["hot"], dtype=np.uint64)})


class Lookup:
    """The mapped files of a model."""

    def __init__(self, model: KneserNey) -> None:
        self.model = model
        self.files: dict[str, list[np.ndarray]] = {}

    def _file(self, name: str) -> list[np.ndarray]:
        """The arrays of a file; those that were used longest ago are let go, as a process has a bounded number of mappings."""
        arrays = self.files.pop(name) if name in self.files else _mapped(self.model.folder, name)
        self.files[name] = arrays
        if len(self.files) > _MAPPED:
            del self.files[next(iter(self.files))]
        return arrays

    def _found(self, kind: str, width: int, keys: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """The values of keys that are sorted within their buckets, which rise; 0 for what is not there."""
        out = np.zeros((width, len(keys)), dtype=np.int64)
        cuts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])).tolist() if len(keys) else []
        for low, high in zip(cuts, [*cuts[1:], len(keys)]):
            arrays = self._file(f"{kind}-{int(buckets[low]):08d}")
            if arrays and len(arrays[0]):
                at = np.minimum(np.searchsorted(arrays[0], keys[low:high]), len(arrays[0]) - 1)
                there = np.flatnonzero(arrays[0][at] == keys[low:high])
                for k in range(width):
                    out[k, low + there] = arrays[k + 1][at[there]]
        return out

    def words(self, keys: np.ndarray) -> np.ndarray:
        """count; total, N1, N2 and N3+ as a context; different words before. For sorted keys."""
        return self._found("words", 6, keys, _bucket(keys, self.model.word_buckets))

    def pairs(self, keys: np.ndarray, before: np.ndarray) -> np.ndarray:
        bucket = _pair_bucket(before, keys, self.model.hot, self.model.pair_buckets)
        order = np.lexsort((keys, bucket))
        out = np.empty(len(keys), dtype=np.int64)
        out[order] = self._found("pairs", 1, keys[order], bucket[order])[0]
        return out

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each row: tokens, known tokens, log10 under smoothed counts, log10 under the model."""
        m = self.model
        words, counts = tokens(data, offsets)
        before = contexts(words, counts)
        starts = np.cumsum(counts) - counts
        distinct, which = np.unique(np.append(words, _START), return_inverse=True)
        own = self.words(distinct)
        at = which[:-1]
        at_before = np.empty_like(at)
        at_before[1:] = at[:-1]
        at_before[starts] = which[-1]
        count = own[0][at]
        base = np.log10((count + 0.5) / (m.train_tokens + 0.5 * (m.vocabulary + 1)))
        keys, first, pair = np.unique(pair_keys(before, words), return_index=True, return_inverse=True)
        times = self.pairs(keys, before[first])[pair]
        single = _discounted(own[5], m.word_discounts) / max(m.pairs, 1) + m.uniform / (m.vocabulary + 1)
        _, total, n1, n2, n3, _ = own
        left = m.pair_discounts[0] * n1 + m.pair_discounts[1] * n2 + m.pair_discounts[2] * n3
        back = np.where(total > 0, left / np.maximum(total, 1), 1.0)
        chance = _discounted(times, m.pair_discounts) / np.maximum(total[at_before], 1) + back[at_before] * single[at]
        return (
            counts,
            np.add.reduceat((count > 0).astype(np.int64), starts),
            np.add.reduceat(base, starts),
            np.add.reduceat(np.log10(chance), starts),
        )


def _discounted(count: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(count - np.array([0.0, *by])[np.minimum(count, 3)], 0.0)


_LOOKUPS: dict[str, Lookup] = {}


def _lookup(model: KneserNey) -> Lookup:
    """A task's worker keeps the last model mapped."""
    if model.folder not in _LOOKUPS:
        _LOOKUPS.clear()
        _LOOKUPS[model.folder] = Lookup(model)
    return _LOOKUPS[model.folder]


def score(docs: DataFrame, model: KneserNey, *, into: str = "lm", text_column: str = "text") -> DataFrame:
    """The rows with a struct column `into`: n_tokens, n_known, base_score, score, perplexity (of a token)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(into) if into in docs.columns else docs
    kind = T.StructType.fromDDL("n_tokens bigint, n_known bigint, base_score double, score double, perplexity double")
    schema = T.StructType([*docs.schema.fields, T.StructField(into, kind)])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _lookup(shared.value)
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(batch.schema.get_field_index(text_column)), _SLICE):
                n, known, base, own = lookup.score(data, offsets)
                struct = pa.StructArray.from_arrays(
                    [pa.array(x) for x in (n, known, base, own, 10 ** (-own / n))],
                    names=["n_tokens", "n_known", "base_score", "score", "perplexity"],
                )
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*part.columns, struct], names=[*part.schema.names, into])

    return docs.mapInArrow(judge, schema)
