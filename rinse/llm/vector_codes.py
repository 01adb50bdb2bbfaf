"""Product quantisation of integer vectors, with exact nearest entries by slice-and-intersect bitmasks.

Each component becomes floor(scale * x), and each vector is cut into `parts` equal consecutive parts. The codebook of a
part position starts as that part of the vectors with the smallest vec_ids. In each round every part is assigned to the
nearest entry (squared Euclidean distance, ties to the lower index) and every entry becomes the componentwise
floor(sum / count) of its parts; entries without parts stay. Codes are the assignment to the final entries.

The nearest entry is searched by bitmasks. Along each dimension the entries' coordinates are sorted, and each place
of that order carries the mask of all entries before it. Two of them tell, by exclusive or, which entries lie in a
slice of the dimension. A first radius selects a slice in each dimension; the slices' masks, ANDed, name the entries in
the box around the part, and only those are measured. If the nearest of them lies within the radius, nothing outside
the box can be nearer or as near; else the box grows to its distance, or to twice the radius where it was empty.

Rounds are passes over the table without a shuffle of vectors: tasks add up the parts of each entry, and one row per
entry, component and 32-bit digit of its sum goes to the aggregation, so that sums are exact whatever their size. The
codebooks (at most 256 entries for each part) are the only thing that the driver or a closure holds.

Null vectors, empty ones and those with a null or non-finite component are left out. All others must have one length, a
multiple of `parts`, else a ValueError names it. Rows with equal vec_ids are rows of their own; where they count among
the first entries they stand in the order of their vectors. Null vec_ids come last there. Null labels are one label. An
empty table gives no codes. Other columns are ignored. A distance that does not fit a long is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinse.llm.components import join_hot
from rinse.llm.shared import written
from rinse.llm.vectors import as_long, finite, integers, matrix

_ROWS = 8192
_DIGIT = 32
#: Differences of integers below this, squared and added up over any part, fit 64 bits.
_NARROW = 1 << 24


class Slices:
    """The entries of one codebook, sorted by each dimension, with the masks of all entries before each place."""

    def __init__(self, entries: np.ndarray) -> None:
        count, width = entries.shape
        self.entries = entries
        bits = np.zeros((count, -(-count // 64)), dtype="<u8")
        bits[np.arange(count), np.arange(count) // 64] = np.uint64(1) << (np.arange(count) % 64).astype(np.uint64)
        order = np.argsort(entries, axis=0, kind="stable")
        self.coordinates = np.take_along_axis(entries, order, axis=0).T.copy()
        self.before = np.zeros((width, count + 1, bits.shape[1]), dtype="<u8")
        for j in range(width):
            np.bitwise_or.accumulate(bits[order[:, j]], axis=0, out=self.before[j, 1:])
        # Half the usual distance between neighbouring entries is a good first radius.
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        apart[apart == 0] = np.iinfo(np.int64).max
        nearest = apart.min(axis=1)
        nearest = nearest[nearest < np.iinfo(np.int64).max]
        self.radius = max(1, int(np.sqrt(np.median(nearest)) / 2)) if len(nearest) else 1

    def within(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """For each row the mask of the entries that differ by at most the radius in every dimension."""
        found = None
        for j, (coordinates, before) in enumerate(zip(self.coordinates, self.before)):
            low = np.searchsorted(coordinates, x[:, j] - radius, side="left")
            high = np.searchsorted(coordinates, x[:, j] + radius, side="right")
            part = before[high] ^ before[low]
            found = part if found is None else found & part
        return found

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each row, the lower index among equals."""
        best, far = np.zeros(len(x), dtype=np.int64), np.full(len(x), -1, dtype=np.int64)
        radius = np.full(len(x), self.radius, dtype=np.int64)
        todo = np.arange(len(x))
        while len(todo):
            masks = np.ascontiguousarray(self.within(x[todo], radius[todo]))
            row, entry = np.nonzero(np.unpackbits(masks.view(np.uint8).reshape(len(todo), -1), axis=1, bitorder="little"))
            if len(row):
                d = ((x[todo[row]] - self.entries[entry]) ** 2).sum(axis=1)
                first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                least = np.minimum.reduceat(d, first)
                ties = np.flatnonzero(d == np.repeat(least, np.diff(np.append(first, len(row)))))
                lowest = ties[np.append(True, row[ties[1:]] != row[ties[:-1]])]
                best[todo[row[first]]], far[todo[row[first]]] = entry[lowest], least
            reach, here = far[todo], radius[todo]
            grown = np.sqrt(np.maximum(reach, 0)).astype(np.int64)
            grown += grown * grown < reach
            radius[todo] = np.where(reach < 0, 2 * here, grown)
            todo = todo[(reach < 0) | (reach > here * here)]
        return best, far


@dataclass(frozen=True)
class Codebooks:
    #: by part, entry and position within the part
    entries: tuple[tuple[tuple[int, ...], ...], ...]
    scale: float

    def sha256(self) -> str:
        """Over all components as decimal numbers, joined by commas."""
        flat = [str(v) for book in self.entries for entry in book for v in entry]
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


class _Assigner:
    """Assigns vectors to the entries of all part positions."""

    def __init__(self, books: Codebooks) -> None:
        self.books = books
        self.width = len(books.entries[0][0])
        narrow = all(abs(v) < _NARROW for book in books.entries for entry in book for v in entry)
        self.slices = [Slices(np.array(book, dtype=np.int64)) for book in books.entries] if narrow else None

    def vectors(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray | list[list[int]], np.ndarray, list]]:
        """(first row, integer vectors, codes, errors) of some rows each; wide vectors come one by one as lists."""
        dim = self.width * len(self.books.entries)
        lengths = column.value_lengths().to_numpy()
        if (lengths != dim).any():
            raise ValueError(f"vectors of {int(lengths[lengths != dim][0])} and of {dim} components in one table")
        x = matrix(column, len(column))
        with np.errstate(over="ignore"):
            scaled = np.floor(x * self.books.scale)
        wide = (np.abs(scaled) >= _NARROW).any(axis=1) if self.slices else np.ones(len(x), dtype=bool)
        narrow = np.where(wide[:, None], 0, scaled).astype(np.int64)
        codes, errors = np.zeros((len(x), len(self.books.entries)), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
        for p, slices in enumerate(self.slices or []):
            codes[:, p], d = slices.nearest(narrow[:, p * self.width : (p + 1) * self.width])
            errors += d
        yield 0, narrow[~wide], codes[~wide], np.flatnonzero(~wide), errors[~wide].tolist()
        for k in np.flatnonzero(wide).tolist():
            whole = integers(x[k], self.books.scale)
            code, error = [], 0
            for p, book in enumerate(self.books.entries):
                part = whole[p * self.width : (p + 1) * self.width]
                d, index = min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))
                code.append(index)
                error += d
            yield k, [whole], np.array([code]), np.array([k]), [error]


def _sums(rows: DataFrame, books: Codebooks) -> DataFrame:
    """part, entry, position (-1: the number of parts), digit (of 32 bits), amount: the sums over all vectors."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = _Assigner(books)
        parts, entries, width = len(books.entries), len(books.entries[0]), assigner.width
        total = np.zeros((parts, entries, width + 1), dtype=object)
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                for _, vectors, codes, _, _ in assigner.vectors(batch.column("x").slice(first, _ROWS)):
                    kind = object if isinstance(vectors, list) else np.int64
                    vectors = np.array(vectors, dtype=kind).reshape(len(codes), parts, width)
                    for p in range(parts):
                        added = np.zeros((entries, width + 1), dtype=kind)
                        np.add.at(added[:, :width], codes[:, p], vectors[:, p])
                        np.add.at(added[:, width], codes[:, p], 1)
                        total[p] += added.astype(object)
        out = []
        for (p, e, j), amount in np.ndenumerate(total):
            digits, sign = abs(int(amount)), 1 if amount >= 0 else -1
            for digit in range(-(-digits.bit_length() // _DIGIT)):
                out.append((p, e, j if j < width else -1, digit, sign * (digits >> _DIGIT * digit & (1 << _DIGIT) - 1)))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        columns = zip(*out) if out else ([],) * 5
        arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=["part", "entry", "position", "digit", "amount"])

    sums = rows.select("x").mapInArrow(add_up, "part int, entry int, position int, digit int, amount bigint")
    return sums.groupBy("part", "entry", "position", "digit").agg(F.sum("amount").alias("amount"))


def _kept(vectors: DataFrame, *more: str) -> DataFrame:
    rows = vectors.where(finite(F.col("embedding")))
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), *more, F.col("embedding").cast("array<double>").alias("x"))


def learn_codebooks(
    vectors: DataFrame, *, parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0
) -> Codebooks | None:
    """Codebooks of all of `vectors` (vec_id, embedding); None where no vector takes part."""
    if not 1 <= entries <= 256:
        raise ValueError(f"{entries} entries: a code of two hex digits tells 1 to 256 apart")
    rows = _kept(vectors)
    seeds = [integers(np.array(r.x), scale) for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()]
    if not seeds:
        return None
    if len(seeds[0]) % parts or any(len(s) != len(seeds[0]) for s in seeds):
        raise ValueError(f"vectors of {sorted({len(s) for s in seeds})} components can't be cut into {parts} equal parts")
    width = len(seeds[0]) // parts
    books = Codebooks(tuple(tuple(tuple(s[p * width : (p + 1) * width]) for s in seeds) for p in range(parts)), float(scale))
    for _ in range(rounds):
        found: dict[tuple[int, int, int], int] = {}
        for r in _sums(rows, books).collect():
            place = (r.part, r.entry, r.position)
            found[place] = found.get(place, 0) + (r.amount << _DIGIT * r.digit)
        books = Codebooks(
            tuple(
                tuple(
                    tuple(found.get((p, e, j), 0) // found[p, e, -1] for j in range(width)) if (p, e, -1) in found else entry
                    for e, entry in enumerate(book)
                )
                for p, book in enumerate(books.entries)
            ),
            books.scale,
        )
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hex digits for each part) and error (squared distances over all parts) of each vector."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = _Assigner(books)
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                part = batch.slice(first, _ROWS)
                codes, errors = [""] * part.num_rows, [0] * part.num_rows
                for _, _, found, rows, d in assigner.vectors(part.column("x")):
                    for k, row, error in zip(rows.tolist(), found.astype(np.uint8), as_long(d, "squared distance")):
                        codes[k], errors[k] = row.tobytes().hex(), error
                arrays = [part.column("vec_id"), part.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "label", "code", "error"])

    rows = _kept(vectors, "label")
    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(code, f"vec_id bigint, label {kind}, code string, error bigint")


def vector_codes(vectors: DataFrame, **settings) -> tuple[DataFrame, str]:
    """vec_id, code, error and label_error (all errors under the same label) of `vectors` (vec_id, embedding, label), and
    the codebooks' checksum."""
    books = learn_codebooks(vectors, **settings)
    if books is None:
        empty = vectors.sparkSession.createDataFrame([], "vec_id bigint, code string, error bigint, label_error bigint")
        return empty, hashlib.sha256(b"").hexdigest()
    # Null labels share a key of their own.
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")).alias("key")
    coded = written(encode(vectors, books).select("vec_id", "code", "error", key), "vector-codes")
    totals = coded.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    rows = join_hot(coded, totals, "key", "n", coded.count())
    return rows.select("vec_id", "code", "error", "label_error"), books.sha256()
