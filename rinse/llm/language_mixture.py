"""Language identification by multilingual mixture inference.

Each language has a distribution over hashed byte trigrams of its words, counted in Spark over all labelled rows.
A document is a mixture of languages: expectation-maximisation finds the proportions under which its words are
most likely, where the likelihood of a word in a language is the product of those of its trigrams. Which
languages the document holds is chosen by penalised likelihood: a larger set must raise the log-likelihood by half
a logarithm of the number of words for each language more, times `penalty`.

Words are runs of letters, where A-Z count as a-z and every byte over 127 as a letter. Null texts, and texts without
a letter, are `und` with score 0, no languages and `fits` false. `fits` also tells whether the words are likelier
under the mixture than under trigrams drawn at random; it is false for noise. Repeated rows are counted and predicted
each by itself; with ties in proportion the language that sorts first wins; without labelled rows all is `und`.

The model that goes to the tasks holds `2**BITS` numbers for each language, however many documents there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rinse.llm.bytewords import mix, span_hashes, text_slices

BITS = 16
UNKNOWN = "und"
_SIZE = 1 << BITS
_ALPHABET = np.zeros(256, dtype=np.uint8)
_ALPHABET[97:123] = _ALPHABET[65:91] = np.arange(1, 27)
_ALPHABET[128:] = np.arange(27, 155)
_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_likelihood: np.ndarray  # trigrams x languages


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions of letters, the trigram around each, and starts and ends of words; no trigram leaves its row."""
    # A gap after each row keeps rows apart.
    rows = len(offsets) - 1
    codes = np.zeros(len(data) + rows + 1, dtype=np.uint8)
    place = np.arange(len(data)) + np.repeat(np.arange(1, rows + 1), np.diff(offsets))
    codes[place] = _ALPHABET[data]
    letter = codes > 0
    at = np.flatnonzero(letter)
    wide = codes.astype(np.uint32)
    gram = (wide[at - 1] * 155 + wide[at]) * 155 + wide[at + 1]
    gram = ((gram.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)
    starts = np.flatnonzero(letter[at] & ~letter[at - 1])
    row = np.searchsorted(offsets[:-1] + np.arange(1, rows + 1), at, side="right") - 1
    return at, gram, starts, row


def learn_languages(
    docs: DataFrame, *, text_column: str = "text", lang_column: str = "lang", smoothing: float = 0.05
) -> LanguageModel:
    """Counts trigrams over every row that has a text and a language."""
    labelled = docs.select(F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang"))
    labelled = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            known = batch.column("lang").dictionary_encode()
            names, which = known.dictionary.to_pylist(), known.indices.to_numpy()
            for first, end, data, offsets in text_slices(batch.column("text")):
                _, gram, _, row = _trigrams(data, offsets)
                own = which[first:end][row]
                for k in np.unique(own).tolist():
                    sums = totals.setdefault(names[k], np.zeros(_SIZE, dtype=np.int64))
                    sums += np.bincount(gram[own == k], minlength=_SIZE)
        for name, sums in totals.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(sums[at])], names=["lang", "gram", "n"]
            )

    def pack(group: pa.Table) -> pa.Table:
        sums = np.zeros(_SIZE, dtype="<i8")
        sums[group.column("gram").to_numpy()] = group.column("n").to_numpy()
        return pa.table({"lang": group.column("lang").slice(0, 1), "sums": pa.array([sums.tobytes()], type=pa.binary())})

    counts = labelled.mapInArrow(count, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    packed = counts.groupBy("lang").applyInArrow(pack, "lang string, sums binary").collect()  # one row per language
    packed.sort(key=lambda x: x.lang)
    if not packed:
        return LanguageModel((), np.zeros((_SIZE, 0), dtype=np.float32))
    sums = np.stack([np.frombuffer(x.sums, dtype="<i8") for x in packed], axis=1).astype(np.float64)
    table = np.log((sums + smoothing) / (sums.sum(axis=0) + smoothing * _SIZE))
    return LanguageModel(tuple(x.lang for x in packed), np.ascontiguousarray(table, dtype=np.float32))


def mixture(
    weights: np.ndarray, chances: np.ndarray, row: np.ndarray, starts: np.ndarray, rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each document by expectation-maximisation.

    `chances` are words x languages, `row` the document of each word, `starts` the first word of each document.
    """
    total = np.add.reduceat(weights, starts)
    share = np.full((len(starts), chances.shape[1]), 1 / chances.shape[1])
    for _ in range(rounds):
        part = chances * share[row]
        part *= (weights / np.maximum(part.sum(axis=1), 1e-300))[:, None]
        share = np.add.reduceat(part, starts) / total[:, None]
    fit = np.log(np.maximum((chances * share[row]).sum(axis=1), 1e-300))
    return share, np.add.reduceat(weights * fit, starts)


def _infer(model: LanguageModel, data: np.ndarray, offsets: np.ndarray, most: int | None, rounds: int, penalty: float):
    """For each row of text: proportions (rows x languages), and whether they fit better than noise."""
    rows, n_lang = len(offsets) - 1, len(model.languages)
    shares, fits = np.zeros((rows, n_lang)), np.zeros(rows, dtype=bool)
    at, gram, first, row = _trigrams(data, offsets)
    if not len(at) or not n_lang:
        return shares, fits
    sums = np.add.reduceat(model.log_likelihood[gram], first, axis=0).astype(np.float64)
    length = np.diff(np.append(first, len(at)))
    word_row = row[first]
    # Equal words of a document are one row with a weight.
    begin = at[first] - word_row - 1
    key = span_hashes(data, begin, begin + length)
    _, one, weights = np.unique(mix(key ^ mix(word_row.astype(np.uint64))), return_index=True, return_counts=True)
    order = np.argsort(word_row[one], kind="stable")
    one, weights = one[order], weights[order].astype(np.float64)
    sums, length, word_row = sums[one], length[one], word_row[one]
    there, starts = np.unique(word_row, return_index=True)
    doc = np.repeat(np.arange(len(there)), np.diff(np.append(starts, len(word_row))))
    top = sums.max(axis=1)
    chances = np.exp(sums - top[:, None])
    base = np.add.reduceat(weights * top, starts)
    noise = np.add.reduceat(weights * length, starts) * -np.log(_SIZE)
    cost = penalty * np.log(np.add.reduceat(weights, starts) + 1) / 2

    alone = np.add.reduceat(weights[:, None] * (sums - top[:, None]), starts)
    best = alone.max(axis=1)
    chosen = np.zeros((len(there), n_lang))
    chosen[np.arange(len(there)), alone.argmax(axis=1)] = 1
    if n_lang > 1:
        full, bound = mixture(weights, chances, doc, starts, rounds)
        rank = np.argsort(-full, axis=1, kind="stable")
        for size in range(2, (n_lang if most is None else min(most, n_lang)) + 1):
            # No set of this size or more can win where the best fit of all languages does not pay for it.
            open_docs = np.flatnonzero(bound - cost * (size - 1) > best)
            if not len(open_docs):
                break
            words = np.isin(doc, open_docs)
            sub = np.searchsorted(open_docs, doc[words])
            sub_starts = np.searchsorted(sub, np.arange(len(open_docs)))
            picked = rank[open_docs, :size]
            share, fit = mixture(weights[words], np.take_along_axis(chances[words], picked[sub], axis=1), sub, sub_starts, rounds)
            won = fit - cost[open_docs] * (size - 1) > best[open_docs]
            winners = open_docs[won]
            best[winners] = (fit - cost[open_docs] * (size - 1))[won]
            chosen[winners] = 0
            chosen[winners[:, None], picked[won]] = share[won]
    shares[there] = chosen
    fits[there] = base + best > noise
    return shares, fits


def predict_languages(
    docs: DataFrame,
    model: LanguageModel,
    *,
    into: str = "language",
    text_column: str = "text",
    most_languages: int | None = None,
    rounds: int = 15,
    penalty: float = 3.0,
) -> DataFrame:
    """The rows with a struct column `into`: pred, score (the proportion of pred), fits, and languages with their shares.

    All columns are kept; a column called `into` would be replaced. A document may mix all learned languages, or at most
    `most_languages` where that is given.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kind = T.StructType.fromDDL(
        "pred string, score double, fits boolean, languages array<struct<lang: string, share: double>>"
    )
    docs = docs.drop(into) if into in docs.columns else docs
    schema = T.StructType([*docs.schema.fields, T.StructField(into, kind)])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        slice_bytes = max(1 << 16, (1 << 22) // max(1, len(model.languages)))
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(text_column))
            for first, end, data, offsets in text_slices(text, slice_bytes):
                shares, fits = _infer(model, data, offsets, most_languages, rounds, penalty)
                raw = data.tobytes()
                places = zip(offsets[:-1].tolist(), offsets[1:].tolist())
                spoken = np.array([bool(_LETTER.search(raw[a:b].decode())) for a, b in places], dtype=bool)
                any_share = shares.max(axis=1, initial=0) > 0
                known = spoken & any_share
                shares[~known] = 0
                pred = np.where(known, shares.argmax(axis=1) if shares.shape[1] else 0, len(names) - 1)
                in_row, which = np.nonzero(shares)
                found = pa.StructArray.from_arrays(
                    [pa.array(names[which].tolist(), pa.string()), pa.array(shares[in_row, which])], names=["lang", "share"]
                )
                each = np.bincount(in_row, minlength=end - first)
                struct = pa.StructArray.from_arrays(
                    [
                        pa.array(names[pred].tolist(), pa.string()),
                        pa.array(np.minimum(shares.max(axis=1, initial=0), 1.0)),
                        pa.array(fits & known),
                        pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(each)).astype(np.int32)), found),
                    ],
                    names=["pred", "score", "fits", "languages"],
                )
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*part.columns, struct], names=[*part.schema.names, into])

    return docs.mapInArrow(predict, schema)
