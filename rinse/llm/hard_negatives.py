"""Hard negatives by L2AP-style threshold joins.

For an anchor, the positives are the first rows of its label by score (the inner product of integer vectors,
floor(scale * x)), ties to the smaller vec_id. Each positive opens a window of scores, from `low` to `high` hundredths
of its own, and the negatives are the first rows of other labels in that window. Both are windows to be filled: the
positives' window is open at both ends and asks for the anchor's label.

A window is filled by threshold joins. A join finds every row that scores at least its threshold, so a window that got
as many rows as it asks for has the right ones; the others are joined again under a lower threshold, the lower end of
the window at last. The first thresholds come from a pilot, a fixed number of rows chosen by a checksum of their
numbers: the best of the pilot's rows in the window first, and then the last that would fill it, which cannot fail.

A join deals rows to blocks of about `block` and anchors to blocks of `anchor_block`, and one row of work is a block of
each. There the dimensions are put in the order of their weight, and each row leaves its first dimensions out of the
inverted index as long as the product of the norms over them, its own and the largest of the anchors', stays below the
threshold: a row that shares only those can't reach it. Rows are sorted by what they leave out, so that the list of a
dimension is the front of the block. Partial scores are accumulated list by list, from the heaviest dimension down; what
a pair has, and the product of both norms over what remains, bounds its score, and pairs below the threshold go. Those
that stay get their exact score.

Rows with a null label, a null or empty vector, or a null or non-finite component take no part. Vectors are compared
with those of the same length. An anchor meets every row but its own; rows with a repeated vec_id are rows of their
own, in the order of their numbers. Null vec_ids are rows like others, last among ties, and no anchors. Anchors without
positives, and positives without negatives, give no rows. Other columns are ignored. Scores are exact whatever the
size of the components; one that is returned and does not fit a long is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rinse.llm.components import join_hot
from rinse.llm.shared import written
from rinse.llm.vectors import as_long, counted, ids_of, integers, matrix, numbered, packed, whole

_CHUNK = 16
_SLICE = 128
_PAIRS = 1 << 16
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1

FOUND = "anchor bigint, window int, row bigint, vec_id bigint, score bigint"


def _reach(q_norm: np.ndarray, x_norm: np.ndarray) -> np.ndarray:
    """What two vectors of these norms can score at most, and a little more for rounding of norms."""
    return q_norm * x_norm * (1 + 1e-9) + 1e-6


class Block:
    """Rows of a block, with the norms over their first dimensions."""

    def __init__(self, x: np.ndarray) -> None:
        self.heavy = np.argsort((x**2).sum(axis=0), kind="stable")
        self.x = x[:, self.heavy]
        self.norms = np.column_stack([np.zeros(len(x)), np.sqrt(np.cumsum(self.x**2, axis=1))])

    def left_out(self, q_norms: np.ndarray, least: float) -> np.ndarray:
        """How many of its first dimensions each row leaves out of the index, as no anchor can reach `least` by them."""
        return (_reach(q_norms.max(axis=0)[None, 1:], self.norms[:, 1:]) < least).sum(axis=1)

    def above(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs that score at least the anchor's `least`."""
        q = anchors[:, self.heavy]
        dim = q.shape[1]
        q_norms = np.column_stack([np.zeros(len(q)), np.sqrt(np.cumsum(q**2, axis=1))])
        left_out = self.left_out(q_norms, least.min())
        order = np.argsort(left_out, kind="stable")
        left_out, norms = left_out[order], self.norms[order]
        index = np.where(np.arange(dim)[None, :] >= left_out[:, None], self.x[order], 0)
        length = np.searchsorted(left_out, np.arange(dim), side="right")  # of each dimension's list
        sums = np.zeros((len(q), len(order)))
        for low in range((dim - 1) // _CHUNK * _CHUNK, -1, -_CHUNK):
            high = min(dim, low + _CHUNK)
            n = length[high - 1]
            sums[:, :n] += q[:, low:high] @ index[:n, low:high].T
            remaining = np.maximum(low, left_out)
            stays = sums + _reach(q_norms[:, remaining], norms[np.arange(len(order)), remaining][None, :]) >= least[:, None]
            if stays.sum() * 8 <= stays.size:
                break
        at, row = np.nonzero(stays)
        row = order[row]
        score = np.empty(len(at))
        for low in range(0, len(at), _PAIRS):
            part = slice(low, low + _PAIRS)
            score[part] = np.einsum("ij,ij->i", q[at[part]], self.x[row[part]])
        enough = score >= least[at]
        return at[enough], row[enough], score[enough]


def _windows(asked: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Which anchor each window belongs to, and the windows' fields."""
    lists = asked.field("windows")
    of = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    flat = lists.flatten()
    return of, {name: flat.field(name).to_numpy(zero_copy_only=False) for name in ("window", "same", "least", "high")}


def filled(
    members: pa.Array, asked: pa.Array, k: int, scale: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]]:
    """The first k rows of a block for each window of each anchor: anchor and window, row, vec_id, whether that is
    missing, score."""
    rows = members.field("row").to_numpy()
    ids, unnamed = ids_of(members.field("vec_id"))
    labels = np.array(members.field("label").to_pylist(), dtype=object).astype(str)
    raw = matrix(members.field("x"), len(rows))
    x, wide = whole(raw, scale)
    anchor_rows = asked.field("row").to_numpy()
    anchor_labels = np.array(asked.field("label").to_pylist(), dtype=object).astype(str)
    raw_anchors = matrix(asked.field("x"), len(anchor_rows))
    anchors, wide_anchors = whole(raw_anchors, scale)
    of, windows = _windows(asked)
    _, codes = np.unique(np.concatenate([labels, anchor_labels]), return_inverse=True)
    labels, anchor_labels = codes[: len(rows)], codes[len(rows) :]
    lowest = np.full(len(anchor_rows), _MOST, dtype=np.int64)
    np.minimum.at(lowest, of, windows["least"])

    def chosen(at: np.ndarray, row: np.ndarray, score: np.ndarray):
        """Of these pairs, the first k of each window; `at` numbers anchors."""
        other = rows[row] != anchor_rows[at]
        at, row, score = at[other], row[other], score[other]
        falling = -score if score.dtype != object else -np.unique(score, return_inverse=True)[1]
        place = np.lexsort((rows[row], ids[row], unnamed[row], falling, at))
        at, row, score = at[place], row[place], score[place]
        same = labels[row] == anchor_labels[at]
        turn = np.arange(len(of)) - np.searchsorted(of, of)  # the windows of an anchor one after the other
        for t in range(int(turn.max(initial=-1)) + 1):
            window = np.full(len(anchor_rows), -1)
            window[of[turn == t]] = np.flatnonzero(turn == t)
            w = window[at]
            least, most = windows["least"][w], windows["high"][w]
            inside = ((score >= least) | (least == _LEAST)) & ((score <= most) | (most == _MOST))  # open ends are open
            fits = np.flatnonzero((w >= 0) & (same == windows["same"][w]) & inside)
            mine = at[fits]
            start = np.searchsorted(mine, mine)  # pairs are in the order of their anchors
            fits = fits[np.arange(len(fits)) - start < k]
            yield anchor_rows[at[fits]], windows["window"][w[fits]], rows[row[fits]], ids[row[fits]], unnamed[row[fits]], score[fits]

    # Anchors of similar thresholds are joined together, so that much can be left out.
    narrow, block = np.flatnonzero(~wide), Block(x[~wide])
    order = np.argsort(-lowest, kind="stable")
    order = order[~wide_anchors[order]]
    for low in range(0, len(order), _SLICE):
        part = order[low : low + _SLICE]
        if len(narrow):
            at, row, score = block.above(anchors[part], lowest[part].astype(np.float64))
            for found in chosen(part[at], narrow[row], score.astype(np.int64)):
                yield *found[:5], found[5].tolist()
    # Wide vectors are compared by Python's integers.
    for kind, those in ((np.flatnonzero(~wide_anchors), np.flatnonzero(wide)), (np.flatnonzero(wide_anchors), np.arange(len(rows)))):
        exact = [integers(raw[r], scale) for r in those.tolist()] if len(kind) else []
        for a in kind.tolist() if exact else []:
            own = integers(raw_anchors[a], scale)
            score = np.array([sum(v * w for v, w in zip(own, other)) for other in exact] + [None], dtype=object)[:-1]
            for found in chosen(np.full(len(those), a), those, score):
                yield *found[:5], as_long(found[5].tolist(), "score")


def _join(blocks: DataFrame, anchors: DataFrame, windows: DataFrame, k: int, scale: float, name: str) -> DataFrame:
    """FOUND: for each window the first k rows of `blocks` (dim, block, members) that reach its threshold.

    `windows` has anchor, window, same, least (the threshold) and high; `anchors` row, vec_id, label, x, dim, asked.
    """
    grouped = windows.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("window", "same", "least", "high"))).alias("windows"))
    asked = anchors.join(grouped, F.col("row") == F.col("anchor"))
    asked = packed(asked, "asked", 2, "row", "label", "x", "windows").withColumnsRenamed({"block": "anchor_block", "members": "questions"})
    to_all = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    sizes = anchors.groupBy("dim").agg(F.first("asked").alias("asked")).join(
        blocks.groupBy("dim").agg((F.max("block") + 1).alias("n")), "dim"
    )
    asked = asked.join(sizes.select("dim", "n"), "dim").withColumn("block", to_all("n")).drop("n")
    work = blocks.join(sizes.select("dim", "asked"), "dim").withColumn("anchor_block", to_all("asked")).drop("asked")
    pairs = work.join(asked.hint("shuffle_hash"), ["dim", "block", "anchor_block"]).select("members", "questions")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members, questions in zip(batch.column("members"), batch.column("questions")):
                for anchor, window, row, vec_id, unnamed, score in filled(members.values, questions.values, k, scale):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), pa.array(window, pa.int32()), pa.array(row), pa.array(vec_id, mask=unnamed), pa.array(score, pa.int64())],
                        names=["anchor", "window", "row", "vec_id", "score"],
                    )

    found = pairs.mapInArrow(search, FOUND)
    by_score = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return written(ranked, name)


def _filled(blocks: DataFrame, pilot: DataFrame, anchors: DataFrame, windows: DataFrame, k: int, scale: float, name: str) -> DataFrame:
    """Fills `windows` (anchor, window, same, low, high): FOUND with rank, by joins under falling thresholds."""
    windows = windows.where("low <= high")
    seen = _join(pilot, anchors, windows.withColumn("least", F.col("low")), k, scale, f"{name}-pilot")
    tries = seen.groupBy("anchor", "window").agg(
        F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("try0"), F.max(F.when(F.col("rank") == k, F.col("score"))).alias("try1")
    )
    state = written(
        windows.join(tries, ["anchor", "window"], "left").select(
            "anchor", "window", "same", "low", "high", F.coalesce("try0", "low").alias("try0"), F.coalesce("try1", "low").alias("try1")
        ),
        f"{name}-state",
    )
    done = []
    for least in ("try0", "try1", "low"):
        found = _join(blocks, anchors, state.withColumn("least", F.col(least)), k, scale, f"{name}-found")
        counts = found.groupBy("anchor", "window").agg(F.count("*").alias("got"))
        state = state.join(counts, ["anchor", "window"], "left")
        # Full, or joined under the lowest threshold there is.
        full = (F.coalesce("got", F.lit(0)) == k) | (F.col(least) == F.col("low"))
        done.append(found.join(state.where(full).select("anchor", "window"), ["anchor", "window"], "left_semi"))
        state = written(state.where(~full).drop("got"), f"{name}-state")
        if state.isEmpty():
            break
    return reduce(DataFrame.unionByName, done)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    *,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: float = 256.0,
    block: int = 4096,
    anchor_block: int = 4096,
    pilot: int = 4096,
) -> DataFrame:
    """Hard negatives of each row of `vectors` (vec_id, label, embedding) for which `anchors`, a condition on vec_id, holds.

    anchor_id, positive_id, rank (of the negative, from 1), negative_id, positive_score, negative_score; a window holds
    the scores s with low * positive_score <= 100 * s <= high * positive_score.
    """
    label = F.col("label").cast("string").alias("label")
    rows = numbered(vectors.where("label is not null"), "negative-rows", label, anchors.alias("asks"))
    rows = counted(rows, n=(F.lit(True), block), asked=(F.col("asks"), anchor_block)).where("asked > 0")
    asking = written(rows.where("asks").drop("asks"), "negative-anchors")
    blocks = written(packed(rows, "n", 1, "row", "vec_id", "label", "x"), "negative-blocks")
    chosen = rows.orderBy(F.xxhash64("row", F.lit(5)), "row").limit(pilot)
    first = chosen.groupBy("dim").agg(F.collect_list(F.struct("row", "vec_id", "label", "x")).alias("members"))
    first = written(first.withColumn("block", F.lit(0).cast("bigint")), "negative-pilot")

    open_window = asking.select(
        F.col("row").alias("anchor"), F.lit(0).alias("window"), F.lit(True).alias("same"), F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high")
    )
    near = _filled(blocks, first, asking, open_window, positives, scale, "positives")
    # Hundredths of a long, rounded inwards, without leaving the longs.
    hundredth = F.expr("score div 100")
    rest = F.col("score") - hundredth * 100
    near = near.withColumns(
        {
            "low": hundredth * low + F.ceil(rest * low / F.lit(100)).cast("bigint"),
            "high": hundredth * high + F.floor(rest * high / F.lit(100)).cast("bigint"),
        }
    ).withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score", "rank": "place"})
    windows = near.select("anchor", F.col("place").cast("int").alias("window"), F.lit(False).alias("same"), "low", "high")
    found = _filled(blocks, first, asking, windows, negatives, scale, "negatives")
    named = asking.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    pairs = near.select("anchor", F.col("place").cast("int").alias("window"), "positive_id", "positive_score").join(named, "anchor")
    return found.join(pairs, ["anchor", "window"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
