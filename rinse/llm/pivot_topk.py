"""Exact top-k search by inner product with a pivot table.

Vectors become integers, floor(scale * x). One more coordinate makes all candidates equally long, so that the largest
inner product is the nearest neighbour: d(q, x)**2 = |q|**2 + M - 2 q.x for candidates of squared length M. For every
candidate the distances to `pivots` vectors are stored. By the triangle inequality each pivot bounds a distance from
below, |d(q, p) - d(x, p)| <= d(q, x); the largest of the bounds gives an upper bound of the score. Candidates are
evaluated in the order of their bounds until the next bound is below the k-th best score so far.

Candidates are packed into blocks of `block` vectors, whose pivots and distances are computed once and stored with them
in a table. Queries are packed into blocks of `query_block`; each pair of blocks is one row of work, and the best k of
each query are merged by rank. What is dealt to the tasks is bounded by the size of two blocks, whatever the number
of vectors. A first pass compares the queries with a pilot, `pilot` rows chosen by a checksum of their numbers: as the
k-th best of these is no better than the k-th best of all, a block is left at its first candidate whose bound is below it.

Null vectors, empty ones and those with a null or non-finite component take no part. Vectors are compared with those of
the same length. A query meets every row but its own; rows with a repeated vec_id are rows of their own. Ties go to the
smaller vec_id, null last. Null vec_ids are candidates and no queries. Scores are exact whatever the size of the
components: vectors whose products doubles don't add exactly are compared by Python's integers, and a score among the
best that does not fit a long is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rinse.llm.shared import written
from rinse.llm.vectors import as_long, counted, ids_of, integers, matrix, numbered, packed, whole


def pivot_table(x: np.ndarray, pivots: int) -> tuple[np.ndarray, np.ndarray]:
    """The pivots, with their coordinate that makes all vectors equally long, and the distances of all vectors to each."""
    squares = np.einsum("ij,ij->i", x, x)
    # Pivots are spread over the block: each next one is the farthest from those before.
    space = np.column_stack([x, np.sqrt(squares.max() - squares)])
    chosen, near = [int(squares.argmax())], None
    table = []
    for _ in range(min(pivots, len(x))):
        d = np.sqrt(np.maximum(((space - space[chosen[-1]]) ** 2).sum(axis=1), 0))
        table.append(d)
        near = d if near is None else np.minimum(near, d)
        chosen.append(int(near.argmax()))
    return space[chosen[: len(table)]], np.stack(table)


def best_of_block(
    queries: np.ndarray,
    query_rows: np.ndarray,
    x: np.ndarray,
    rows: np.ndarray,
    ids: np.ndarray,
    k: int,
    pivots: int,
    step: int,
    stored: tuple[np.ndarray, np.ndarray] | None = None,
    start: np.ndarray | None = None,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: its number, the places of its best k candidates of the block, and their scores.

    `stored` is the block's pivot table, `start` a score for each query below which nothing is wanted.
    """
    longest = np.einsum("ij,ij->i", x, x).max()
    pivot, table = stored if stored is not None else pivot_table(np.asarray(x), pivots)
    own = np.einsum("ij,ij->i", queries, queries)
    to_pivot = np.sqrt(np.maximum(own[:, None] + (pivot**2).sum(axis=1)[None, :] - 2 * queries @ pivot[:, :-1].T, 0))
    for q in range(len(queries)):
        below = np.abs(table - to_pivot[q][:, None]).max(axis=0)
        # A little above the bound, for rounding of distances.
        above = (own[q] + longest - below**2) / 2 + 1e-6 * (own[q] + longest + 1)
        order = np.argsort(-above)
        found, scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), -np.inf if start is None else start[q]
        for low in range(0, len(order), step):
            if above[order[low]] < least:
                break
            part = order[low : low + step]
            part = part[rows[part] != query_rows[q]]
            found = np.concatenate([found, part])
            scores = np.concatenate([scores, (x[part] @ queries[q]).astype(np.int64)])
            best = np.lexsort((rows[found], ids[found], -scores))[:k]
            found, scores = found[best], scores[best]
            least = max(least, scores[-1]) if len(scores) == k else least
        yield q, found, scores


def _exact(
    query: list[int], query_row: int, vectors: list[list[int]], at: list[int], rows: np.ndarray, ids: np.ndarray, k: int
) -> list[tuple[int, int]]:
    """The best k (score, place) of these vectors by Python's integers."""
    scored = [(sum(a * b for a, b in zip(query, v)), place) for v, place in zip(vectors, at) if rows[place] != query_row]
    return sorted(scored, key=lambda s: (-s[0], ids[s[1]], rows[s[1]]))[:k]


def _arrays(members: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The vectors of a block as they are, as integers, and which are wide."""
    raw = matrix(members.field("x"), len(members))
    return raw, *whole(raw, scale)


def _with_tables(blocks: DataFrame, pivots: int, scale: float) -> DataFrame:
    """Adds `pivots` and `distances`, the pivot table of the vectors that are not wide."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for members in batch.column("members"):
                _, x, wide = _arrays(members.values, scale)
                made.append(pivot_table(x[~wide], pivots) if not wide.all() else (np.zeros(0), np.zeros(0)))
            blobs = [pa.array([m[k].astype("<f8").tobytes() for m in made], pa.binary()) for k in range(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *blobs], names=[*batch.schema.names, "pivots", "distances"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema)
    return blocks.mapInArrow(measure, f"{kinds}, pivots binary, distances binary")


def _search(members: pa.Array, pivot: bytes, distances: bytes, asked: pa.Array, k: int, scale: float, step: int) -> Iterator[tuple[int, int, np.ndarray, list[int]]]:
    """For each query: its row and id, the places of its best k members, and their scores."""
    rows = members.field("row").to_numpy()
    ids, _ = ids_of(members.field("vec_id"))
    query_rows, start = asked.field("row").to_numpy(), asked.field("start").to_numpy(zero_copy_only=False)
    query_ids, _ = ids_of(asked.field("vec_id"))
    raw, x, wide = _arrays(members, scale)
    raw_queries, queries, wide_queries = _arrays(asked, scale)
    narrow = np.flatnonzero(~wide)
    found: dict[int, list[tuple[int, int]]] = {q: [] for q in range(len(asked))}
    some = np.flatnonzero(~wide_queries)
    if len(narrow) and len(some):
        stored = np.frombuffer(pivot, "<f8").reshape(-1, x.shape[1] + 1), np.frombuffer(distances, "<f8").reshape(-1, len(narrow))
        own = (queries[some], query_rows[some], x[narrow], rows[narrow], ids[narrow])
        for q, at, scores in best_of_block(*own, k, len(stored[0]), step, stored, start[some]):
            found[int(some[q])] = list(zip(scores.tolist(), narrow[at].tolist()))
    if wide.any() or wide_queries.any():
        exact = {place: integers(raw[place], scale) for place in (range(len(x)) if wide_queries.any() else np.flatnonzero(wide).tolist())}
        for q in range(len(asked)):
            at = list(exact) if wide_queries[q] else np.flatnonzero(wide).tolist()
            if at:
                own = _exact(integers(raw_queries[q], scale), query_rows[q], [exact[place] for place in at], at, rows, ids, k)
                found[q] = sorted(found[q] + own, key=lambda s: (-s[0], ids[s[1]], rows[s[1]]))[:k]
    for q, best in found.items():
        if best:
            yield query_rows[q], query_ids[q], np.array([place for _, place in best]), as_long([score for score, _ in best], "score")


def top_k(
    vectors: DataFrame,
    queries: Column,
    *,
    k: int = 5,
    scale: float = 256.0,
    pivots: int = 32,
    block: int = 2048,
    query_block: int = 512,
    step: int = 256,
    pilot: int = 2048,
) -> DataFrame:
    """The k best rows of `vectors` (vec_id, embedding) for each row for which `queries`, a condition on vec_id, holds.

    query_id, rank (from 1), vec_id, score.
    """
    rows = numbered(vectors, "pivot-rows", queries.alias("asks"))
    rows = counted(rows, n=(F.lit(True), block), asked=(F.col("asks"), query_block)).where("asked > 0")
    blocks = written(_with_tables(packed(rows, "n", 1, "row", "vec_id", "x"), pivots, scale), "pivot-table")
    chosen = rows.orderBy(F.xxhash64("row", F.lit(5)), "row").limit(pilot).groupBy("dim")
    first = chosen.agg(F.lit(0).cast("bigint").alias("block"), F.collect_list(F.struct("row", "vec_id", "x")).alias("members"))
    asking = rows.where("asks")
    seen = _met(_with_tables(first, pivots, scale), asking.withColumn("start", F.lit(float("-inf"))), k, scale, step)
    starts = seen.where(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").cast("double").alias("start"))
    # A little below, as a double may be above the score that it was made of.
    start = F.coalesce("start", F.lit(float("-inf")))
    asking = asking.join(starts, "row", "left").withColumn("start", start - F.abs(start) * F.lit(1e-12))
    return _met(blocks, asking, k, scale, step).select("query_id", "rank", "vec_id", "score")


def _met(blocks: DataFrame, asking: DataFrame, k: int, scale: float, step: int) -> DataFrame:
    """query_row, query_id, rank, row, vec_id and score of the best k rows of `blocks` for the queries `asking`."""
    # The stated queries against all rows, block by block.
    to_all = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    sizes = asking.groupBy("dim").agg(F.first("asked").alias("asked")).join(
        blocks.groupBy("dim").agg((F.max("block") + 1).alias("n")), "dim"
    )
    candidates = blocks.join(sizes.select("dim", "asked"), "dim").withColumn("query_block", to_all("asked")).drop("asked")
    questions = packed(asking, "asked", 2, "row", "vec_id", "x", "start").withColumnsRenamed({"block": "query_block", "members": "questions"})
    questions = questions.join(sizes.select("dim", "n"), "dim").withColumn("block", to_all("n")).drop("n")
    pairs = candidates.join(questions.hint("shuffle_hash"), ["dim", "block", "query_block"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members, pivot, distances, asked in zip(*[batch.column(n) for n in ("members", "pivots", "distances", "questions")]):
                of, out = members.values, ([], [], [], [])
                for query_row, query_id, places, scores in _search(of, pivot.as_py(), distances.as_py(), asked.values, k, scale, step):
                    for to, values in zip(out, (np.full(len(places), query_row), np.full(len(places), query_id), places, scores)):
                        to.extend(values)
                places = pa.array(out[2], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), of.field("row").take(places), of.field("vec_id").take(places), pa.array(out[3], pa.int64())],
                    names=["query_row", "query_id", "row", "vec_id", "score"],
                )

    pairs = pairs.select("members", "pivots", "distances", "questions")
    found = pairs.mapInArrow(search, "query_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint")
    by_score = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
