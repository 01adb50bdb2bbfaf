"""Vector tables for the operators that search or code them: what takes part, numbered rows, blocks for tasks.

Integer operators turn each component into floor(scale * x). Sums of products of such integers are exact in doubles
as long as they stay below 2**53; vectors with larger components are `wide`, and are computed with Python's integers.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rinse.llm.components import join_hot
from rinse.llm.shared import written

_LONG = 1 << 63


def finite(vector: Column) -> Column:
    """Whether a vector is there, has components, and none is null, NaN or infinite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(math.inf)))
    return vector.isNotNull() & (F.size(vector) > 0) & good


def numbered(vectors: DataFrame, name: str, *more: Column) -> DataFrame:
    """row, vec_id, x (doubles), dim and the columns `more`, written, so that a row keeps its number."""
    rows = vectors.where(finite(F.col("embedding"))).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("x"),
        F.size("embedding").alias("dim"),
        *more,
    )
    return written(rows, name)


def counted(rows: DataFrame, **per_block: tuple[Column, int]) -> DataFrame:
    """Adds, for each name, how many blocks the rows of this length that fulfil its condition make up."""
    wanted = [F.count(F.when(condition, 1)).alias(name) for name, (condition, _) in per_block.items()]
    sizes = rows.groupBy("dim").agg(F.count("*").alias("_rows"), *wanted)
    sizes = sizes.withColumns({name: F.ceil(F.col(name) / size) for name, (_, size) in per_block.items()})
    return join_hot(rows, sizes, "dim", "_rows", rows.count()).drop("_rows")


def packed(rows: DataFrame, blocks: str, salt: int, *columns: str) -> DataFrame:
    """The rows as one list of `columns` for each (dim, block), dealt by a checksum of the row's number."""
    block = F.pmod(F.xxhash64("row", F.lit(salt)), F.col(blocks))
    return rows.groupBy("dim", block.alias("block")).agg(F.collect_list(F.struct(*columns)).alias("members"))


def matrix(lists: pa.Array, rows: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids with the largest long for null, and which are null."""
    return column.fill_null(_LONG - 1).to_numpy(zero_copy_only=False), np.asarray(column.is_null())


def whole(x: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x), exact integers as doubles, and which rows are wide; those are 0 here."""
    with np.errstate(over="ignore"):
        out = np.floor(x * scale)
    wide = (np.abs(out) >= math.sqrt(2**52 / max(1, x.shape[1]))).any(axis=1)
    out[wide] = 0
    return out, wide


def integers(row: np.ndarray, scale: float) -> list[int]:
    """The same of one vector as Python integers."""
    return [math.floor(Fraction(v) * Fraction(scale)) for v in row.tolist()]


def as_long(values: list[int], of: str) -> list[int]:
    """The values, if each fits a long."""
    for v in values:
        if not -_LONG <= v < _LONG:
            raise OverflowError(f"a {of} of {v} does not fit a long")
    return values
