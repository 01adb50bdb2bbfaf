"""Looking at a table: head, size, names and types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinse.functions.expressions import column


def preview(df: DataFrame, rows: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """The first rows; with ``order_by`` always the same ones."""
    ordered = df.orderBy(*[column(name) for name in order_by]) if order_by else df
    return ordered.limit(rows)


def inspect(df: DataFrame, name: str) -> DataFrame:
    """A single column."""
    return df.select(column(name))


def statistics(df: DataFrame) -> DataFrame:
    """Row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns))
    )


def dataset_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name and type, with the size of the table."""
    described = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("column"),
            F.lit(data_type).alias("type"),
        )
        for position, (name, data_type) in enumerate(df.dtypes)
    ]
    return statistics(df).select(F.inline(F.array(*described)), "row_count", "column_count")
