"""Key checks and removal of duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rinse.functions.expressions import column


def composite_is_empty(parts: Sequence[Column]) -> Column:
    """Whether the parts of a composite key, written one after the other, give no text."""
    return F.concat_ws("", *[part.cast("string") for part in parts]) == ""


def any_part_missing(parts: Sequence[Column]) -> Column:
    missing = parts[0].isNull()
    for part in parts[1:]:
        missing = missing | part.isNull()
    return missing


def check_keys(
    df: DataFrame, primary_key: str | None = None, composite_keys: Sequence[str] = ()
) -> DataFrame:
    """One row per key: how many rows break it. A primary key is valid without NULLs; a
    composite key unless all its parts are empty in some row."""
    none = F.lit(0).cast("bigint")
    parts = [column(name) for name in composite_keys]
    counts = df.agg(
        F.count_if(column(primary_key).isNull()).alias("pk") if primary_key else none.alias("pk"),
        F.count_if(composite_is_empty(parts)).alias("ck") if parts else none.alias("ck"),
        F.count_if(any_part_missing(parts)).alias("gaps") if parts else none.alias("gaps"),
    )

    def finding(key: str, given: bool, invalid: str, with_null: str) -> Column:
        status = F.when(F.col(invalid) > 0, "not valid").otherwise("valid") if given else "not given"
        return F.struct(
            F.lit(key).alias("key"),
            (status if isinstance(status, Column) else F.lit(status)).alias("status"),
            F.col(invalid).alias("invalid_rows"),
            F.col(with_null).alias("rows_with_null"),
        )

    return counts.select(
        F.inline(
            F.array(
                finding("primary", primary_key is not None, "pk", "pk"),
                finding("composite", bool(parts), "ck", "gaps"),
            )
        )
    )


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(field.dataType) for field in data_type)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def _ordered(value: Column, data_type: T.DataType) -> Column:
    """The value in a form that can be compared: maps as sorted entries, variants as their text."""
    if _orderable(data_type):
        return value
    if isinstance(data_type, T.MapType):
        entry = T.StructType().add("key", data_type.keyType).add("value", data_type.valueType)
        entries = F.transform(F.map_entries(value), lambda x: _ordered(x, entry))
        return F.array_sort(entries)
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda x: _ordered(x, data_type.elementType))
    if isinstance(data_type, T.StructType):
        fields = [_ordered(value.getField(f.name), f.dataType).alias(f.name) for f in data_type]
        return F.when(value.isNotNull(), F.struct(*fields))
    return F.to_json(value)


def dedup_keys(
    columns: Sequence[str], primary_key: str | None = None, composite_keys: Sequence[str] = ()
) -> list[str]:
    """What makes two rows duplicates: the primary key, else the composite key, else all columns."""
    return [primary_key] if primary_key else list(composite_keys) or list(columns)


def deduplicate(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row for each value of ``keys``; rows whose key is NULL count as equal.

    Of equal rows the first by ``order_by`` and then by the remaining columns
    survives, so the result does not depend on how the data is partitioned or on
    which tasks were run again. Each task reduces its own rows to one per key
    before the shuffle, so a key that holds a large share of all rows costs no
    more than any other.
    """
    types = {f.name: f.dataType for f in df.schema}
    rest = [name for name in df.columns if name not in keys]
    rank = [name for name in order_by if name in rest]
    rank += [name for name in rest if name not in rank]
    if all(map(_orderable, types.values())):
        if not rest:
            return df.distinct()
        first = F.min(F.struct(*[column(name) for name in rank])).alias("survivor")
        groups = df.groupBy(*[column(name) for name in keys]).agg(first)
        return groups.select(
            [
                column(name) if name in keys else F.col("survivor").getField(name).alias(name)
                for name in df.columns
            ]
        )
    # Maps and variants are compared in a form that can be, and come back as they were.
    row = F.struct(*[column(name).alias(f"c{i}") for i, name in enumerate(df.columns)])
    order = [_ordered(column(name), types[name]).alias(f"r{i}") for i, name in enumerate(rank)]
    groups = df.groupBy(*[_ordered(column(n), types[n]).alias(f"k{i}") for i, n in enumerate(keys)])
    first = F.min_by(row, F.struct(*order) if order else F.lit(0)).alias("survivor")
    return groups.agg(first).select(
        [F.col("survivor").getField(f"c{i}").alias(name) for i, name in enumerate(df.columns)]
    )


def count_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts before and after deduplication, from the key columns alone."""
    types = {f.name: f.dataType for f in df.schema}
    by = [_ordered(column(name), types[name]).alias(f"k{i}") for i, name in enumerate(keys)]
    groups = df.groupBy(*by).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    ).withColumn("removed", F.col("rows_before") - F.col("rows_after"))
