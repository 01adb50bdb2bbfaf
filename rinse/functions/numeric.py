"""Column expressions that tell whether text is a number.

A cast that fails costs an exception inside Spark, so patterns sort out first what
would fail.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rinse.functions import patterns

_LARGEST_INTEGER = 2**31 - 1


def is_plain(value: Column) -> Column:
    """Whether the text is a number that no cleaning rule changes."""
    return value.rlike(patterns.PLAIN_NUMBER)


def is_number(value: Column) -> Column:
    """Whether the text is digits with at most one point."""
    return value.rlike(patterns.NUMBER)


def number_is_integer(value: Column) -> Column:
    """Whether the text, known to be a number, has no point and fits 32 bits."""
    fits = value.rlike(patterns.SHORT_INTEGER) & (value.try_cast("bigint") <= _LARGEST_INTEGER)
    return ~value.contains(".") & ((F.length(value) <= 9) | fits)


def number_is_float(value: Column) -> Column:
    """Whether the text, known to be a number, has a point."""
    return value.contains(".")


def fits_integer(value: Column) -> Column:
    return is_number(value) & number_is_integer(value)


def fits_float(value: Column) -> Column:
    return is_number(value) & number_is_float(value)


def to_integer(value: Column) -> Column:
    """A 32-bit integer, NULL for text that is none, at no exception each."""
    return F.when(fits_integer(value), value.try_cast("int"))


def to_float(value: Column) -> Column:
    """A 32-bit float, NULL for text that is no number or too large, at no exception each."""
    number = value.try_cast("float")
    return F.when(is_number(value) & (number < F.lit(float("inf"))), number)
