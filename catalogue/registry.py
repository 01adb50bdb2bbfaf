"""Queries on the given tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def as_text(*names: str) -> list[Column]:
    return [F.col(name).cast("string").alias(name) for name in names]


def money(name: str) -> Column:
    """Two decimals as text, the same in every engine."""
    return F.col(name).cast("decimal(12,2)").cast("string")


ALNUM = "'0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'"
# Fixed value: what text may hold between its first and last letter or digit.
INNER = "@;:,/\\._ -"


def sql_clean(value: str, extra: str = "") -> str:
    return sql_place(value, "", False, False, False, extra)


def sql_trim(value: str) -> str:
    return rf"regexp_replace({value}, '^\s+|\s+$', '', 'g')"


def sql_text(value: str) -> str:
    """Trimmed, cleaned, empty to NULL."""
    return f"nullif({sql_clean(sql_trim(value))}, '')"


def sql_place(value: str, chars: str, lead: bool, middle: bool, trail: bool, extra: str = "") -> str:
    """The value's characters in a list: those before the first letter or digit, from there to the last, and after."""
    inner = f"'{INNER}{extra}{chars if middle else ''}'"
    first = "coalesce(nullif(list_position(list_transform(c, lambda x: contains({0}, x)), true), 0), {1})"
    begin = first.format(ALNUM, "len(c) + 1")
    end = "len(c) + 1 - " + first.format(ALNUM, "len(c) + 1").replace("list_transform(c,", "list_transform(list_reverse(c),")
    legal = f"list_filter(c[b:e], lambda x: contains({ALNUM}, x) or contains({inner}, x))"
    one = "coalesce(list_filter({0}, lambda x: contains('%s', x))[1], '')" % chars
    # Without a letter or digit, all characters are both before and after.
    front = [one.format("c[1:b - 1]")] if lead else []
    back = [one.format("c[case when b > len(c) then 1 else e + 1 end:]")] if trail else []
    parts = ", ".join([*front, f"coalesce(array_to_string({legal}, ''), '')", *back])
    bound = f"list_transform([string_split({value}, '')], lambda c: list_transform([{begin}], lambda b: list_transform([{end}], lambda e: concat({parts}))[1])[1])[1]"
    return f"case when {value} is not null then {bound} end"
