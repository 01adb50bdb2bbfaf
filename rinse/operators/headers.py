"""Column names: what is wrong with them and what they become.

Everything here works on names alone, so it costs no pass over the data; only
whether an unnamed column holds any value comes from the profile.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinse.functions.expressions import column

# What a name may hold, and the name Spark gives an empty header.
_ILLEGAL = re.compile("[^a-zA-Z_0-9]")
_MISSING = re.compile(r"_c\d{1,4}")


@dataclass(frozen=True)
class Header:
    position: int
    source: str
    name: str
    uppercase: bool
    space: bool
    special: bool
    missing: bool
    renamed_apart: bool


def has_uppercase(name: str) -> bool:
    return name != name.lower()


def has_space(name: str) -> bool:
    return any(char.isspace() for char in name)


def has_special(name: str) -> bool:
    return _ILLEGAL.search("".join(name.split())) is not None


def normalise(name: str) -> str:
    """Lower case, whitespace to single underscores, nothing but letters, digits and ``_``."""
    return _ILLEGAL.sub("", "_".join(name.lower().split()))


def is_missing(name: str) -> bool:
    return name == "" or _MISSING.fullmatch(name) is not None


def resolve(names: Sequence[str], dropped: Collection[int] = ()) -> list[Header]:
    """New names for all columns but those at the ``dropped`` positions.

    Unnamed columns are called by their position. Where two names would become
    equal, the later one gets a number.
    """
    headers: list[Header] = []
    taken: set[str] = set()
    for position, source in enumerate(names):
        if position in dropped:
            continue
        name = normalise(source)
        missing = is_missing(name)
        wanted = f"unnamed_{position}" if missing else name
        unique, number = wanted, 1
        while unique in taken:
            number += 1
            unique = f"{wanted}_{number}"
        taken.add(unique)
        headers.append(
            Header(
                position=position,
                source=source,
                name=unique,
                uppercase=has_uppercase(source),
                space=has_space(source),
                special=has_special(source),
                missing=missing,
                renamed_apart=unique != wanted,
            )
        )
    return headers


def all_missing(names: Sequence[str]) -> bool:
    return all(is_missing(name) for name in names)


def empty_unnamed(headers: Sequence[Header], non_null: dict[str, int]) -> list[int]:
    """Positions of unnamed columns without a single value."""
    return [h.position for h in headers if h.missing and non_null[h.name] == 0]


def rename(df: DataFrame, headers: Sequence[Header], last: str | None = None) -> DataFrame:
    """``df`` with the columns that ``headers`` lists, under their new names; ``last`` also keeps the last column, as that."""
    # By position first: source names may repeat or hold dots and backticks.
    positional = df.toDF(*[f"at_{i}" for i in range(len(df.columns))])
    more = [column(f"at_{len(df.columns) - 1}").alias(last)] if last else []
    return positional.select([column(f"at_{h.position}").alias(h.name) for h in headers] + more)


def name_columns(df: DataFrame) -> DataFrame:
    """``df`` under clean names, without the unnamed columns that hold no value.

    Reads data only if there are unnamed columns, and then only those.
    """
    headers = resolve(df.columns)
    renamed = rename(df, headers)
    unnamed = [h.name for h in headers if h.missing]
    if not unnamed:
        return renamed
    counts = renamed.agg(*[F.count(name).alias(name) for name in unnamed]).first().asDict()
    dropped = empty_unnamed(headers, counts)
    return rename(df, resolve(df.columns, dropped))


def header_report(df: DataFrame) -> DataFrame:
    """One row per column: its old and new name, what was wrong with it, and for an
    unnamed column how many values it holds. Scans the unnamed columns only."""
    headers = resolve(df.columns)
    renamed = rename(df, headers)
    counts = renamed.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count(h.name).alias(h.name) for h in headers if h.missing],
    )
    none = F.lit(None).cast("bigint")
    findings = [
        F.struct(
            F.lit(h.position).alias("position"),
            F.lit(h.source).alias("source"),
            F.lit(h.name).alias("name"),
            F.lit(h.uppercase).alias("has_uppercase"),
            F.lit(h.space).alias("has_space"),
            F.lit(h.special).alias("has_special"),
            F.lit(h.missing).alias("is_missing"),
            (F.col(h.name) if h.missing else none).alias("non_null"),
        )
        for h in headers
    ]
    return counts.select(F.inline(F.array(*findings)), "row_count")
