"""The audit table: what curation found and did, in the order of its steps."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

HEADER, DATA = "Header", "Data"

# The format of the clock column and the first three column names.
_CLOCK = "%Y-%m-%d %H:%M:%S"
SCHEMA = (
    "`Timestamp` string, `Cleansing Part` string, `Message` string, "
    "rule string, `column` string, rows_affected bigint"
)


@dataclass(frozen=True)
class Entry:
    part: str
    rule: str
    message: str
    column: str | None = None
    rows: int | None = None


def nothing_to_do(part: str) -> Entry:
    return Entry(part, "none", f"{part}: no cleansing required")


def audit_table(
    spark: SparkSession, entries: Sequence[Entry], now: datetime | None = None
) -> DataFrame:
    """Header entries first, then data entries, with a line for a part that had none."""
    clock = (now or datetime.now()).strftime(_CLOCK)
    rows = []
    for part in (HEADER, DATA):
        of_part = [entry for entry in entries if entry.part == part] or [nothing_to_do(part)]
        rows += [(clock, e.part, e.message, e.rule, e.column, e.rows) for e in of_part]
    return spark.createDataFrame(rows, SCHEMA)
