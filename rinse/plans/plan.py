"""What a profile decides: a new name, a kind and a rule for each column."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rinse.functions import numeric, temporal, text
from rinse.functions.expressions import column
from rinse.operators.headers import Header
from rinse.operators.profile import text_columns
from rinse.plans.config import CurationConfig, PlacementRule

TEXT, INTEGER, FLOAT, DATE, TIMESTAMP = "text", "integer", "float", "date", "timestamp"
#: Columns that were typed before: a timestamp is moved between zones, the rest stays.
TYPED_TIMESTAMP, UNTOUCHED = "typed timestamp", "untouched"


@dataclass(frozen=True)
class ColumnPlan:
    source: str
    name: str
    kind: str
    rule: PlacementRule | None = None
    #: Every value is ISO text already: a date or timestamp that needs no repair, only to be read.
    iso: bool = False


@dataclass(frozen=True)
class CurationPlan:
    """Plain data; learned from one table, it can be applied to any later batch of it."""

    source_columns: tuple[str, ...]
    positions: tuple[int, ...]
    columns: tuple[ColumnPlan, ...]
    extra_allowed: str = ""
    input_tz: str = "GMT"
    output_tz: str = "UTC"
    primary_key: str | None = None
    composite_keys: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()

    def of_kind(self, *kinds: str) -> list[str]:
        return [plan.name for plan in self.columns if plan.kind in kinds]

    def to_repair(self, kind: str) -> list[str]:
        """Date or timestamp columns with values that are not ISO."""
        return [plan.name for plan in self.columns if plan.kind == kind and not plan.iso]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(document: str) -> CurationPlan:
        fields = json.loads(document)
        columns = tuple(
            ColumnPlan(**(plan | {"rule": _rule_from(plan["rule"])})) for plan in fields["columns"]
        )
        tuples = {
            name: tuple(fields[name])
            for name in ("source_columns", "positions", "composite_keys", "order_by")
        }
        return CurationPlan(**(fields | tuples | {"columns": columns}))


def _rule_from(fields: dict | None) -> PlacementRule | None:
    return PlacementRule(**(fields | {"columns": tuple(fields["columns"])})) if fields else None


def _often_enough(rows: int, non_null: int, ratio: float) -> bool:
    return rows > 0 and rows >= ratio * non_null


def text_kind(counts: Mapping[str, int], ratio: float) -> str:
    """The kind of a text column. A date wins over a timestamp, a float over an integer,
    and a column without values stays text."""
    if _often_enough(counts["date_rows"], counts["non_null"], ratio):
        return DATE
    if _often_enough(counts["timestamp_rows"], counts["non_null"], ratio):
        return TIMESTAMP
    filled = counts["filled_rows"]
    if filled and counts["float_rows"] == filled:
        return FLOAT
    if filled and counts["integer_rows"] == filled:
        return INTEGER
    return TEXT


def is_iso(kind: str, counts: Mapping[str, int]) -> bool:
    """Whether all values of a date or timestamp column are ISO already."""
    of_kind = {DATE: "iso_date_rows", TIMESTAMP: "iso_timestamp_rows"}
    return kind in of_kind and counts[of_kind[kind]] == counts["non_null"]


def make_plan(
    df: DataFrame,
    source_columns: Sequence[str],
    headers: Sequence[Header],
    counts: Mapping[str, Mapping[str, int]],
    config: CurationConfig,
) -> CurationPlan:
    """``df`` has the new names; ``counts`` holds a profile row for each of them."""
    texts = set(text_columns(df))
    columns = []
    for header in headers:
        name = header.name
        if name in texts:
            kind = text_kind(counts[name], config.min_match_ratio)
        elif isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
            # Without a zone to go to, a typed timestamp keeps its value to the microsecond.
            same = temporal.same_zone(config.input_tz, config.output_tz)
            kind = UNTOUCHED if same else TYPED_TIMESTAMP
        else:
            kind = UNTOUCHED
        rule = config.rule_for(name) if kind in (TEXT, INTEGER, FLOAT) else None
        iso = name in texts and is_iso(kind, counts[name])
        columns.append(ColumnPlan(header.source, name, kind, rule, iso))
    return CurationPlan(
        source_columns=tuple(source_columns),
        positions=tuple(header.position for header in headers),
        columns=tuple(columns),
        extra_allowed=config.extra_allowed,
        input_tz=config.input_tz,
        output_tz=config.output_tz,
        primary_key=config.primary_key,
        composite_keys=config.composite_keys,
        order_by=config.order_by,
    )


def _stripped(value: Column, plan: ColumnPlan) -> Column:
    if plan.kind not in (DATE, TIMESTAMP):
        return value
    is_date = plan.kind == DATE
    stripped = temporal.strip_date(value) if is_date else temporal.strip_timestamp(value)
    # A later batch may hold what is not ISO.
    return F.when(_iso_shaped(value, plan), value).otherwise(stripped) if plan.iso else stripped


def _iso_shaped(value: Column, plan: ColumnPlan) -> Column:
    of = temporal.is_iso_shaped_date if plan.kind == DATE else temporal.is_iso_shaped_timestamp
    return of(value)


def _cleaned(value: Column, plan: ColumnPlan, extra: str) -> Column:
    if plan.kind in (TYPED_TIMESTAMP, UNTOUCHED):
        return value
    if plan.kind in (TEXT, INTEGER, FLOAT):
        # Outer whitespace goes with the other outer characters.
        cleaned = text.clean(value, extra, plan.rule)
        if plan.kind != TEXT:
            cleaned = F.when(numeric.is_plain(value), value).otherwise(cleaned)
        value = cleaned
    return text.empty_to_null(value)


def _typed(value: Column, plan: ColumnPlan, whole: CurationPlan, schema: T.StructType) -> Column:
    if plan.kind == DATE:
        repaired = temporal.iso_date(value)
        return F.when(_iso_shaped(value, plan), value.try_cast("date")).otherwise(repaired) if plan.iso else repaired
    if plan.kind == TIMESTAMP:
        return temporal.iso_timestamp(value, whole.input_tz, whole.output_tz)
    if plan.kind == TYPED_TIMESTAMP:
        is_instant = isinstance(schema[plan.name].dataType, T.TimestampType)
        wall = temporal.utc_wall(value) if is_instant else value
        return temporal.in_zone(wall, whole.input_tz, whole.output_tz)
    if plan.kind == INTEGER:
        return numeric.to_integer(value)
    if plan.kind == FLOAT:
        return numeric.to_float(value)
    return value


def curated(name: str, plan: CurationPlan, schema: T.StructType) -> Column:
    """The curated value of one column of a table that already has the new names."""
    of = next(p for p in plan.columns if p.name == name)
    stripped = _stripped(column(name), of)
    return _typed(_cleaned(stripped, of, plan.extra_allowed), of, plan, schema)


def _in_plan_order(df: DataFrame, plan: CurationPlan) -> DataFrame:
    if tuple(df.columns) == plan.source_columns:
        # By position first: source names may repeat or hold dots and backticks.
        at = df.toDF(*[f"at_{i}" for i in range(len(df.columns))])
        chosen = [column(f"at_{position}") for position in plan.positions]
        return at.select([c.alias(p.name) for c, p in zip(chosen, plan.columns)])
    missing = [p.source for p in plan.columns if df.columns.count(p.source) != 1]
    if missing:
        raise ValueError(f"the plan does not fit: columns {missing} are not there once")
    return df.select([column(p.source).alias(p.name) for p in plan.columns])


def apply(df: DataFrame, plan: CurationPlan) -> DataFrame:
    """Rename, clean and type the columns of ``df``. Starts no job and drops no row, and
    because it is nothing but projections it runs on a stream just as well."""
    stage = _in_plan_order(df, plan)
    stage = stage.select(
        [_stripped(column(p.name), p).alias(p.name) for p in plan.columns]
    )
    stage = stage.select(
        [_cleaned(column(p.name), p, plan.extra_allowed).alias(p.name) for p in plan.columns]
    )
    schema = stage.schema
    return stage.select(
        [_typed(column(p.name), p, plan, schema).alias(p.name) for p in plan.columns]
    )
