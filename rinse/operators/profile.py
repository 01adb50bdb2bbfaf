"""Finding data-quality problems: fused passes that count, for each column, the rows a rule concerns.

Every profile turns the columns into (column, value) pairs inside the scan's own
stage and counts per column with a partial aggregate. However wide the table, that
is one pass over the data, generated code of constant size, and a shuffle of one
small row per column and task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rinse.functions import numeric, temporal, text
from rinse.functions.expressions import column
from rinse.operators import keys
from rinse.plans.config import CurationConfig

#: Names of the pseudo-columns that stand for the composite key, and for rows with more or fewer fields than the header.
COMPOSITE = "<composite key>"
MALFORMED, SHORT = "<malformed rows>", "<short rows>"


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def _pairs(df: DataFrame, columns: Sequence[str], markers: dict[str, Column]) -> DataFrame:
    """(column, value) for the named text columns and for each marker; no rows where there are none."""
    if not columns and not markers:
        nothing = F.lit("")
        return df.select(nothing.alias("column"), nothing.alias("value")).where(F.lit(False))
    wide = df.select(
        [column(name) for name in columns]
        + [present.alias(name) for name, present in markers.items()]
    )
    return wide.unpivot([], [column(name) for name in wide.columns], "column", "value")


def kept_apart(malformed: str = MALFORMED) -> Column:
    """Whether a row has more fields than the header; the column ``malformed`` is that of the CSV reader."""
    return F.coalesce(column(malformed).getField("more"), F.lit(False))


def _marker(present: Column) -> Column:
    return F.when(present, F.lit("1"))


def count_where(
    df: DataFrame, predicate: Callable[[Column], Column], columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows per text column whose value satisfies ``predicate``."""
    pairs = _pairs(df, text_columns(df) if columns is None else columns, {})
    return pairs.groupBy("column").agg(
        F.count("value").alias("non_null"), F.count_if(predicate(F.col("value"))).alias("rows")
    )


def _by_rule(config: CurationConfig, name: Column, apply: Callable[..., Column]) -> Column:
    """``apply(rule)`` under each column's own placement rule, ``apply(None)`` for all others."""
    result = apply(None)
    for rule in config.placement:
        result = F.when(name.isin(*rule.columns), apply(rule)).otherwise(result)
    return result


def special_characters(
    df: DataFrame, config: CurationConfig, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows per text column that break the column's special-character rule."""
    pairs = _pairs(df, text_columns(df) if columns is None else columns, {})
    broken = _by_rule(
        config,
        F.col("column"),
        lambda rule: text.breaks_rule(F.col("value"), config.extra_allowed, rule),
    )
    return pairs.groupBy("column").agg(
        F.count("value").alias("non_null"), F.count_if(broken).alias("rows")
    )


def cleaned_text(value: Column, config: CurationConfig, name: str) -> Column:
    cleaned = text.clean(text.trim_space(value), config.extra_allowed, config.rule_for(name))
    return text.empty_to_null(cleaned)


def infer_types(df: DataFrame) -> DataFrame:
    """The numeric type that all values of a text column fit, else string."""
    pairs = _pairs(df, text_columns(df), {})
    value = F.col("value")
    number = F.col("number")
    counts = pairs.withColumn("number", numeric.is_number(value)).groupBy("column").agg(
        F.count(value).alias("non_null"),
        F.count_if(number & numeric.number_is_float(value)).alias("float_rows"),
        F.count_if(number & numeric.number_is_integer(value)).alias("integer_rows"),
    )
    some = F.col("non_null") > 0
    return counts.withColumn(
        "type",
        F.when(some & (F.col("float_rows") == F.col("non_null")), "float")
        .when(some & (F.col("integer_rows") == F.col("non_null")), "integer")
        .otherwise("string"),
    )


def detect(df: DataFrame) -> DataFrame:
    """How many values of each text column look like a date or a timestamp."""
    value = F.col("value")
    return _pairs(df, text_columns(df), {}).groupBy("column").agg(
        F.count(value).alias("non_null"),
        F.count_if(temporal.looks_like_date(value)).alias("date_rows"),
        F.count_if(temporal.looks_like_timestamp(value)).alias("timestamp_rows"),
    )


def profile(df: DataFrame, config: CurationConfig) -> DataFrame:
    """All text findings at once, one row per column.

    Counts on the values as they are (``rows``, ``non_null``, ``date_rows``,
    ``timestamp_rows``, of them ``iso_date_rows``, ``iso_timestamp_rows`` and ``zoned_rows``,
    ``padded_rows``) and on the values cleaned as text (``special_rows``, ``empty_rows``,
    ``filled_rows``, ``float_rows``, ``integer_rows``). Columns of other types only have their
    values counted. Where there is a column MALFORMED, the ``non_null`` of MALFORMED and SHORT count the
    rows with more and with fewer fields than the header; of the former no value is counted.
    """
    texts = text_columns(df)
    markers = {
        f.name: _marker(column(f.name).isNotNull())
        for f in df.schema
        if f.name not in texts and f.name != MALFORMED
    }
    if MALFORMED in df.columns:
        more = kept_apart()
        markers = {name: F.when(~more, present) for name, present in markers.items()}
        markers[MALFORMED] = _marker(more)
        markers[SHORT] = _marker(column(MALFORMED).isNotNull() & ~more)
        df = df.withColumns({name: F.when(~more, column(name)) for name in texts})
    if config.composite_keys:
        parts = [
            cleaned_text(column(name), config, name) if name in texts else column(name)
            for name in config.composite_keys
        ]
        markers[COMPOSITE] = _marker(~keys.composite_is_empty(parts))
    value, trimmed, cleaned = map(F.col, ("value", "trimmed", "cleaned"))
    plain, number = F.col("plain"), F.col("number")
    by_rule = _by_rule(
        config, F.col("column"), lambda rule: text.clean(trimmed, config.extra_allowed, rule)
    )
    # One pattern settles most numbers: they need no trimming and no cleaning.
    dated, stamped = F.col("dated"), F.col("stamped")
    steps = (
        _pairs(df, texts, markers)
        .withColumn("plain", numeric.is_plain(value))
        .withColumn("trimmed", F.when(plain, value).otherwise(text.trim_space(value)))
        .withColumn("cleaned", F.when(plain, trimmed).otherwise(by_rule))
        .withColumn("number", plain | numeric.is_number(cleaned))
        .withColumn("dated", temporal.looks_like_date(value))
        .withColumn("stamped", temporal.looks_like_timestamp(value))
    )
    return steps.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(value).alias("non_null"),
        F.count_if(dated).alias("date_rows"),
        F.count_if(stamped).alias("timestamp_rows"),
        F.count_if(dated & temporal.is_iso_date(value)).alias("iso_date_rows"),
        F.count_if(stamped & temporal.is_iso_timestamp(value)).alias("iso_timestamp_rows"),
        F.count_if(stamped & temporal.has_own_zone(value)).alias("zoned_rows"),
        F.count_if(trimmed != value).alias("padded_rows"),
        F.count_if(cleaned != trimmed).alias("special_rows"),
        F.count_if(text.is_empty(cleaned)).alias("empty_rows"),
        F.count_if(~text.is_empty(cleaned)).alias("filled_rows"),
        F.count_if(number & numeric.number_is_float(cleaned)).alias("float_rows"),
        F.count_if(number & numeric.number_is_integer(cleaned)).alias("integer_rows"),
    )


def profile_temporal(
    df: DataFrame,
    config: CurationConfig,
    dates: Sequence[str],
    timestamps: Sequence[str],
    composite_parts: Sequence[Column] = (),
) -> DataFrame:
    """Findings on the text columns that hold dates or timestamps, one row per column.

    ``padded_rows`` had whitespace left around the timestamp, ``unparsed_rows`` held
    something that is no date or timestamp, ``filled_rows`` hold one.
    """
    markers = {}
    if composite_parts:
        markers[COMPOSITE] = _marker(~keys.composite_is_empty(composite_parts))
    name, value, stripped = map(F.col, ("column", "value", "stripped"))
    is_date = name.isin(*dates)
    is_timestamp = name.isin(*timestamps)
    shift = temporal.iso_timestamp(stripped, config.input_tz, config.output_tz)
    unpadded = (
        F.when(is_date, temporal.strip_date(value))
        .when(is_timestamp, temporal.strip_timestamp(value))
        .otherwise(value)
    )
    parsed = (
        F.when(is_date, temporal.iso_date(stripped).isNotNull())
        .when(is_timestamp, shift.isNotNull())
        .otherwise(stripped.isNotNull())
    )
    steps = _pairs(df, [*dates, *timestamps], markers).withColumn("stripped", unpadded)
    steps = steps.withColumn("parsed", parsed)
    empty = text.is_empty(stripped)
    return steps.groupBy("column").agg(
        F.count_if(is_timestamp & temporal.has_padding(value)).alias("padded_rows"),
        F.count_if(empty).alias("empty_rows"),
        F.count_if(F.col("parsed")).alias("filled_rows"),
        F.count_if(stripped.isNotNull() & ~empty & ~F.col("parsed")).alias("unparsed_rows"),
    )
