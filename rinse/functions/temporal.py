"""Column expressions that recognise dates and timestamps in text and make them typed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rinse.functions import patterns
from rinse.functions.text import has_outer_space, trim_space


# Most values are spared the pattern, because they lack a character it cannot do without.
def looks_like_date(value: Column) -> Column:
    return (value.contains("-") | value.contains("/")) & value.rlike(patterns.DATE_LIKE)


def looks_like_timestamp(value: Column) -> Column:
    return value.contains(":") & value.rlike(patterns.TIMESTAMP_LIKE)


def is_iso_date(value: Column) -> Column:
    return is_iso_shaped_date(value) & value.try_cast("date").isNotNull()


def is_iso_timestamp(value: Column) -> Column:
    return is_iso_shaped_timestamp(value) & value.try_cast("timestamp").isNotNull()


def is_iso_shaped_date(value: Column) -> Column:
    return value.rlike(patterns.ISO_DATE)


def is_iso_shaped_timestamp(value: Column) -> Column:
    return value.rlike(patterns.ISO_TIMESTAMP)


def has_own_zone(value: Column) -> Column:
    """Whether a zone or an offset follows the time of day."""
    return value.rlike(patterns.OWN_ZONE)


def strip_date(value: Column) -> Column:
    """Keep digits, slashes and dashes."""
    return F.regexp_replace(value, patterns.NOT_DATE, "")


def _timestamp_characters(value: Column) -> Column:
    return F.regexp_replace(value, patterns.NOT_TIMESTAMP, "")


def strip_timestamp(value: Column) -> Column:
    """Keep what a timestamp with fraction and offset may hold, without outer whitespace."""
    return trim_space(_timestamp_characters(value))


def has_padding(value: Column) -> Column:
    """Whether stripping to timestamp characters leaves outer whitespace to trim."""
    return has_outer_space(_timestamp_characters(value))


def iso_date(value: Column) -> Column:
    """Stripped date text to DATE, NULL where it is none.

    Slashes read day first, dashes month first, and each order the other way round
    where that gives no date; with the year in front month comes before day. The
    fields are put in ISO order and cast, because a cascade of format parsers raises
    an exception inside Spark for each format that does not fit.
    """
    orders = (
        (patterns.YEAR_LAST_SLASH, "$3-$2-$1"),
        (patterns.YEAR_LAST_SLASH, "$3-$1-$2"),
        (patterns.YEAR_LAST_DASH, "$3-$1-$2"),
        (patterns.YEAR_LAST_DASH, "$3-$2-$1"),
        (patterns.YEAR_FIRST, "$1-$3-$4"),
        (patterns.YEAR_FIRST, "$1-$4-$3"),
    )
    # What can be cast as it is has its year in front and its month next. Text of
    # another shape is left alone by a replacement, and casting it fails once more.
    reordered = [F.regexp_replace(value, shape, order) for shape, order in orders]
    return F.coalesce(*[text.try_cast("date") for text in (value, *reordered)])


def _to_millis(wall: Column) -> Column:
    below = F.extract(F.lit("SECOND"), wall) % F.lit(0.001).cast("decimal(4,3)")
    zero = F.lit(0)
    return wall - F.make_dt_interval(zero, zero, zero, below)


def same_zone(one: str, other: str) -> bool:
    """Whether two names stand for the same zone: equal, or both for UTC."""
    utc = {"UTC", "GMT", "Z", "UCT", "ETC/UTC", "ETC/GMT", "ZULU"}
    return one == other or {one.upper(), other.upper()} <= utc


def in_zone(wall: Column, input_tz: str, output_tz: str) -> Column:
    """A wall clock in one zone to the same moment's wall clock in another, to the microsecond."""
    return F.convert_timezone(F.lit(input_tz), F.lit(output_tz), wall)


def utc_wall(instant: Column) -> Column:
    """The wall clock at UTC, whatever the session's zone."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def shift_zone(wall: Column, input_tz: str, output_tz: str) -> Column:
    """A wall clock in one zone to the same moment's wall clock in another, in milliseconds."""
    return _to_millis(in_zone(wall, input_tz, output_tz))


def iso_timestamp(value: Column, input_tz: str = "GMT", output_tz: str = "UTC") -> Column:
    """Stripped timestamp text to TIMESTAMP_NTZ on ``output_tz``'s clock, NULL where it is none.

    The text is on ``input_tz``'s clock unless it carries its own zone or offset.
    """
    dashed = F.translate(value, "/", "-")
    local = dashed.try_cast("timestamp_ntz")
    zoned = utc_wall(dashed.try_cast("timestamp"))
    return F.when(
        has_own_zone(dashed) & local.isNotNull(), shift_zone(zoned, "UTC", output_tz)
    ).otherwise(shift_zone(local, input_tz, output_tz))


def iso_text(wall: Column) -> Column:
    """A wall clock at UTC as ISO 8601 text with milliseconds."""
    # Spelled out because formatting would go through the session's zone.
    text = _to_millis(wall).cast("string")
    seconds = F.translate(F.substring(text, 1, 19), " ", "T")
    millis = F.rpad(F.substring(text, 21, 3), 3, "0")
    return F.concat(seconds, F.lit("."), millis, F.lit("Z"))
