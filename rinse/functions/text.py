"""Column expressions for text: trimming, special characters, empty values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rinse.functions import patterns
from rinse.plans.config import PlacementRule


def trim_space(value: Column) -> Column:
    """Drop outer whitespace of any kind, not just blanks."""
    return F.trim(value, F.lit(patterns.WHITESPACE))


def has_outer_space(value: Column) -> Column:
    return value != trim_space(value)


def is_empty(value: Column) -> Column:
    return value == ""


def empty_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def clean(value: Column, extra: str = "", rule: PlacementRule | None = None) -> Column:
    """Delete special characters that are not legal where they stand.

    Without a rule, outer non-alphanumerics and inner characters outside the
    allowed ones go. A rule keeps one of its characters in front, one behind, and
    any number inside, as far as it says so.
    """
    inner = patterns.ALLOWED + extra + (rule.chars if rule and rule.middle else "")
    # Once only allowed characters are left, what remains of the outer
    # non-alphanumerics is allowed ones, and a plain trim takes them off.
    core = F.trim(F.regexp_replace(value, patterns.not_allowed(inner), ""), F.lit(inner))
    if rule and rule.lead:
        core = F.concat(F.regexp_extract(value, patterns.first_of_lead(rule.chars), 1), core)
    if rule and rule.trail:
        # Read backwards, the trailing run leads, and its first character comes last.
        backwards = F.regexp_extract(F.reverse(value), patterns.last_of_lead(rule.chars), 1)
        core = F.concat(core, backwards)
    return core


def breaks_rule(value: Column, extra: str = "", rule: PlacementRule | None = None) -> Column:
    """Whether cleaning would change ``value`` (NULL stays NULL)."""
    return value != clean(value, extra, rule)
