from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from rinse.functions import text
from rinse.plans.config import PLACEMENT_MODES, CurationConfig, PlacementRule

# value -> default, then modes 1 to 6, then both ends
PLACED = {
    "$12#3$": ["123", "$123", "123", "123$", "$123", "123$", "$123$", "$123$"],
    "$$ab c$$": ["ab c", "$ab c", "ab c", "ab c$", "$ab c", "ab c$", "$ab c$", "$ab c$"],
    "a$b": ["ab", "ab", "a$b", "ab", "a$b", "a$b", "a$b", "ab"],
    "#-5.25": ["5.25"] * 8,
    "ok value": ["ok value"] * 8,
    "x": ["x"] * 8,
    "": [""] * 8,
    "éclair!": ["clair"] * 8,
    "ab$": ["ab", "ab", "ab", "ab$", "ab", "ab$", "ab$", "ab$"],
    " tab\t": ["tab"] * 8,
    None: [None] * 8,
}
MODES = [1, 2, 3, 4, 5, 6, None]


def rule(mode, chars="$"):
    return PlacementRule.of(chars, ["v"] if mode is None else [mode, "v"])


def strings(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_placement_fixtures(spark):
    columns = [text.clean(F.col("v")).alias("c0")]
    columns += [text.clean(F.col("v"), rule=rule(m)).alias(f"c{i + 1}") for i, m in enumerate(MODES)]
    for row in strings(spark, PLACED).select("v", *columns).collect():
        assert list(row)[1:] == PLACED[row["v"]], row["v"]


def spelled_out(value, extra="", placement=None):
    """The rule as a sentence: cut off the ends, filter the middle, put one mark back."""
    lead = re.match(r"[^a-zA-Z0-9]*", value).group()
    trail = re.search(r"[^a-zA-Z0-9]*\Z", value).group()
    core = value[len(lead) : len(value) - len(trail)] if len(lead) < len(value) else ""
    chars = placement.chars if placement else ""
    allowed = "@;:,/\\._ -" + extra + (chars if placement and placement.middle else "")
    ascii_alnum = re.compile("[a-zA-Z0-9]")
    core = "".join(c for c in core if c in allowed or ascii_alnum.match(c))
    first = next((c for c in lead if c in chars), "") if placement and placement.lead else ""
    last = next((c for c in trail if c in chars), "") if placement and placement.trail else ""
    return first + core + last


def random_values(count, alphabet="ab1$#+-/ .\t\n\\_é@€😀", longest=12, seed=7):
    draw = random.Random(seed)
    return ["".join(draw.choices(alphabet, k=draw.randint(0, longest))) for _ in range(count)]


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("chars", ["$", "+/-", "$,#", "€", "]"])
def test_placement_on_random_values(spark, mode, chars):
    placement = rule(mode, chars)
    df = strings(spark, random_values(600, alphabet="ab1$#+-/ .\t\n\\_é@€😀]^"))
    for value, got in df.select("v", text.clean(F.col("v"), "^", placement)).collect():
        assert got == spelled_out(value, "^", placement), value


def test_default_on_random_values(spark):
    df = strings(spark, random_values(3000))
    cleaned = text.clean(F.col("v"))
    rows = df.select("v", cleaned.alias("once"), text.clean(cleaned).alias("twice"),
                     text.breaks_rule(F.col("v")).alias("broken")).collect()
    for row in rows:
        assert row["once"] == spelled_out(row["v"])
        assert row["twice"] == row["once"]
        assert row["broken"] == (row["once"] != row["v"])
        assert re.fullmatch(r"(?:[a-zA-Z0-9](?:[a-zA-Z0-9@;:,/\\._ -]*[a-zA-Z0-9])?)?", row["once"])


def test_long_runs_take_linear_time(spark):
    long = ["a" + "-" * 300_000 + "b", " " * 300_000 + "x", "é" * 300_000, "a" + "#" * 300_000 + "b"]
    both = rule(None, "#")
    rows = strings(spark, long).select(
        F.length(text.clean(text.trim_space(F.col("v")))).alias("plain"),
        F.length(text.clean(F.col("v"), rule=both)).alias("placed"),
    ).collect()
    assert [tuple(row) for row in rows] == [(300_002, 300_002), (1, 1), (0, 0), (2, 2)]


def test_whitespace_of_any_kind(spark):
    values = ["\t a b \r\n", "\x0b\x0c", "", "a", " a", None, "a\u00a0"]
    rows = strings(spark, values).select(
        text.trim_space(F.col("v")).alias("t"), text.has_outer_space(F.col("v")).alias("p")
    ).collect()
    assert [row["t"] for row in rows] == ["a b", "", "", "a", "a", None, "a\u00a0"]
    assert [row["p"] for row in rows] == [True, True, False, False, True, None, False]


def test_empty_to_null(spark):
    rows = strings(spark, ["", "a", None, " "]).select(text.empty_to_null(F.col("v"))).collect()
    assert [row[0] for row in rows] == [None, "a", None, " "]


def test_rules_are_checked():
    assert PlacementRule.of("$,#", ["a"]).chars == "$#"
    assert PlacementRule.of(",", ["a"]).chars == ","
    assert PlacementRule.of("+/-", [4, "a", "b"]) == PlacementRule("+/-", ("a", "b"), *PLACEMENT_MODES[4])
    with pytest.raises(ValueError, match="letters or digits"):
        CurationConfig(extra_allowed="#d")
    with pytest.raises(ValueError, match="no mode 7"):
        PlacementRule.of("$", [7, "a"])
    with pytest.raises(ValueError, match="two placement rules"):
        CurationConfig.of(valid_spl_chars={"$": ["a"], "#": [1, "a"]})
    assert CurationConfig.of(valid_across_allcol="# @").extra_allowed == "#@"


def test_config_keeps_the_callers_lists():
    rules, keys = {"$": [1, "A"]}, ["A", "B"]
    bound = CurationConfig.of("A", keys, None, rules).renamed({"A": "a", "B": "b"})
    assert bound.composite_keys == ("a", "b") and bound.placement[0].columns == ("a",)
    assert rules == {"$": [1, "A"]} and keys == ["A", "B"]
