from __future__ import annotations

from rinse.operators import headers


def names(*sources, dropped=()):
    return [h.name for h in headers.resolve(sources, dropped)]


def test_fixtures():
    assert names("EMPLOYEE_ID", "  First  Name ", "Rate (%)", "a[b") == [
        "employee_id", "first_name", "rate_", "ab"]
    assert names("A0", "a1") == ["a0", "a1"]
    assert names("x!", "x", "x_2", "X") == ["x", "x_2", "x_2_2", "x_3"]
    assert names("a", "_c1", "%%", "_C33", "_c12345") == [
        "a", "unnamed_1", "unnamed_2", "unnamed_3", "_c12345"]
    assert names("a", "_c1", "_c2", dropped={1}) == ["a", "unnamed_2"]


def test_findings():
    found = headers.resolve(["Ab", "a b", "a^b", "ok"])
    assert [(h.uppercase, h.space, h.special) for h in found] == [
        (True, False, False), (False, True, False), (False, False, True), (False, False, False)]
    assert headers.all_missing(["_c0", "", "_c11"]) and not headers.all_missing(["_c0", "a"])


def test_names_with_dots_and_repeats(spark):
    df = spark.sql("select 1 as `a.b`, 2 as `x y`, 3 as `X y`, cast(null as int) as `_c3`, 5 as `q``z`")
    named = headers.name_columns(df)
    assert named.columns == ["ab", "x_y", "x_y_2", "qz"]
    assert tuple(named.first()) == (1, 2, 3, 5)


def test_no_job_without_unnamed_columns(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    headers.name_columns(spark.range(3).toDF("Some Id"))
    assert list(tracker.getJobIdsForGroup("headers")) == []
