from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rinse.functions import temporal

DATES = {
    "03/04/2024": date(2024, 4, 3),
    "3/25/2024": date(2024, 3, 25),
    "03-04-2024": date(2024, 3, 4),
    "25-03-2024": date(2024, 3, 25),
    "2024/25/12": date(2024, 12, 25),
    "2024-01-31": date(2024, 1, 31),
    "2024-31-01": date(2024, 1, 31),
    "2024-1-2": date(2024, 1, 2),
    "1/2024/3": None,
    "2024/1/2": None,
    "2024": date(2024, 1, 1),
    "31/02/2024": None,
    "0003-04-2024": date(2024, 3, 4),
    "": None,
    None: None,
}


def strings(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_date_fixtures(spark):
    rows = strings(spark, DATES).select("v", temporal.iso_date(F.col("v")).alias("d")).collect()
    assert {row["v"]: row["d"] for row in rows} == DATES


# The order in which date formats are tried.
FORMATS = ["d/M/yyyy", "M/d/yyyy", "MM/dd/yyyy", "M-d-yyyy", "d-M-yyyy", "dd-MM-yyyy", "dd/MM/yyyy",
           "yyyy/MM/dd", "yyyy/dd/MM", "yyyy-MM-dd", "yyyy-dd-MM"]


def test_dates_agree_with_trying_every_format(spark):
    draw = random.Random(3)

    def field():
        return draw.choice(["0", "1", "2", "02", "11", "12", "13", "28", "29", "30", "31", "32", "001", "012"])

    def year():
        return draw.choice(["2024", "2023", "1999", "0001", "0000", "999", "20245", "-1999"])

    values = []
    for _ in range(6000):
        parts = [field(), field(), year()]
        draw.shuffle(parts)
        joint = draw.choice("/-")
        values.append(joint.join(parts) if draw.random() < 0.9 else f"{parts[0]}/{parts[1]}-{parts[2]}")
    values += ["".join(draw.choices("0129/-", k=draw.randint(0, 10))) for _ in range(6000)]
    tried = F.coalesce(*[F.try_to_date("v", f) for f in FORMATS], F.col("v").try_cast("date"))
    different = (
        strings(spark, values)
        .select("v", temporal.iso_date(F.col("v")).alias("fast"), tried.alias("slow"))
        .filter(~F.col("fast").eqNullSafe(F.col("slow")))
        .select("v", F.col("fast").cast("string"), F.col("slow").cast("string"))
    )
    assert different.collect() == []


def test_detectors_agree_with_removing_the_noise_first(spark):
    draw = random.Random(5)
    seeds = ["2024-01-31", "1/2/2024", "3-2024-4", "2024/01/02T10:11:12", "x 2024-01-02 10:11:12Z y", "12"]
    values = []
    for _ in range(6000):
        chars = list(draw.choice(seeds))
        for _ in range(draw.randint(0, 3)):
            place = draw.randint(0, len(chars))
            if draw.random() < 0.7:
                chars.insert(place, draw.choice("é~{}€ \n\r1-/a"))
            elif chars:
                chars.pop(min(place, len(chars) - 1))
        values.append("".join(chars) + draw.choice(["", "", "\n", "\r\n", "\r", "~\n~"]))
    rows = strings(spark, values).select(
        "v",
        temporal.looks_like_date(F.col("v")).alias("date"),
        temporal.looks_like_timestamp(F.col("v")).alias("stamp"),
    ).collect()
    assert any(row["date"] for row in rows) and any(row["stamp"] for row in rows)
    for row in rows:
        kept = "".join(c for c in row["v"] if "\x07" <= c <= "z")
        assert row["date"] == plain_date(kept), row
        assert row["stamp"] == plain_stamp(kept), row


def plain_date(kept):
    """Runs of four and twice one or two digits; one line end at most behind them."""
    for end in ("\r\n", "\n", "\r"):
        if kept.endswith(end):
            kept = kept[: -len(end)]
            break
    runs = kept.replace("-", "/").split("/")
    digits = all(run and set(run) <= set("0123456789") for run in runs)
    return digits and sorted(map(len, runs)) in ([1, 1, 4], [1, 2, 4], [2, 2, 4])


def plain_stamp(kept):
    shape = "".join("9" if c in "0123456789" else {"-": "/", "T": " "}.get(c, c) for c in kept)
    return "9999/99/99 99:99:99" in shape


STAMPS = [
    ("2024-01-02 10:00:00", "GMT", "America/New_York", datetime(2024, 1, 2, 5)),
    ("2024/01/02 10:00:00", "GMT", "UTC", datetime(2024, 1, 2, 10)),
    ("2024-01-02T10:00:00+02:00", "Asia/Tokyo", "UTC", datetime(2024, 1, 2, 8)),
    ("2024-01-02T10:00:00Z", "Asia/Tokyo", "UTC", datetime(2024, 1, 2, 10)),
    ("2024-01-02 10:00:00.123987", "Asia/Tokyo", "UTC", datetime(2024, 1, 2, 1, 0, 0, 123000)),
    ("2024-11-03 05:30:00", "UTC", "America/New_York", datetime(2024, 11, 3, 1, 30)),
    ("2024-11-03 06:30:00Z", "UTC", "America/New_York", datetime(2024, 11, 3, 1, 30)),
    ("at 2024-01-02 10:00:00", "UTC", "UTC", datetime(2024, 1, 2, 10)),
    ("xx", "GMT", "UTC", None),
    ("10:00:00Z", "GMT", "UTC", None),
    (None, "GMT", "UTC", None),
]


@pytest.mark.parametrize("session", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_timestamp_fixtures_in_any_session_zone(spark, session):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        for value, into, out, expected in STAMPS:
            stripped = temporal.strip_timestamp(F.lit(value).cast("string"))
            result = spark.range(1).select(temporal.iso_timestamp(stripped, into, out))
            assert result.dtypes[0][1] == "timestamp_ntz"
            assert result.first()[0] == expected, value
        instant = spark.range(1).select(temporal.utc_wall(F.timestamp_seconds(F.lit(1730611800))))
        assert instant.first()[0] == datetime(2024, 11, 3, 5, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_iso_checks(spark):
    df = strings(spark, ["2024-01-31", "2024-13-01", "2024-1-1", "0000-01-01", "31/01/2024"])
    assert [r[0] for r in df.select(temporal.is_iso_date(F.col("v"))).collect()] == [
        True, False, False, True, False]
    df = strings(spark, ["2024-01-31T10:00:00", "2024-01-31 10:00:00.5+02:00", "2024/01/31 10:00:00"])
    assert [r[0] for r in df.select(temporal.is_iso_timestamp(F.col("v"))).collect()] == [
        True, True, False]


def test_iso_text_in_a_zone_that_skips_the_hour(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for value, text in (
            ("2024-03-10 02:30:05.678912", "2024-03-10T02:30:05.678Z"),
            ("2024-03-10 02:30:05.6", "2024-03-10T02:30:05.600Z"),
            ("2024-03-10 02:30:00", "2024-03-10T02:30:00.000Z"),
        ):
            wall = F.lit(value).cast("timestamp_ntz")
            assert spark.range(1).select(temporal.iso_text(wall)).first()[0] == text
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
