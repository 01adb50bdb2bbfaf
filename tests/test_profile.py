from __future__ import annotations

from pyspark.sql import functions as F

from rinse.functions import numeric
from rinse.operators import profile
from rinse.plans.config import CurationConfig


def by_column(df):
    return {row["column"]: row.asDict() for row in df.collect()}


def test_types(spark):
    rows = [
        ("1", "1.5", "1", "-1", "99999999999", ".", None, "0000000000000000000007"),
        ("22", ".5", "1.5", "2", "1", ".", None, "2147483647"),
        (None, "2.", None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "i string, f string, mixed string, sign string, big string, "
                                     "dot string, nothing string, padded string")
    types = {name: row["type"] for name, row in by_column(profile.infer_types(df)).items()}
    assert types == {
        "i": "integer", "f": "float", "mixed": "string", "sign": "string", "big": "string",
        "dot": "string", "nothing": "string", "padded": "integer",
    }


def test_casts(spark):
    values = ["2147483647", "2147483648", "5", "", "1.5", ".5", "2.", ".", "x", "0" * 30 + "12", "9" * 40, None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select(numeric.to_integer(F.col("v")).alias("i"), numeric.to_float(F.col("v")).alias("f")).collect()
    assert [row["i"] for row in rows] == [2147483647, None, 5] + [None] * 6 + [12, None, None]
    large = 2.0**31
    assert [row["f"] for row in rows] == [large, large, 5.0, None, 1.5, 0.5, 2.0, None, None, 12.0, None, None]


def test_fused_profile_agrees_with_single_findings(spark):
    rows = [(" a$ ", "$5", "2024-01-02", 1), ("b", "$$6$", "x", None), ("#", "", None, 3), (None, "7", "", 4)]
    df = spark.createDataFrame(rows, "t string, p string, d string, n int")
    config = CurationConfig.of(valid_spl_chars={"$": [1, "p"]}, composite_keys=["t", "n"])
    fused = by_column(profile.profile(df, config))
    assert set(fused) == {"t", "p", "d", "n", profile.COMPOSITE}
    assert {row["rows"] for row in fused.values()} == {4}
    assert fused["t"]["padded_rows"] == 1 and fused["t"]["special_rows"] == 2
    assert fused["t"]["empty_rows"] == 1 and fused["t"]["filled_rows"] == 2
    assert fused["p"]["special_rows"] == 1 and fused["p"]["empty_rows"] == 1
    assert fused["p"]["integer_rows"] == 1
    assert fused["d"]["date_rows"] == 1 and fused["n"]["non_null"] == 3
    assert fused[profile.COMPOSITE]["filled_rows"] == 4
    assert by_column(profile.special_characters(df, config))["p"]["rows"] == 1
    assert by_column(profile.detect(df))["d"]["date_rows"] == 1


def test_profile_is_one_scan_and_one_small_shuffle(spark, tmp_path):
    df = spark.createDataFrame([("a", "b", 1)], "x string, y string, n int")
    df.write.parquet(str(tmp_path / "t"))
    source = spark.read.parquet(str(tmp_path / "t"))
    plan = profile.profile(source, CurationConfig())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "partial_count" in plan and "BatchEvalPython" not in plan
    plan = profile.detect(source.select("x"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<x:string>" in plan


def test_sampled_detection(spark):
    df = spark.range(50).select(F.lit("2024-01-01").alias("d"))
    assert profile.detect(df.select(F.lit(1).alias("n"))).count() == 0
