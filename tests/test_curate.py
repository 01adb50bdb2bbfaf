from __future__ import annotations

import os
import subprocess
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rinse.operators.profile import COMPOSITE
from rinse.plans import plan as planning
from rinse.plans.config import CurationConfig
from rinse.plans.curate import curate, curate_data, learn
from rinse.plans.plan import CurationPlan

EMPLOYEES = """EMPLOYEE_ID,First  Name,LAST_NAME!,,HIRE_DATE,SALARY,seen at,,rate
1, Ann ,O'Neil,,03/04/2024,$1200#,2024-01-02 10:00:00,,1.5
1, Ann ,O'Neil,,03/04/2024,$1200#,2024-01-02 10:00:00,,1.5
2,Bob,"#Lee",,13/25/2024,$900,2024/01/02 11:00:00.123456,z,2.25
3,"",,,2024-31-01,800$,2024-01-02T10:00:00+02:00,,
"""
CONFIG = dict(
    primary_key="EMPLOYEE_ID",
    composite_keys=["First  Name", "LAST_NAME!"],
    valid_spl_chars={"$": [1, "SALARY"]},
    outputtz="America/New_York",
)
CURATED = [
    (1, "Ann", "ONeil", date(2024, 4, 3), "$1200", datetime(2024, 1, 2, 5), None, 1.5),
    (2, "Bob", "Lee", None, "$900", datetime(2024, 1, 2, 6, 0, 0, 123000), "z", 2.25),
    (3, None, None, date(2024, 1, 31), "800", datetime(2024, 1, 2, 3), None, None),
]


@pytest.fixture
def employees(tmp_path):
    path = tmp_path / "employees.csv"
    path.write_text(EMPLOYEES)
    return str(path)


def entries(result):
    return {(r["rule"], r["column"]): r["rows_affected"] for r in result.audit.collect()}


def test_employees(spark, employees):
    result = curate_data(employees, spark=spark, **CONFIG)
    assert [name for name, _ in result.df.dtypes] == [
        "employee_id", "first_name", "last_name", "hire_date", "salary", "seen_at", "unnamed_7", "rate"]
    assert [kind for _, kind in result.df.dtypes] == [
        "int", "string", "string", "date", "string", "timestamp_ntz", "string", "float"]
    assert sorted(map(tuple, result.df.collect())) == CURATED
    found = entries(result)
    assert found[("dropped", "unnamed_3")] is None and found[("unnamed", "unnamed_7")] is None
    assert found[("space", "first_name")] == 2
    assert found[("special", "last_name")] == 3
    assert found[("placement", "salary")] == 3
    assert found[("date", "hire_date")] == 3 and found[("unparsed", "hire_date")] == 1
    assert found[("timestamp", "seen_at")] == 4
    assert found[("integer", "employee_id")] == 4 and found[("float", "rate")] == 3
    assert found[("primary key", "employee_id")] == 0
    assert found[("composite key", "first_name, last_name")] == 1
    assert found[("duplicates", "employee_id")] == 1
    audit = result.audit.collect()
    assert result.audit.columns[:3] == ["Timestamp", "Cleansing Part", "Message"]
    parts = [r["Cleansing Part"] for r in audit]
    assert parts == sorted(parts, reverse=True)
    order = list(dict.fromkeys(r["rule"] for r in audit if r["Cleansing Part"] == "Data"))
    assert order == ["space", "special", "placement", "date", "unparsed", "timestamp", "integer",
                     "float", "primary key", "composite key", "duplicates"]


def test_written_output(spark, employees, tmp_path):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    result = curate_data(employees, log, out, spark=spark, **CONFIG)
    assert result.output_path.startswith(out + "/output/") and result.output_path.endswith("employees")
    assert result.log_path.startswith(log + "/logfile/") and result.log_path.endswith("_employees")
    assert sorted(map(tuple, spark.read.parquet(result.output_path).collect())) == CURATED
    logged = spark.read.option("header", True).csv(result.log_path)
    assert logged.count() == result.audit.count()
    assert entries(result)[("duplicates", "employee_id")] == 1


def test_guards(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("a,b\n")
    (tmp_path / "nameless.csv").write_text(",\n1,2\n")
    for name, message in (("empty", "empty"), ("header", "no rows"), ("nameless", "all headers")):
        with pytest.raises(ValueError, match=message):
            curate_data(str(tmp_path / f"{name}.csv"), spark=spark)
    with pytest.raises(ValueError, match="do not exist"):
        curate(spark.range(1), CurationConfig(primary_key="nope"))


def test_clean_table_needs_nothing(spark):
    df = spark.createDataFrame([("ab", 1), ("cd", 2)], "a string, n int")
    result = curate(df)
    assert sorted(map(tuple, result.df.collect())) == [("ab", 1), ("cd", 2)]
    assert [(r["Cleansing Part"], r["rule"]) for r in result.audit.collect()] == [
        ("Header", "none"), ("Data", "primary key"), ("Data", "composite key"), ("Data", "duplicates")]


def jobs(spark, work):
    group = f"group {id(work)}"
    spark.sparkContext.setJobGroup(group, group)
    work()
    count = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("none", "none")
    return count


def test_number_of_jobs_does_not_depend_on_columns(spark, tmp_path):
    def run(columns):
        row = {f"Col {i}": " x#" if i % 3 else "03/04/2024" for i in range(columns)}
        path = tmp_path / f"t{columns}"
        spark.createDataFrame([row | {"Id": str(k)} for k in range(20)]).write.option(
            "header", True).csv(str(path))
        out = str(tmp_path / f"o{columns}")
        return jobs(spark, lambda: curate_data(str(path), primary_key="Id", spark=spark, output_file_path=out))

    assert run(4) == run(60) < 12


def test_very_wide_table(spark):
    columns = {f"c{i}": ["1", " a$", "2024-01-02", "1.5"][i % 4] for i in range(160)}
    df = spark.createDataFrame([tuple(columns.values())] * 3, list(columns))
    result = curate(df)
    assert result.df.count() == 1
    kinds = [p.kind for p in result.plan.columns[:4]]
    assert kinds == [planning.INTEGER, planning.TEXT, planning.DATE, planning.FLOAT]


def test_plan_is_data_and_fits_later_batches(spark, employees):
    plan = curate_data(employees, spark=spark, **CONFIG).plan
    again = CurationPlan.from_json(plan.to_json())
    assert again == plan
    source = spark.read.option("header", True).csv(employees)
    moved = source.select(*[f"`{name}`" for name in reversed(source.columns)])
    by_position = planning.apply(source, again).distinct()
    by_name = planning.apply(moved, again).distinct()
    assert sorted(map(tuple, by_position.collect())) == CURATED
    assert sorted(map(tuple, by_name.collect())) == CURATED
    with pytest.raises(ValueError, match="does not fit"):
        planning.apply(source.drop("rate"), again)


def test_applying_a_plan_starts_no_job(spark, employees):
    plan = curate_data(employees, spark=spark, **CONFIG).plan
    source = spark.read.option("header", True).csv(employees)
    assert jobs(spark, lambda: planning.apply(source, plan)) == 0


def test_each_rule_is_evaluated_once(spark, employees):
    plan = curate_data(employees, spark=spark, **CONFIG).plan
    source = spark.read.option("header", True).csv(employees)
    physical = planning.apply(source, plan)._jdf.queryExecution().executedPlan().toString()
    assert physical.count("[^0-9/\\-]") == 1, "stripping a date must not be repeated per format"
    assert "Exchange" not in physical and "BatchEvalPython" not in physical


def test_plan_applies_to_a_stream(spark, employees, tmp_path):
    plan = curate_data(employees, spark=spark, **CONFIG).plan
    source = spark.read.option("header", True).csv(employees)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(EMPLOYEES)
    stream = spark.readStream.schema(source.schema).option("header", True).csv(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    query = (
        planning.apply(stream, plan).writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(out)
    )
    assert query.awaitTermination(120)
    assert sorted(set(map(tuple, spark.read.parquet(out).collect()))) == CURATED


def test_curating_twice_changes_nothing(spark):
    df = spark.createDataFrame(
        [(" a$b ", "#1", "x;y!"), ("-", "2$", "z"), ("", "3", None)], "t string, p string, q string")
    config = CurationConfig.of(valid_spl_chars={"#": [1, "p"]})
    once = curate(df, config).df
    twice = curate(once, config).df
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_composite_key_with_a_date_part(spark):
    df = spark.createDataFrame(
        [("2024-01-02", "a"), ("2024-99-99", ""), ("zz", "b")], "d string, t string")
    learned = learn(df, CurationConfig(composite_keys=("d", "t")))
    plan, counts = learned.plan, learned.counts
    assert plan.of_kind(planning.DATE) == ["d"]
    # The second row's date is none and its text is empty, so no part of the key is left.
    assert counts[COMPOSITE]["rows"] - counts[COMPOSITE]["filled_rows"] == 1


def test_dates_overrule_placement(spark):
    df = spark.createDataFrame([("$2024-01-02",), ("2024-01-03",)], "d string")
    result = curate(df, CurationConfig.of(valid_spl_chars={"$": ["d"]}))
    assert sorted(r["d"] for r in result.df.collect()) == [date(2024, 1, 2), date(2024, 1, 3)]
    assert ("placement", "d") in entries(result)


def test_share_of_matches(spark):
    df = spark.createDataFrame([("2024-01-02",), ("text",), ("more",)], "d string")
    assert curate(df).plan.columns[0].kind == planning.DATE
    assert curate(df, CurationConfig(min_match_ratio=0.5)).plan.columns[0].kind == planning.TEXT


def test_typed_columns(spark):
    df = spark.sql("""
        select date'2024-01-02' as d, timestamp_ntz'2024-01-02 10:00:00.123456' as ntz,
               to_timestamp('2024-01-02 10:00:00') as ts, 1.5d as x, array('a$') as a, true as b""")
    row = curate(df, CurationConfig(output_tz="Asia/Tokyo", primary_key="d")).df.first()
    assert row["d"] == date(2024, 1, 2)
    assert row["ntz"] == datetime(2024, 1, 2, 19, 0, 0, 123456)
    assert row["ts"] == datetime(2024, 1, 2, 19)
    assert (row["x"], row["a"], row["b"]) == (1.5, ["a$"], True)
    same = curate(df, CurationConfig(primary_key="d")).df
    assert same.select("ntz", "ts").collect() == df.select("ntz", "ts").collect()
    assert same.schema["ts"].dataType == df.schema["ts"].dataType


def test_later_values_that_are_no_numbers_become_null(spark):
    plan = curate(spark.createDataFrame([("1.5", "1")], "f string, i string")).plan
    later = [("7d", "7"), ("nan", "x1"), ("1e3", "3.7"), ("Infinity", "99999999999"), ("7", "8")]
    got = planning.apply(spark.createDataFrame(later, "f string, i string"), plan).collect()
    assert [tuple(r) for r in got] == [(None, 7), (None, None), (None, None), (None, None), (7.0, 8)]


def test_survivor_order(spark):
    df = spark.createDataFrame([("1", "old", "1"), ("1", "new", "0")], "id string, v string, age string")
    config = CurationConfig(primary_key="id", order_by=("age",))
    assert curate(df, config).df.first()["v"] == "new"


def test_signs_need_a_placement_rule(spark):
    df = spark.createDataFrame([("-5.25",), ("+7.5",)], "lat string")
    assert sorted(r[0] for r in curate(df).df.collect()) == [5.25, 7.5]
    kept = curate(df, CurationConfig.of(valid_spl_chars={"+/-": [4, "lat"]})).df
    assert sorted(r[0] for r in kept.collect()) == ["+7.5", "-5.25"]


def test_unrelated_names_stay_apart(spark):
    df = spark.createDataFrame([("a", "b", 1)], "`X!` string, `x` string, `n n` int")
    result = curate(df.withColumn("x.y", F.lit("c")))
    assert result.df.columns == ["x", "x_2", "n_n", "xy"]
    assert ("collision", "x_2") in entries(result)


def test_malformed_rows_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Id,When,V\n1,2024-01-02,a\n2,03/04/2024,b,extra\n3,2024-01-03\n"4",2024-01-04,"d, e",\n1,2024-01-02,a\n')
    out = str(tmp_path / "out")
    for folder in (None, out):
        result = curate_data(str(tmp_path / "a.csv"), primary_key="Id", spark=spark, output_file_path=folder)
        assert sorted(map(tuple, result.df.collect())) == [(1, date(2024, 1, 2), "a"), (3, date(2024, 1, 3), None)]
        assert result.malformed.columns[:3] == ["Id", "When", "V"]
        assert sorted(map(tuple, result.malformed.collect())) == [
            ("2", "03/04/2024", "b", "2,03/04/2024,b,extra"), ("4", "2024-01-04", "d, e", '"4",2024-01-04,"d, e",')]
        found = entries(result)
        assert (found[("malformed", None)], found[("short", None)], found[("duplicates", "id")]) == (2, 1, 1)
        # What is kept apart counts nowhere else: all dates that are left are ISO.
        assert result.plan.columns[1].iso and ("date", "when") not in found
        assert found[("integer", "id")] == 3 and found[("primary key", "id")] == 0
    clean = tmp_path / "b.csv"
    clean.write_text("a,b\n1,2\n")
    result = curate_data(str(clean), spark=spark)
    assert result.malformed.count() == 0 and not {r for r, _ in entries(result)} & {"malformed", "short"}
    (tmp_path / "c.csv").write_text("a,b\n1,2,3\n")
    with pytest.raises(ValueError, match="no rows"):
        curate_data(str(tmp_path / "c.csv"), spark=spark)
    with pytest.raises(ValueError, match="last column"):
        curate(spark.range(1), malformed="x")


def test_iso_columns_skip_the_second_pass(spark):
    rows = [("2024-01-02", "2024-01-02T10:00:00Z", "1"), ("2024-02-30", "2024-01-02 10:00:00+02:00", "2"), (None, None, "3")]
    df = spark.createDataFrame([rows[0], rows[2]], "d string, t string, n string")
    config = CurationConfig(primary_key="n", output_tz="Asia/Tokyo")
    plan = []
    one_pass = jobs(spark, lambda: plan.append(learn(df, config).plan))
    assert [(p.kind, p.iso) for p in plan[0].columns[:2]] == [(planning.DATE, True), (planning.TIMESTAMP, True)]
    both = spark.createDataFrame(rows, "d string, t string, n string")
    assert jobs(spark, lambda: plan.append(learn(both, config).plan)) > one_pass
    assert [(p.kind, p.iso) for p in plan[1].columns[:2]] == [(planning.DATE, False), (planning.TIMESTAMP, True)]
    result = curate(df, config)
    assert sorted(map(tuple, result.df.collect()), key=repr) == [(None, None, 3), (date(2024, 1, 2), datetime(2024, 1, 2, 19), 1)]
    assert entries(result)[("timestamp", "t")] == 1 and ("date", "d") not in entries(result)
    same = curate(both, CurationConfig(primary_key="n"))
    assert entries(same)[("timestamp", "t")] == 2  # both carry a zone of their own
    # Later values that are not ISO are repaired as in any other date column.
    later = spark.createDataFrame([("on 03/04/2024", "at 2024/01/02 10:00:00", "7")], "d string, t string, n string")
    again = CurationPlan.from_json(plan[0].to_json())
    assert tuple(planning.apply(later, again).first()) == (date(2024, 4, 3), datetime(2024, 1, 2, 19), 7)


def test_duplicates_are_counted_by_the_one_write(spark, tmp_path):
    df = spark.createDataFrame([(str(i % 7), f" {i % 7}") for i in range(50)], "id string, v string").repartition(3)
    learning = jobs(spark, lambda: learn(df, CurationConfig(primary_key="id")))
    kept = []
    config = CurationConfig(primary_key="id")
    runs = [lambda folder=folder: kept.append(curate(df, config, output_folder=folder)) for folder in (None, str(tmp_path / "out"))]
    for run in runs:
        # Beyond the profile: the given rows' own shuffle, that by the key, and the write.
        assert jobs(spark, run) <= learning + 3
        assert entries(kept[-1])[("duplicates", "id")] == 43 and kept[-1].df.count() == 7
    # What curation returns is read from files: neither cleaned nor shuffled again.
    plan = kept[0].df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "regexp" not in plan


def test_without_a_shared_folder(spark, tmp_path):
    """A process of its own, as Spark's settings can't be taken back in this one."""
    (tmp_path / "conf").mkdir()
    code = (
        "from pyspark.sql import SparkSession\n"
        "from rinse import curate\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
        "print(curate(s.createDataFrame([('1', ' a')] * 2, 'id string, v string')).df.collect())\n"
    )
    environment = {**os.environ, "SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": os.pathsep.join(sys.path)}
    done = subprocess.run([sys.executable, "-c", code], env=environment, capture_output=True, text=True, timeout=300)
    assert "Row(id=1, v='a')" in done.stdout, done.stderr[-2000:]
