from __future__ import annotations

from datetime import datetime

import pytest

from rinse.plans.curate import curate
from rinse.sources import readers, writers


def test_schemes():
    assert readers.resolve("/data/a.csv") == ("/data/a.csv", {})
    assert readers.resolve("hdfs://h/a.csv") == ("hdfs://h/a.csv", {})
    keys = {"access_key": "id", "secret_key": "hidden"}
    assert readers.resolve("s3://bucket/a.csv", aws_s3=keys) == (
        "s3a://bucket/a.csv", {"fs.s3a.access.key": "id", "fs.s3a.secret.key": "hidden"})
    assert readers.resolve("s3a://bucket/a.csv") == ("s3a://bucket/a.csv", {})
    blob = {"storage_account_name": "acc", "storage_account_key": "hidden", "container_name": "box"}
    assert readers.resolve("in/a.csv", azure_blob=blob) == (
        "wasbs://box@acc.blob.core.windows.net/in/a.csv",
        {"fs.azure.account.key.acc.blob.core.windows.net": "hidden"})
    for path in (None, ""):
        with pytest.raises(ValueError, match="no path"):
            readers.resolve(path)
    with pytest.raises(ValueError, match="shared file system"):
        readers.resolve("https://host/a.csv")


def test_every_column_is_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A,a, b ,\n1,"",x ,2\n')
    df = readers.read_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["A0", "a1", " b ", "_c3"]
    assert {kind for _, kind in df.dtypes} == {"string"}
    assert tuple(df.first()) == ("1", None, "x ", "2")


def test_layout():
    now = datetime(2024, 1, 2, 3, 4, 5)
    assert writers.output_path("/out", "s3a://b/in/people.csv", now) == "/out/output/2024/01/02/03/04_05people"
    assert writers.log_path("/log/", "people.csv.gz", now) == "/log/logfile/2024/01/02/03/04_05_people.csv"


def test_written_tables_come_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "n int, t string")
    writers.write_parquet(df, str(tmp_path / "p"))
    assert sorted(spark.read.parquet(str(tmp_path / "p")).collect()) == sorted(df.collect())
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_parquet(df, str(tmp_path / "p"))
    writers.write_parquet(df.limit(1), str(tmp_path / "p"), overwrite=True)
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1
    writers.write_csv(df.repartition(2), str(tmp_path / "c"), single_file=True)
    assert len(list((tmp_path / "c").glob("*.csv"))) == 1
    assert sorted(map(tuple, readers.read_csv(spark, str(tmp_path / "c")).collect())) == [("1", "a,b"), ("2", None)]


def test_csv_keeps_outer_spaces_and_refuses_line_breaks(spark, tmp_path):
    rows = spark.createDataFrame([(" a ", 1), ("b", None)], "s string, n int")
    writers.write_csv(rows, str(tmp_path / "out"))
    back = readers.read_csv(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted([(" a ", "1"), ("b", None)], key=repr)
    with pytest.raises(Exception, match="line break"):
        writers.write_csv(spark.createDataFrame([("a\nb",)], "s string"), str(tmp_path / "bad"))


def test_keys_serve_outputs():
    keys = {"access_key": "id", "secret_key": "hidden", "session_token": "t", "endpoint": "https://s3.example"}
    settings = readers.storage_settings(keys)
    assert settings == {
        "fs.s3a.access.key": "id", "fs.s3a.secret.key": "hidden",
        "fs.s3a.session.token": "t", "fs.s3a.endpoint": "https://s3.example"}
    assert readers.resolve("s3://b/in.csv", aws_s3=keys) == ("s3a://b/in.csv", settings)
    assert readers.spark_uri("s3://b/out") == "s3a://b/out" and readers.spark_uri("/out") == "/out"
    blob = {"storage_account_name": "acc", "storage_account_key": "k", "container_name": "box"}
    assert readers.storage_settings(None, blob) == {"fs.azure.account.key.acc.blob.core.windows.net": "k"}
    with pytest.raises(ValueError, match="secret_key"):
        readers.storage_settings({"access_key": "id"})


def test_curated_table_as_csv(spark, tmp_path):
    df = spark.createDataFrame([("1", " a "), ("1", " a "), ("2", "b!")], "id string, v string")
    found = curate(df, output_folder=str(tmp_path), output_format="csv")
    assert sorted(map(tuple, found.df.collect())) == [(1, "a"), (2, "b")]
    assert "v" in spark.read.option("header", True).csv(found.output_path).columns
    with pytest.raises(ValueError, match="neither"):
        curate(df, output_folder=str(tmp_path), output_format="orc")


def folder_of(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_files_are_read_by_their_own_header(spark, tmp_path):
    path = folder_of(tmp_path, a="id,name\n1,x\n", b='"name",id\nz,3\n', c="\n\nid,name\r\n4,w\r\n", d="")
    df = readers.read_csv(spark, path)
    assert df.columns == ["id", "name"]
    assert sorted(map(tuple, df.collect())) == [("1", "x"), ("3", "z"), ("4", "w")]
    assert sorted(r["name"] for r in readers.read_csv(spark, path, malformed="line").select("name").collect()) == ["w", "x", "z"]


def test_names_of_files_may_hold_pattern_characters(spark, tmp_path):
    folder = tmp_path / "in {1} [2]"
    folder.mkdir()
    (folder / "a b%20*.csv").write_text("id,name\n1,x\n")
    (folder / "c?.csv").write_text("name,id\nz,3\n")
    df = readers.read_csv(spark, str(tmp_path / "in*"))
    assert sorted(map(tuple, df.collect())) == [("1", "x"), ("3", "z")]


@pytest.mark.parametrize("other", ["id,nome\n1,2\n", "id\n1\n", "id,name,more\n1,2,3\n"])
def test_files_with_different_names_fail(spark, tmp_path, other):
    with pytest.raises(ValueError, match="different columns"):
        readers.read_csv(spark, folder_of(tmp_path, a="name,id\n1,2\n", b=other))


def test_repeated_names_need_one_order(spark, tmp_path):
    same = readers.read_csv(spark, folder_of(tmp_path, a="x,x,\n1,2,3\n", b="x,x,\n4,5,6\n"))
    assert sorted(map(tuple, same.collect())) == [("1", "2", "3"), ("4", "5", "6")]
    with pytest.raises(ValueError, match="repeated"):
        readers.read_csv(spark, folder_of(tmp_path, c="y,x,x\n1,2,3\n", a="x,x,y\n1,2,3\n", b="x,x,y\n1,2,3\n"))


def test_large_files_are_not_read_for_their_header(spark, tmp_path):
    rows = "".join(f"{i},{'v' * 200}\n" for i in range(100_000))
    path = folder_of(tmp_path, a="id,name\n" + rows, b="name,id\n" + rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        assert readers.read_csv(spark, path).count() == 200_000
        text = spark.read.text(path)
        about = ["value", "_metadata.file_path", "_metadata.file_block_start as start", "_metadata.file_block_length as length", "_metadata.file_size as size"]
        seen = text.selectExpr(*about).mapInArrow(_counted, "line string, file string")
        assert max(int(r["line"]) for r in seen.collect()) <= 10_000  # one batch of a task's rows
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _counted(batches):
    """What the search for first lines takes from its input, in rows."""
    import pyarrow as pa

    taken = 0

    def counting():
        nonlocal taken
        for batch in batches:
            taken += batch.num_rows
            yield batch

    list(readers._first_lines(counting()))
    yield pa.RecordBatch.from_arrays([pa.array([str(taken)]), pa.array([""])], names=["line", "file"])


def test_rows_with_other_numbers_of_fields(spark, tmp_path):
    path = folder_of(tmp_path, a='a,b\n1,2\n3,4,5\n6\n"7,8",9\n"7,8",9,\n', b="b,a\n1,2,3\n")
    df = readers.read_csv(spark, path, malformed="line")
    found = {r["line"]["line"]: (r["a"], r["b"], r["line"]["more"]) for r in df.where("line is not null").collect()}
    assert found == {
        "3,4,5": ("3", "4", True), "6": ("6", None, False), '"7,8",9,': ("7,8", "9", True),
        "1,2,3": ("2", "1", True)}
    assert df.count() == 6 and len(df.where("line is null").collect()) == 2
    with pytest.raises(ValueError, match="of its own"):
        readers.read_csv(spark, path, malformed="B")


def test_one_csv_file(spark, tmp_path):
    df = spark.range(1000).selectExpr("id as `n, o`", "case when id % 3 = 0 then null else concat(' \"x\", ', id) end as t")
    path = tmp_path / "deep" / "out.csv"
    writers.write_csv_file(df.repartition(6).sortWithinPartitions("n, o"), str(path))
    assert path.is_file() and sorted(x.name for x in path.parent.iterdir() if not x.name.startswith(".")) == ["out.csv"]
    assert path.read_text().splitlines()[0] == '"n, o",t'
    want = sorted((str(r[0]), r[1]) for r in df.collect())
    assert sorted(map(tuple, readers.read_csv(spark, str(path)).collect())) == want
    with pytest.raises(FileExistsError, match="ALREADY_EXISTS"):
        writers.write_csv_file(df, str(path))
    writers.write_csv_file(df.limit(0), str(path), overwrite=True)
    assert path.read_text() == '"n, o",t\n'
    with pytest.raises(Exception, match="line break"):
        writers.write_csv_file(spark.createDataFrame([("a\nb",)], "s string"), str(tmp_path / "bad.csv"))
    assert not [x for x in tmp_path.iterdir() if "bad" in x.name]


def test_curated_table_as_one_csv_file(spark, tmp_path):
    df = spark.createDataFrame([("1", " a "), ("1", " a "), ("2", "b!")], "id string, v string")
    found = curate(df, output_folder=str(tmp_path), output_format="csv file")
    assert sorted(map(tuple, found.df.collect())) == [(1, "a"), (2, "b")]
    assert found.output_path.endswith("table.csv") and open(found.output_path).readline() == "id,v\n"


def test_preview_of_a_raw_file(spark, tmp_path):
    path = folder_of(tmp_path, a="A b,c!\n 1,x\n2,\n3,z\n") + "/a.csv"
    rows = readers.preview_csv(spark, path, 2)
    assert rows.columns == ["A b", "c!"] and list(map(tuple, rows.collect())) == [(" 1", "x"), ("2", None)]
    assert readers.preview_csv(spark, path, 9).count() == 3
