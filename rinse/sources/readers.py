"""Reading headered CSV from any file system Spark reaches."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rinse.functions.expressions import column


#: What curation calls the column of rows that have not as many fields as the header.
MALFORMED = "<malformed row>"


def resolve(
    path: str | None,
    aws_s3: Mapping[str, str] | None = None,
    azure_blob: Mapping[str, str] | None = None,
) -> tuple[str, dict[str, str]]:
    """The URI to read and the file-system settings that go with it.

    ``aws_s3`` holds access_key and secret_key, and may hold session_token and endpoint.
    The settings are options of single reads and writes; nothing is set on the session.
    """
    if not path:
        raise ValueError("no path given")
    scheme = urlparse(path).scheme
    if scheme in ("http", "https"):
        raise ValueError(f"{path}: copy the file to a shared file system first, then read it there")
    if scheme in ("s3", "s3a"):
        return "s3a" + path[len(scheme):], s3_settings(aws_s3)
    if azure_blob is not None:
        host = azure_blob["storage_account_name"] + ".blob.core.windows.net"
        uri = f"wasbs://{azure_blob['container_name']}@{host}/{path.lstrip('/')}"
        return uri, {f"fs.azure.account.key.{host}": azure_blob["storage_account_key"]}
    return path, {}


def s3_settings(aws_s3: Mapping[str, str] | None) -> dict[str, str]:
    names = {
        "access_key": "fs.s3a.access.key",
        "secret_key": "fs.s3a.secret.key",
        "session_token": "fs.s3a.session.token",
        "endpoint": "fs.s3a.endpoint",
    }
    missing = [key for key in ("access_key", "secret_key") if aws_s3 and key not in aws_s3]
    if missing:
        raise ValueError(f"aws_s3 lacks {missing}")
    return {name: aws_s3[key] for key, name in names.items() if aws_s3 and key in aws_s3}


def storage_settings(
    aws_s3: Mapping[str, str] | None = None, azure_blob: Mapping[str, str] | None = None
) -> dict[str, str]:
    """The settings of all storage that keys are given for; what a path does not need is ignored."""
    azure = resolve("any", azure_blob=azure_blob)[1] if azure_blob else {}
    return s3_settings(aws_s3) | azure


def spark_uri(folder: str) -> str:
    """The folder under the scheme that Spark knows it by."""
    return "s3a" + folder[2:] if urlparse(folder).scheme == "s3" else folder


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(line, file) of each file that begins in a task: its first line that is not blank."""
    last = None
    for batch in batches:
        rows = zip(*[batch.column(name).to_pylist() for name in ("value", "file_path", "start", "length", "size")])
        for value, file, start, length, size in rows:
            if file != last and start == 0 and value.strip():
                last = file
                yield pa.RecordBatch.from_arrays([pa.array([value]), pa.array([file])], names=["line", "file"])
            # A split that is not the last of its file fills a task, so no other file follows.
            if start + length < size and (last == file or start > 0):
                return


def _first_lines_of(reader: DataFrameReader, uri: str) -> DataFrame | None:
    """The first line of each file, or None where there is one file only."""
    lines = reader.text(uri)
    if len(lines.inputFiles()) < 2:
        return None
    about = [F.col(f"_metadata.file_{x}").alias(to) for x, to in (("block_start", "start"), ("block_length", "length"), ("size", "size"))]
    return lines.select("value", "_metadata.file_path", *about).mapInArrow(_first_lines, "line string, file string")


@dataclass(frozen=True)
class _Order:
    """Files with their columns in one order: the names, one of the files, and the first lines the files begin with."""

    names: tuple[str | None, ...]
    sample: str
    lines: tuple[str, ...]
    files: int


def _orders(spark: SparkSession, settings: Mapping[str, str], first_lines: DataFrame) -> list[_Order]:
    """The orders of columns that occur, that of the first file by name in front."""
    groups = first_lines.groupBy("line").agg(F.min("file").alias("sample"), F.count(F.lit(1)).alias("files"))
    found: dict[tuple, _Order] = {}
    heads = sorted(groups.collect(), key=lambda row: row["sample"])
    for row in heads if len(heads) > 1 else []:
        # A name may hold what a path pattern gives a meaning to.
        sample = re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(row["sample"]))
        names = tuple(spark.read.options(**settings).csv(sample).first() or ())
        old = found.get(names)
        found[names] = _Order(
            names, old.sample if old else sample, (*(old.lines if old else ()), row["line"]), row["files"] + (old.files if old else 0)
        )
    orders = list(found.values())
    for other in orders[1:]:
        if sorted(orders[0].names, key=str) != sorted(other.names, key=str):
            missing = sorted(set(map(str, orders[0].names)) ^ set(map(str, other.names)))
            raise ValueError(f"{orders[0].sample} and {other.sample} have different columns: {missing or 'repeated names'}")
        if None in other.names or len(set(other.names)) < len(other.names):
            raise ValueError(f"{orders[0].sample} and {other.sample} have missing or repeated names in different orders")
    return orders


def has_more_fields(line: Column, count: int) -> Column:
    """Whether a line of CSV has more than so many fields; a comma between quotes separates none."""
    bare = F.regexp_replace(line, r'(?<=^|,)\s*"(?:[^"\\]|\\.|"")*"\s*(?=,|$)', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) >= count


def _rows(spark: SparkSession, settings: Mapping[str, str], uri: str, sample: str, malformed: str | None) -> DataFrame:
    """The rows at `uri` under the header of `sample`."""
    reader = spark.read.options(**settings).option("header", True)
    schema = reader.csv(sample).schema
    if not malformed or not schema.names:
        return spark.read.options(**settings).option("header", True).schema(schema).csv(uri) if schema.names else reader.csv(uri)
    if malformed.lower() in map(str.lower, schema.names):
        raise ValueError(f"{sample} has a column {malformed!r} of its own")
    line = column(malformed)
    whole = T.StructType([*schema.fields, T.StructField(malformed, T.StringType())])
    # Without all fields the number of fields is not known, so columns are not pruned here.
    read = reader.schema(whole).options(columnNameOfCorruptRecord=malformed, columnPruning=False).csv(uri)
    more = has_more_fields(line, len(schema.names))
    return read.withColumn(malformed, F.when(line.isNotNull(), F.struct(line.alias("line"), more.alias("more"))))


def read_csv(
    spark: SparkSession,
    path: str | None,
    aws_s3: Mapping[str, str] | None = None,
    azure_blob: Mapping[str, str] | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """A headered CSV, or a folder of them, with every column as text.

    Each file is read by its own header, so files may hold the columns in different orders; the result has that of
    the first file by name. Files with different names of columns are a ValueError. Headers are read from the files'
    beginnings; a file that fills a task by itself is not read any further for that.

    `malformed` names one more column: null, or for a row that has not as many fields as its header the whole `line`,
    and whether it has `more` of them. Such a row's fields are in the other columns as far as they go.
    """
    uri, settings = resolve(path, aws_s3, azure_blob)
    first_lines = _first_lines_of(spark.read.options(**settings), uri)
    orders = _orders(spark, settings, first_lines) if first_lines is not None else []
    if len(orders) < 2:
        return _rows(spark, settings, uri, uri, malformed)
    # The files of the most frequent order are those that have no other.
    most = max(orders, key=lambda order: order.files)
    others: list[str] = []
    parts = {}
    for order in orders:
        if order is not most:
            files = [r["file"] for r in first_lines.where(F.col("line").isin(*order.lines)).select("file").collect()]
            others += files
            parts[order] = F.col("_metadata.file_path").isin(*files)
    parts[most] = ~F.col("_metadata.file_path").isin(*others)
    names: list[str] = []
    tables = []
    for order in orders:
        rows = _rows(spark, settings, uri, order.sample, malformed).where(parts[order])
        names = names or rows.columns
        tables.append(rows.select([column(name) for name in names]))
    return reduce(DataFrame.unionByName, tables)


def preview_csv(
    spark: SparkSession,
    path: str | None,
    rows: int = 5,
    aws_s3: Mapping[str, str] | None = None,
    azure_blob: Mapping[str, str] | None = None,
) -> DataFrame:
    """The first rows as they are in the file, before any curation. Tasks start one after the other until there are
    enough rows, so of a large file no more than its beginning is read."""
    uri, settings = resolve(path, aws_s3, azure_blob)
    table = spark.read.options(**settings).option("header", True).csv(uri)
    return spark.createDataFrame(table.head(rows), table.schema)
