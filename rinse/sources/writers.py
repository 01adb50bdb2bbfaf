"""Writing the curated table and the audit."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rinse.functions.expressions import column

# Folders and clock format of the output layout.
_OUTPUT, _LOG = "output", "logfile"
_CLOCK = "%Y/%m/%d/%H/%M_%S"


def _stem(source: str) -> str:
    return posixpath.splitext(posixpath.basename(source.rstrip("/")))[0]


def output_path(folder: str, source: str, now: datetime) -> str:
    return posixpath.join(folder, _OUTPUT, now.strftime(_CLOCK) + _stem(source))


def log_path(folder: str, source: str, now: datetime) -> str:
    return posixpath.join(folder, _LOG, now.strftime(_CLOCK) + "_" + _stem(source))


def write_parquet(
    df: DataFrame, path: str, overwrite: bool = False, settings: Mapping[str, str] | None = None
) -> None:
    mode = "overwrite" if overwrite else "errorifexists"
    df.write.mode(mode).options(**(settings or {})).parquet(path)


def write_csv(
    df: DataFrame,
    path: str,
    single_file: bool = False,
    overwrite: bool = False,
    settings: Mapping[str, str] | None = None,
) -> None:
    """Headered CSV, one file per partition unless a single file is asked for.

    A single file is written by a single task; it is meant for small results
    such as the audit. Values are written as they are, outer spaces included. A line
    break would split its row on reading, so a value that holds one fails the write.
    """
    mode = "overwrite" if overwrite else "errorifexists"
    rows = _one_line_each(df)
    rows = rows.coalesce(1) if single_file else rows
    rows.write.mode(mode).options(header=True, **_AS_IT_IS, **(settings or {})).csv(path)


_AS_IT_IS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _one_line_each(df: DataFrame) -> DataFrame:
    error = F.raise_error(F.lit("a line break can't be kept in a CSV file"))
    return df.select(
        [
            F.when(column(f.name).rlike(r"[\r\n]"), error).otherwise(column(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else column(f.name)
            for f in df.schema
        ]
    )


def write_csv_file(
    df: DataFrame, path: str, overwrite: bool = False, settings: Mapping[str, str] | None = None
) -> None:
    """One headered CSV file, written by as many tasks as the rows have.

    Tasks write parts without a header to a folder beside ``path``, which are then joined in their order
    behind the header. A file system that can concatenate files does so without moving a byte; for any other
    one the parts are copied one after the other, as a single file has a single writer there. The file
    appears under its name when it is complete. Values are written as by ``write_csv``.
    """
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    conf = hadoop.conf.Configuration(spark.sparkContext._jsc.hadoopConfiguration())
    for key, value in {**_session_settings(spark), **(settings or {})}.items():
        conf.set(key, value)
    to = hadoop.fs.Path(path)
    files = to.getFileSystem(conf)
    if files.exists(to) and not overwrite:
        raise FileExistsError(f"PATH_ALREADY_EXISTS: {path}")
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    try:
        names = spark.createDataFrame([tuple(df.columns)], ", ".join(f"c{i} string" for i in range(len(df.columns))))
        for rows, folder in ((names.coalesce(1), "header"), (_one_line_each(df), "rows")):
            rows.write.options(header=False, **_AS_IT_IS, **(settings or {})).csv(f"{parts}/{folder}")
        found = [
            status.getPath()
            for folder in ("header", "rows")
            for status in sorted(files.listStatus(hadoop.fs.Path(f"{parts}/{folder}")), key=lambda x: x.getPath().getName())
            if status.getPath().getName().startswith("part-") and status.getLen()
        ]
        whole = hadoop.fs.Path(f"{parts}/whole")
        if files.hasPathCapability(whole, "fs.capability.paths.concat"):
            files.rename(found[0], whole)
            if found[1:]:
                paths = spark.sparkContext._gateway.new_array(hadoop.fs.Path, len(found) - 1)
                for k, part in enumerate(found[1:]):
                    paths[k] = part
                files.concat(whole, paths)
        else:
            out = files.create(whole)
            try:
                for part in found:
                    source = files.open(part)
                    try:
                        hadoop.io.IOUtils.copyBytes(source, out, conf, False)
                    finally:
                        source.close()
            finally:
                out.close()
        if overwrite and files.exists(to):
            files.delete(to, True)
        files.mkdirs(to.getParent())
        if not files.rename(whole, to):
            raise OSError(f"{whole} could not be renamed to {path}")
    finally:
        files.delete(hadoop.fs.Path(parts), True)


def _session_settings(spark: SparkSession) -> dict[str, str]:
    """What the session sets for file systems, as Spark's own readers and writers see it."""
    return {key: value for key, value in spark.conf.getAll.items() if key.startswith("fs.")}
