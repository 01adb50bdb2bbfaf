"""Shared folders and tables for the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from rinse.sources.scratch import scratch_folder


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir; without one, an error off `local`."""
    return scratch_folder(spark, name)


#: Fewer rows than this are not worth a task and a file of their own.
_ROWS_A_FILE = 5000


def written(df: DataFrame, name: str, about: int | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts the lineage and fixes the rows.

    Where there are about so many rows, as far as known, few of them are written by few tasks, however many partitions
    the session asks of a shuffle. Tables of many rows are written by as many tasks as without it.
    """
    spark = df.sparkSession
    if about is not None:
        df = df.coalesce(min(tasks(spark), about // _ROWS_A_FILE + 1))
    folder = shared_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextmanager
def smaller_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """What is run inside passes at most so many rows at a time to and from Python workers, as whole texts are large; the
    session's setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    # Not positive means no bound.
    spark.conf.set(name, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tasks(spark: SparkSession) -> int:
    """How many partitions the session asks of a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores behind it as it takes to be no column of `df`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder, as tasks use it, and the path in it."""
    return fs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0] else (fs.LocalFileSystem(), folder)
