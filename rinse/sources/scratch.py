"""New folders in the store that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _of_this_process() -> str:
    return tempfile.mkdtemp(prefix="rinse-")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir.

    Where the setting is missing, a temporary folder of this process takes its place if all executors are in it, as in
    tests; on a cluster that is an error, because executors would write to folders of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _of_this_process()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
