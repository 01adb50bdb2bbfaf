"""Small helpers around column references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """The column called ``name``, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")
