"""Column references that keep the exact name, whatever characters it has."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
