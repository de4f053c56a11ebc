"""Column references by exact name.

Source tables can have column names with dots, spaces or backticks (``order date``, ``a.b``).
``F.col("a.b")`` would read a struct field, so every reference to a data column goes through
``col``, which quotes the name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """The top-level column called exactly ``name``."""
    return F.col("`" + name.replace("`", "``") + "`")


def cols(names: list[str]) -> list[Column]:
    return [col(n) for n in names]
