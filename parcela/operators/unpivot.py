"""Wide -> long (s17, s18)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wide_to_long(df: DataFrame, ids: Sequence[str], value_cols: Sequence[str], var_name: str,
                 value_name: str, drop_null: bool = True, positive_only: bool = False) -> DataFrame:
    """``unpivot`` with NULL (and optionally non-positive) values dropped."""
    cols = list(value_cols)
    typed = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    long = typed.unpivot(list(ids), cols, var_name, value_name)
    if drop_null:
        long = long.filter(F.col(value_name).isNotNull())
    if positive_only:
        long = long.filter(F.col(value_name) > 0)
    return long


def date_columns(columns: Sequence[str], prefixes: Sequence[str] = ("19", "20")) -> list[str]:
    """s17: the columns whose name starts with a year prefix (metadata only)."""
    return [c for c in columns if any(c.startswith(p) for p in prefixes)]
