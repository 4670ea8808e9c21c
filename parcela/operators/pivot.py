"""Pivots with an explicit value list (a09, a10, a14).

An explicit list keeps the plan static (no distinct-values job) and drops
values outside the list, as the source does for e.g. 'hurricane'.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_count(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[str],
                suffix: str = "_count") -> DataFrame:
    """a09: one count column per listed value; missing -> 0."""
    p = df.groupBy(*keys).pivot(pivot_col, list(values)).agg(F.count(F.lit(1)))
    return p.select(*keys, *[F.coalesce(F.col(v), F.lit(0)).cast("bigint").alias(f"{v}{suffix}") for v in values])


def pivot_max_fill(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[str],
                   value_expr, fill: float = 0.0, suffix: str = "") -> DataFrame:
    """a10: max(value) per listed pivot value; missing -> ``fill``."""
    p = df.groupBy(*keys).pivot(pivot_col, list(values)).agg(F.max(value_expr))
    return p.select(*keys, *[F.coalesce(F.col(v), F.lit(fill)).alias(f"{v}{suffix}") for v in values])


def pivot_max(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[str],
              value_col: str, suffix: str = "") -> DataFrame:
    """a14: max per (key, pivot value), NULL when absent."""
    p = df.groupBy(*keys).pivot(pivot_col, list(values)).agg(F.max(value_col))
    return p.select(*keys, *[F.col(v).alias(f"{v}{suffix}") for v in values])
