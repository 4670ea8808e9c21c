"""Whole-table min-max scaling (a17 + f18) in one pass, no driver round trip.

All min/max statistics are computed by a single global aggregate (partial per
task, one final row) and attached with a broadcast join of that one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import scaled


def global_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """a17: one row with ``<c>__lo`` and ``<c>__hi`` for every column."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi")]
    return df.agg(*aggs)


def minmax_scale(df: DataFrame, specs: Sequence[tuple], range_floor: float = 1.0) -> DataFrame:
    """f18 for several columns at once.

    ``specs`` items are ``(source_col, out_col, invert)`` or ``(source_expr_col,
    out_col, invert, value_expr)`` when the scaled value differs from the column
    used for the statistics (e.g. a coalesced count).
    """
    src = sorted({s[0] for s in specs})
    stats = F.broadcast(global_stats(df, src))  # exactly one row
    j = df.crossJoin(stats)
    for spec in specs:
        c, out, inv = spec[0], spec[1], spec[2]
        val = spec[3] if len(spec) > 3 else F.col(c)
        j = j.withColumn(out, scaled(val, F.col(f"{c}__lo"), F.col(f"{c}__hi"), inv, range_floor))
    return j.drop(*[f"{c}__lo" for c in src], *[f"{c}__hi" for c in src])
