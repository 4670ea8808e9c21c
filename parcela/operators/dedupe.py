"""Latest / first row per key (w01, w10, w11, j04, a05, l04).

All variants aggregate with ``max``/``min`` over a struct whose leading fields
are the ordering columns, so Spark combines map-side before the shuffle: a
key holding a third of the rows collapses to one partial row per task instead
of landing in one window partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def latest_per_key(df: DataFrame, keys, order_by, newest: bool = True) -> DataFrame:
    """One row per key: the row with the greatest (or least) ``order_by`` tuple.

    Remaining columns act as the final tie-break, so the result is deterministic
    (total order). NULL ordering values lose against non-NULL ones for
    ``newest=True`` (same as ``ORDER BY x DESC NULLS LAST``).
    """
    keys, order_by = _names(keys), _names(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(c) for c in order_by + rest]).alias("_r")
    agg = F.max(packed) if newest else F.min(packed)
    out = df.groupBy(*keys).agg(agg.alias("_r"))
    return out.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in order_by + rest]).select(*df.columns)


def dedupe_by_key(df: DataFrame, keys) -> DataFrame:
    """w11: one row per key; the smallest full row wins (deterministic dropDuplicates)."""
    keys = _names(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    return latest_per_key(df, keys, rest, newest=False)


def last_wins(df: DataFrame, keys, seq_col: str) -> DataFrame:
    """w10: last occurrence per key in arrival order (``seq_col`` = arrival position)."""
    return latest_per_key(df, keys, [seq_col], newest=True)


def rows_at_max(df: DataFrame, keys, order_col: str) -> DataFrame:
    """j04: every row whose ``order_col`` equals its key's maximum (ties kept).

    Max per key is a partial aggregate; the join back is an equi-join on
    (keys, max value), which AQE splits if one key is hot.
    """
    keys = _names(keys)
    mx = df.groupBy(*keys).agg(F.max(order_col).alias("_mx"))
    mx = mx.select(*[F.col(k).alias(f"_mk{i}") for i, k in enumerate(keys)], "_mx")
    cond = [F.col(k).eqNullSafe(F.col(f"_mk{i}")) for i, k in enumerate(keys)] + [F.col(order_col) == F.col("_mx")]
    return df.join(mx, cond, "left_semi")


def high_water_mark(df: DataFrame, keys, date_col: str, key_list: DataFrame | None = None,
                    out_col: str = "high_water_mark") -> DataFrame:
    """a05: max date per key; keys in ``key_list`` without rows get NULL."""
    keys = _names(keys)
    hw = df.groupBy(*keys).agg(F.max(date_col).alias(out_col))
    if key_list is None:
        return hw
    return key_list.select(*keys).distinct().join(hw, keys, "left")


def latest_value(df: DataFrame, value_col: str, order_by: Sequence[str], out_col: str | None = None) -> DataFrame:
    """l04 / j19: a one-row frame with the value of the newest row (max_by, no driver round trip)."""
    key = F.struct(*[F.col(c) for c in order_by])
    return df.agg(F.max_by(F.col(value_col), key).alias(out_col or value_col))
