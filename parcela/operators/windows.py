"""Per-series window operators (w02-w04, w08, w09, w12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lag_change(df: DataFrame, keys: Sequence[str], order_col: str, value_col: str,
               lags: dict[str, int]) -> DataFrame:
    """w02 + w03: 100 * (x - lag_k) / lag_k when lag_k > 0 else NULL, per output column."""
    w = Window.partitionBy(*keys).orderBy(order_col)
    out = df
    for name, k in lags.items():
        lag = F.lag(value_col, k).over(w)
        out = out.withColumn(name, F.when(lag > 0, 100.0 * (F.col(value_col) - lag) / lag))
    return out


def rolling_mean(df: DataFrame, keys: Sequence[str], order_col: str, value_col: str,
                 frames: dict[str, int], centered: bool = False) -> DataFrame:
    """w04/w08: trailing n-row mean including the current row (or centred)."""
    base = Window.partitionBy(*keys).orderBy(order_col)
    out = df
    for name, n in frames.items():
        if centered:
            w = base.rowsBetween(-(n // 2), n - n // 2 - 1)
        else:
            w = base.rowsBetween(-(n - 1), 0)
        out = out.withColumn(name, F.avg(value_col).over(w))
    return out


def rolling_mean_months(df: DataFrame, keys: Sequence[str], date_col: str, value_col: str,
                        frames: dict[str, int]) -> DataFrame:
    """w08: time-range frame over a month index (gaps shorten the window)."""
    midx = (F.year(date_col) * 12 + F.month(date_col)).cast("long")
    tmp = df.withColumn("_m", midx)
    w = Window.partitionBy(*keys).orderBy("_m")
    for name, n in frames.items():
        tmp = tmp.withColumn(name, F.avg(value_col).over(w.rangeBetween(-(n - 1), 0)))
    return tmp.drop("_m")


def trend_label(df: DataFrame, keys: Sequence[str], x_col: str, y_col: str, out_col: str = "trend",
                tolerance: float = 0.0) -> DataFrame:
    """w09: sign of the least-squares slope of y over x -> rising / stable / falling."""
    g = df.groupBy(*keys).agg(F.regr_slope(y_col, x_col).alias("_slope"))
    lab = (F.when(F.col("_slope") > tolerance, "rising")
            .when(F.col("_slope") < -tolerance, "falling")
            .when(F.col("_slope").isNotNull(), "stable"))
    return g.select(*keys, "_slope", lab.alias(out_col))
