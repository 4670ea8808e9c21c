"""Predicate builders (p04-p11, p17-p22)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import token_normalize


def optional_conjunction(bounds: dict[str, tuple[str, object]]) -> Column:
    """p04: AND of only the bounds whose value is not None.

    ``bounds`` maps a label to (column op, value), e.g. {"min_price": ("price_usd >=", 1000)}.
    """
    preds = []
    for _, (lhs, value) in bounds.items():
        if value is None:
            continue
        col, op = lhs.rsplit(" ", 1)
        c = F.col(col)
        preds.append({">=": c >= value, "<=": c <= value, "==": c == value, ">": c > value, "<": c < value}[op])
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def ci_equals(col: str, value: str) -> Column:
    """p05: case-insensitive equality."""
    return F.lower(F.col(col)) == value.lower()


def not_blank(col: str, exact_len: int | None = None) -> Column:
    """p07: not NULL, not blank, optionally a fixed trimmed length."""
    t = F.trim(F.col(col))
    c = F.col(col).isNotNull() & (t != "")
    return c & (F.length(t) == exact_len) if exact_len else c


def positive_number(col: str) -> Column:
    """p19: not NULL, not NaN, > 0."""
    return F.col(col).isNotNull() & ~F.isnan(F.col(col)) & (F.col(col) > 0)


def in_alias_set(df: DataFrame, col: str, aliases: Iterable[str], out_col: str | None = None) -> DataFrame:
    """p21: keep rows whose normalised ``col`` is one of ``aliases`` (a small literal
    lookup table, broadcast: its size is the alias list, not the data)."""
    spark = df.sparkSession
    lk = spark.createDataFrame([(a,) for a in sorted(set(aliases))], "_alias string")
    j = df.withColumn("_norm", token_normalize(col)).join(F.broadcast(lk), F.col("_norm") == F.col("_alias"), "left_semi")
    return j.drop("_norm") if out_col is None else j.withColumnRenamed("_norm", out_col)


def at_scalar_max(df: DataFrame, col: str) -> DataFrame:
    """p17: rows where ``col`` equals the maximum of the (already filtered) frame;
    the maximum is a one-row aggregate joined back (broadcast of one row)."""
    mx = df.agg(F.max(col).alias("_mx"))
    return df.crossJoin(F.broadcast(mx)).filter(F.col(col) == F.col("_mx")).drop("_mx")


def newest_available(df: DataFrame, year_col: str, measure: Column | None = None) -> DataFrame:
    """p22: rows of the newest year that has at least one (measured) row."""
    cand = df if measure is None else df.filter(measure)
    mx = cand.agg(F.max(year_col).alias("_y"))
    return df.crossJoin(F.broadcast(mx)).filter(F.col(year_col) == F.col("_y")).drop("_y")
