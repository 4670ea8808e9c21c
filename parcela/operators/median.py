"""Exact medians without holding a key's values in one task.

``median()`` keeps every distinct value of a key in the heap of one aggregate task. Here rows collapse to distinct
(keys, value) counts with map-side combine, every value falls into a bucket that grows with the value, bucket totals of a key
(at most some ten thousand rows) tell which bucket holds the middle positions, and only the values of that bucket go on. The
first buckets span a relative range of 1 / ``RESOLUTION``; each of ``REFINED`` further rounds cuts the bucket in the middle into
``RESOLUTION`` equal steps between its own least and greatest value, so a key whose values lie close together is cut just as finely.
Only the values of the last bucket are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESOLUTION = 4096
REFINED = 1


def bucket_of(v: Column) -> Column:
    """A bucket that never falls as the value grows: about linear near zero, logarithmic beyond."""
    return F.floor(F.asinh(v.cast("double")) * F.lit(float(RESOLUTION)))


def _middle_buckets(c: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``c`` in the buckets that hold the middle positions of their key. ``_below`` (positions before the part of the key that
    is looked at, which names the part) moves on to the bucket; ``_lo`` and ``_hi`` are its least and greatest value."""
    totals = c.groupBy(*keys, "_below", "_all", "_b").agg(F.sum("_n").alias("_bn"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    part = Window.partitionBy(*keys, "_below")
    before = part.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_at", F.col("_below") + F.coalesce(F.sum("_bn").over(before), F.lit(0)))
    totals = totals.withColumn("_all", F.coalesce("_all", F.sum("_bn").over(part)))
    hits = totals.where(_holds("_at", "_bn", 0) | _holds("_at", "_bn", 1)).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_below").alias("_hp"), F.col("_b").alias("_hb"), "_at", F.col("_all").alias("_ha"), "_lo", "_hi")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_below") == F.col("_hp"), F.col("_b") == F.col("_hb")]
    return c.join(hits, same).select(*keys, "_v", "_n", "_x", F.col("_at").alias("_below"), F.col("_ha").alias("_all"), "_lo", "_hi")


def _holds(at: str, n: str, upper: int) -> Column:
    """Whether the ``n`` positions from ``at`` (from 0) hold the lower or upper middle of ``_all``."""
    p = F.floor((F.col("_all") - 1 + upper) / 2)
    return (F.col(at) <= p) & (p < F.col(at) + F.col(n))


def median_of_counts(counts: DataFrame, keys: Sequence[str], value_col: str, n_col: str, out_col: str, refined: int = REFINED) -> DataFrame:
    """Median of ``value_col`` per key from rows (keys, distinct value, count); keys without a value have no row."""
    keys = list(keys)
    v = F.col(value_col)
    c = counts.where(v.isNotNull()).select(*keys, v.alias("_v"), F.col(n_col).alias("_n"), v.cast("double").alias("_x"), F.lit(0).cast("long").alias("_below"),
                                           F.lit(None).cast("long").alias("_all"), bucket_of(v).alias("_b"))
    inside = _middle_buckets(c, keys)
    wide = F.col("_hi") - F.col("_lo")
    for _ in range(refined):                       # the width of a bucket is 0, a number, or NaN and infinite beyond the doubles
        step = F.when((wide > 0) & (wide < float("inf")), F.floor((F.col("_x") - F.col("_lo")) / wide * F.lit(float(RESOLUTION)))).otherwise(F.lit(0))
        inside = _middle_buckets(inside.withColumn("_b", step).drop("_lo", "_hi"), keys)
    run = Window.partitionBy(*keys, "_below").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("_at", F.col("_below") + F.coalesce(F.sum("_n").over(run), F.lit(0)))
    weight = sum(_holds("_at", "_n", i).cast("int") for i in (0, 1))
    picked = inside.withColumn("_w", weight).where("_w > 0")
    return picked.groupBy(*keys).agg((F.sum(F.col("_v").cast("double") * F.col("_w")) / 2.0).alias(out_col))


def exact_median(df: DataFrame, keys: Sequence[str], value_col: str, out_col: str) -> DataFrame:
    """keys, median: one row for every key of ``df`` (NULL where a key has no value); without keys, one row."""
    keys = list(keys)
    if not keys:
        one = exact_median(df.withColumn("_one", F.lit(1)), ["_one"], value_col, out_col).drop("_one")
        return one.agg(F.max(out_col).alias(out_col))
    counts = df.groupBy(*keys, value_col).agg(F.count(F.lit(1)).alias("_n"))
    medians = median_of_counts(counts, keys, value_col, "_n", "_m")
    every = counts.groupBy(*keys).agg(F.sum("_n").alias("_n"))
    medians = medians.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_m")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return every.join(medians, same, "left").select(*keys, F.col("_m").alias(out_col))


def exact_medians(df: DataFrame, keys: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """keys and the median of each of ``value_cols`` (as doubles, under their own names), in one pass over long rows."""
    keys = list(keys)
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in value_cols])
    long = df.select(*keys, F.explode(pairs).alias("_p")).select(*keys, F.col("_p.name").alias("_name"), F.col("_p.value").alias("_value"))
    wide = exact_median(long, [*keys, "_name"], "_value", "_m").groupBy(*keys)
    return wide.agg(*[F.max(F.when(F.col("_name") == c, F.col("_m"))).alias(c) for c in value_cols])
