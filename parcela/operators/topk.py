"""Top-k for a table of requests, each with its own bounds and limit.

Joining every request with every row of its key grows with requests x rows. Here rows fall into classes first: a step of the
order column (an eighth of an octave) and of every bounded column, with the equality columns. One row a class, with its count and
the least and greatest bounded values, tells for a request which classes lie inside its bounds, which on their edge, and, by a running
sum over the steps, behind which step its limit is reached for certain. Of the classes that are left, an inner one sends its first
``max_limit`` rows only (one bounded heap a class, shared by all requests); rows of an edge class are compared one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS = 8
_LAST = 1 << 40                          # the step of rows without an order value


def _step(v: Column) -> Column:
    return F.floor(F.asinh(v.cast("double")) * F.lit(float(STEPS)))


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _met(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def bounded_topk(requests: DataFrame, rows: DataFrame, request_id: str, keys: Sequence[str], order: str, tie: str, limit: str,
                 max_limit: int, ascending: bool = True, bounds: Sequence[tuple[str, str | None, str | None]] = (),
                 equals: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """``request_id``, ``rank`` (from 1) and the columns of ``rows``: for each request its first ``limit`` rows (at most ``max_limit``) by
    ``order`` (NULL last), then ``tie``, among the rows of equal ``keys`` within the bounds.

    ``bounds`` are (column of rows, request's least value, request's greatest value) and ``equals`` (column of rows, request's value);
    a request's NULL is no bound. Names of requests and rows must differ, but for ``keys``. A NULL key matches nothing."""
    names, keys = rows.columns, list(keys)
    value = F.col(order) if ascending else -F.col(order)
    steps = [f"_s{i}" for i in range(len(bounds))]
    data = rows.withColumn("_o", value).withColumn("_step", F.coalesce(_step(F.col("_o")), F.lit(_LAST)))
    for s, (column, _, _) in zip(steps, bounds, strict=True):
        data = data.withColumn(s, _step(F.col(column)))
    data = data.withColumn("_class", F.struct("_step", *steps, *[F.col(c) for c, _ in equals]))
    classes = data.groupBy(*keys, "_class").agg(
        F.count(F.lit(1)).alias("_n"), *[f(c).alias(f"{s}{e}") for s, (c, _, _) in zip(steps, bounds, strict=True) for f, e in ((F.min, "lo"), (F.max, "hi"))])

    def within(low: Sequence[Column], high: Sequence[Column]) -> Column:
        """The bounds of a request hold for the least values ``low`` and the greatest ``high``."""
        out = []
        for a, z, (_, least, greatest) in zip(low, high, bounds, strict=True):
            out += [F.col(least).isNull() | _met(a >= F.col(least))] if least else []
            out += [F.col(greatest).isNull() | _met(z <= F.col(greatest))] if greatest else []
        return _all(out)

    los, his = [F.col(f"{s}lo") for s in steps], [F.col(f"{s}hi") for s in steps]
    equal = _all([F.col(r).isNull() | _met(F.col(f"_class.{c}") == F.col(r)) for c, r in equals])
    some = requests.join(classes, keys).where(equal & within(his, los)).withColumn("_inner", within(los, his))
    before = Window.partitionBy(request_id).orderBy("_class._step").rangeBetween(Window.unboundedPreceding, -1)
    some = some.withColumn("_sure", F.coalesce(F.sum(F.when(F.col("_inner"), F.col("_n")).otherwise(0)).over(before), F.lit(0)))
    some = some.where(F.col("_sure") < F.col(limit)).select(request_id, *keys, "_class", "_inner", limit, *[x for _, a, z in bounds for x in (a, z) if x])
    first = Window.partitionBy(*keys, "_class").orderBy(F.col("_o").asc_nulls_last(), tie)
    heap = data.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= max_limit).drop("_at")
    values = [F.col(c) for c, _, _ in bounds]
    inner = some.where("_inner").join(heap, [*keys, "_class"])
    edge = some.where(~F.col("_inner")).join(data, [*keys, "_class"]).where(within(values, values))
    found = inner.unionByName(edge)
    rank = Window.partitionBy(request_id).orderBy(F.col("_o").asc_nulls_last(), tie)
    return (found.withColumn("rank", F.row_number().over(rank)).where((F.col("rank") <= F.col(limit)) & (F.col("rank") <= max_limit))
            .select(request_id, "rank", *names))
