"""Keyed upserts, slice replacement and run counts without a table format (k03-k07, k11, k12).

Every operator returns the *new snapshot* as a lazy DataFrame; callers write it
to a fresh path (``sinks.write_snapshot``) so no job overwrites a path it is
reading. Sources are deduplicated by key first so one duplicate key can never
multiply target rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedupe import dedupe_by_key, latest_per_key


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _dedupe_source(source: DataFrame, keys, order_by) -> DataFrame:
    if order_by:
        return latest_per_key(source, keys, order_by)
    return dedupe_by_key(source, keys)


def upsert_all(target: DataFrame, source: DataFrame, keys, order_by=None) -> DataFrame:
    """k04/k05: matched target rows replaced by the source row, unmatched source rows inserted."""
    keys = _names(keys)
    src = _dedupe_source(source.select(*target.columns), keys, order_by)
    kept = target.join(src.select(*keys), keys, "left_anti")
    return kept.unionByName(src)


def upsert_subset(target: DataFrame, source: DataFrame, keys, update_cols: Sequence[str],
                  order_by=None) -> DataFrame:
    """k03: matched rows get only ``update_cols`` from the source; unmatched source rows inserted whole."""
    keys = _names(keys)
    src = _dedupe_source(source.select(*target.columns), keys, order_by).withColumn("_in_s", F.lit(True))
    tgt = target.withColumn("_in_t", F.lit(True))
    j = tgt.alias("t").join(src.alias("s"), keys, "full_outer")
    cols = []
    for c in target.columns:
        if c in keys:
            cols.append(F.col(c))
        elif c in update_cols:
            cols.append(F.when(F.col("s._in_s"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            cols.append(F.when(F.col("t._in_t"), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return j.select(*cols)


def update_only(target: DataFrame, source: DataFrame, keys, keep_cols: Sequence[str] = (),
                order_by=None) -> DataFrame:
    """k06: matched rows updated (except ``keep_cols``); unmatched source rows ignored."""
    keys = _names(keys)
    src = _dedupe_source(source.select(*target.columns), keys, order_by).withColumn("_in_s", F.lit(True))
    j = target.alias("t").join(src.alias("s"), keys, "left")
    cols = []
    for c in target.columns:
        if c in keys:
            cols.append(F.col(c))
        elif c in keep_cols:
            cols.append(F.col(f"t.{c}"))
        else:
            cols.append(F.when(F.col("s._in_s"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    return j.select(*cols)


def slice_replace(target: DataFrame, batch: DataFrame, slice_cols, slices: DataFrame | None = None) -> DataFrame:
    """k07: drop the target rows of every slice named by ``slices`` (default: the
    slices present in the batch) and append the batch. Passing ``slices`` with an
    empty batch clears those slices."""
    slice_cols = _names(slice_cols)
    sl = (slices if slices is not None else batch).select(
        *[F.col(c).alias(f"_sl{i}") for i, c in enumerate(slice_cols)]).distinct()
    cond = [F.col(c).eqNullSafe(F.col(f"_sl{i}")) for i, c in enumerate(slice_cols)]
    kept = target.join(sl, cond, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def upsert_counts(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """k11: one row: staged keys, already present (updated) and new (inserted)."""
    keys = _names(keys)
    staged = source.select(*keys).distinct()
    present = staged.join(target.select(*keys).distinct(), keys, "left_semi").withColumn("_hit", F.lit(1))
    flagged = staged.join(present, keys, "left")
    return flagged.agg(F.count(F.lit(1)).alias("staged"),
                       F.count("_hit").alias("updated"),
                       (F.count(F.lit(1)) - F.count("_hit")).alias("inserted"))


def insert_refresh_split(batch: DataFrame, known: DataFrame, keys, required: Sequence[str],
                         blob_col: str | None = None) -> DataFrame:
    """k12: flag each batch row as new / refresh / parse_failure and keep the blob
    only on insert or failure (NULL on a clean refresh)."""
    keys = _names(keys)
    k = known.select(*keys).distinct().withColumn("_known", F.lit(True))
    j = batch.join(k, keys, "left")
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    status = (F.when(~ok, "parse_failure").when(F.col("_known").isNull(), "new").otherwise("refresh"))
    out = j.withColumn("row_status", status).drop("_known")
    if blob_col:
        out = out.withColumn(blob_col, F.when(F.col("row_status") == "refresh", F.lit(None).cast("string"))
                                        .otherwise(F.col(blob_col)))
    return out
