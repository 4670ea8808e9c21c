"""Registered incremental-load queries (st01-st03) driven by Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import diff
from ..session import scratch_path
from ..sources import bindings
from ..sources.tables import Tables
from ..streaming import incremental
from .catalog import O, register

_KEYS = ["date", "from_currency", "to_currency"]


def _land_and_load(spark, d, batches, runs=1):
    """Land the fx rows in year slices, then run the availableNow stream ``runs`` times
    (each run with a fresh checkpoint replays every file; a checkpoint that is kept goes on with its state)."""
    fx = bindings.fx(Tables.shared(spark, d))
    root = scratch_path(spark, f"st_{uuid.uuid4().hex}")
    landing, target = f"{root}/landing", f"{root}/target"
    for lo, hi in batches:
        sl = fx.filter((F.year("date") >= lo) & (F.year("date") < hi))
        sl.write.mode("append").parquet(landing)
        for r in range(runs):
            incremental.run_stateful(spark, landing, fx.schema, target, f"{root}/ckpt_{r}", _KEYS, partition_by=["from_currency"])
    return fx, target


@register("st01_incremental_load", O.sql("SELECT * FROM fx", "fx"))
def st01(spark, d):
    fx, target = _land_and_load(spark, d, [(1900, 1998), (1998, 2100)])
    return spark.read.parquet(target).select(*fx.columns)


@register("st02_change_feed", O.sql("""
SELECT date, from_currency, to_currency, 'insert' AS _change_type, rate FROM fx WHERE year(date) >= 1998""", "fx"))
def st02(spark, d):
    fx = bindings.fx(Tables.shared(spark, d))
    root = scratch_path(spark, f"st02_{uuid.uuid4().hex}")
    landing, target = f"{root}/landing", f"{root}/target"
    versions = [f"{root}/v0", f"{root}/v1"]
    for slice_, version in zip((fx.filter(F.year("date") < 1998), fx.filter(F.year("date") >= 1998)), versions):
        slice_.write.mode("append").parquet(landing)
        incremental.run_stateful(spark, landing, fx.schema, target, f"{root}/ckpt", _KEYS)
        diff.write_version(spark.read.parquet(target).select(*fx.columns), version, _KEYS, ranges=16)
    return diff.version_diff(spark, *versions, fx.schema, _KEYS)


@register("st03_idempotent_rerun", O.sql("SELECT * FROM fx", "fx"))
def st03(spark, d):
    fx, target = _land_and_load(spark, d, [(1900, 2100)], runs=2)
    return spark.read.parquet(target).select(*fx.columns)
