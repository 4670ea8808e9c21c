"""Incremental loads as Structured Streaming jobs (st01-st03).

A landing folder is read with the file source; ``trigger(availableNow=True)`` processes every file not yet recorded in the query's
checkpoint and stops. The keys that have been loaded live in the stream's state store (``dropDuplicates``, by a hash of the key over all
state partitions; with a watermark only as long as late rows may come), so a batch never reads the target. Every epoch writes a folder
of its own, ``load=<checkpoint>/epoch=<n>``: a replayed epoch overwrites what it had written. A stream whose checkpoint is new while
the target has other loads also skips the keys of those loads.

``run_incremental`` keeps the newest row of a key in a batch by ``order_by`` instead, and looks the keys up in the target.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import latest_per_key
from ..sources.sinks import _fs


def _target_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def keyed_append_batch(target_path: str, keys: Sequence[str], order_by: Sequence[str] = (),
                       partition_by: Sequence[str] = ()):
    """foreachBatch function: dedupe the batch by key, drop keys already stored, append."""
    keys = list(keys)

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        b = latest_per_key(batch, keys, list(order_by)) if order_by else batch.dropDuplicates(keys)
        if _target_exists(spark, target_path):
            have = spark.read.parquet(target_path).select(*keys)
            b = b.join(have, keys, "left_anti")
        w = b.write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(target_path)
    return run


def _load_name(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def epoch_writer(target_path: str, keys: Sequence[str], load: str, partition_by: Sequence[str] = ()):
    """foreachBatch function: write the epoch's new rows into its own folder; keys of other loads are left out."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        others = []
        if _target_exists(spark, target_path):
            fs, p = _fs(spark, target_path)
            names = [s.getPath().getName() for s in fs.listStatus(p)]
            others = [f"{target_path}/{n}" for n in names if n.startswith("load=") and n != f"load={load}"]
        if others:
            have = spark.read.option("basePath", target_path).parquet(*others).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
            batch = batch.join(have, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], "left_anti")       # as dropDuplicates has it
        w = batch.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{target_path}/load={load}/epoch={epoch_id}")
    return run


def run_stateful(spark: SparkSession, landing: str, schema: T.StructType, target_path: str, checkpoint: str, keys: Sequence[str],
                 partition_by: Sequence[str] = (), watermark: tuple[str, str] | None = None, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> None:
    """st01/st03: append every row whose key is new. ``watermark`` (time column, delay) bounds the state: keys are forgotten when no
    row that old is taken any more."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing)
    if watermark:
        stream = stream.withWatermark(*watermark).dropDuplicatesWithinWatermark(list(keys))
    else:
        stream = stream.dropDuplicates(list(keys))
    q = (stream.writeStream.foreachBatch(epoch_writer(target_path, keys, _load_name(checkpoint), partition_by))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def run_incremental(spark: SparkSession, landing: str, schema: T.StructType, target_path: str, checkpoint: str,
                    keys: Sequence[str], order_by: Sequence[str] = (), partition_by: Sequence[str] = (),
                    fmt: str = "parquet", max_files_per_trigger: int | None = None) -> None:
    """st01: process every landed file once (availableNow) into the keyed target."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing)
    q = (stream.writeStream.foreachBatch(keyed_append_batch(target_path, keys, order_by, partition_by))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def high_water_mark_filter(batch: DataFrame, target: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """Batch form of st01 (a05): rows newer than their key's stored maximum date."""
    hw = target.groupBy(*keys).agg(F.max(date_col).alias("_hw"))
    j = batch.join(hw, list(keys), "left")
    return j.filter(F.col("_hw").isNull() | (F.col(date_col) > F.col("_hw"))).drop("_hw")
