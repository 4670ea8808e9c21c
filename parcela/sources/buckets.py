"""Keyed tables in buckets (k03-k06, k11): a merge rewrites the buckets that its rows touch and leaves the files of all others.

A table is a parquet folder partitioned by a hash of its key. ``merge`` first writes the batch, one row a key, in the same
partitioning; the partitions of that folder are the touched buckets, no job has to look for them. Only these are read from the
table (partition pruning), joined and written back by dynamic partition overwrite, which replaces them when the whole job has
succeeded. A table that does not exist yet has nothing to match: its first batch is written as it stands, without a stage or a join.
The numbers of inserted, updated and failed rows are observed by the write itself. Rows without a key are left out and counted.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import latest_per_key
from ..session import scratch_path
from .sinks import _fs
from .tables import path_exists

BUCKET = "bucket_"


class BucketTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.columns = self.schema.fieldNames()

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _read(self, path: str, kept: Sequence[T.StructField] = ()) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *kept, T.StructField(BUCKET, T.IntegerType())])
        if path_exists(self.spark, path):
            return self.spark.read.schema(schema).parquet(path)
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])

    def read(self) -> DataFrame:
        return self._read(self.path).select(*self.columns)

    def touched(self, path: str) -> list[int]:
        """The buckets that a folder has partitions of: at most ``buckets`` names."""
        if not path_exists(self.spark, path):
            return []
        fs, at = _fs(self.spark, path)
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{BUCKET}="))

    def merge(self, rows: DataFrame, update: Sequence[str] | Mapping[str, Column] | None = None, insert: bool = True,
              order_by: Sequence[str] = (), failed: Column | None = None) -> dict[str, int]:
        """Merge ``rows`` (the table's columns, and those of ``order_by``) and return the numbers of staged, inserted, updated, failed and
        skipped rows.

        Of rows of one key the last by ``order_by`` counts. A matched row takes ``update`` from the batch (None: all columns; a mapping
        gives expressions over ``s.column`` and ``t.column``), an unmatched one is inserted if ``insert``. ``failed``, over the
        batch's columns, marks rows to count as failures; they are merged all the same."""
        seen, done = Observation(), Observation()
        batch = self._batch(rows, order_by, seen)
        if insert and not path_exists(self.spark, self.path):
            self._create(batch, failed, done)
            return {"updated": 0} | seen.get | done.get
        stage = scratch_path(self.spark, f"merge_{uuid.uuid4().hex}")
        batch.write.partitionBy(BUCKET).parquet(stage)
        return self._apply(stage, update, insert, failed) | seen.get

    def stage(self, rows: DataFrame, order_by: Sequence[str] = ()) -> tuple[str, DataFrame, int]:
        """``rows`` written once as a batch for ``merge_staged``: its path, its rows (one a key, with the columns of ``order_by``) for
        further reading, and the number of skipped rows."""
        seen, path = Observation(), scratch_path(self.spark, f"merge_{uuid.uuid4().hex}")
        kept = [rows.schema[c] for c in order_by if c not in self.columns]
        self._batch(rows, order_by, seen, [f.name for f in kept]).write.partitionBy(BUCKET).parquet(path)
        return path, self._read(path, kept).drop(BUCKET), seen.get["skipped"]

    def merge_staged(self, path: str, update: Sequence[str] | Mapping[str, Column] | None = None, insert: bool = True,
                     failed: Column | None = None) -> dict[str, int]:
        """``merge`` of a batch of ``stage``; the rows that were skipped are counted there."""
        if not (insert and not path_exists(self.spark, self.path)):
            return self._apply(path, update, insert, failed)
        done = Observation()
        self._create(self._read(path), failed, done)
        return {"updated": 0} | done.get

    def _batch(self, rows: DataFrame, order_by: Sequence[str], seen: Observation, kept: Sequence[str] = ()) -> DataFrame:
        """One row a key of ``rows``, with its bucket."""
        keyed = F.lit(True)
        for k in self.keys:
            keyed = keyed & F.col(k).isNotNull()
        batch = rows.select(*dict.fromkeys([*self.columns, *order_by])).observe(seen, F.count_if(~keyed).alias("skipped")).where(keyed)
        batch = latest_per_key(batch, self.keys, list(order_by) or [c for c in self.columns if c not in self.keys])
        return batch.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields], *kept).withColumn(BUCKET, self.bucket())

    def _create(self, batch: DataFrame, failed: Column | None, done: Observation) -> None:
        """The table from its first batch: every row is inserted."""
        bad = F.coalesce(failed, F.lit(False)) if failed is not None else F.lit(False)
        new = batch.withColumn("_bad", bad).observe(done, F.count(F.lit(1)).alias("staged"), F.count(F.lit(1)).alias("inserted"), F.count_if("_bad").alias("failed"))
        new.drop("_bad").write.partitionBy(BUCKET).parquet(self.path)

    def _apply(self, stage: str, update: Sequence[str] | Mapping[str, Column] | None, insert: bool, failed: Column | None) -> dict[str, int]:
        done = Observation()
        counts = {"staged": 0, "inserted": 0, "updated": 0, "failed": 0}
        touched = self.touched(stage)
        if not touched:
            return counts
        source = self._read(stage).withColumn("_s", F.lit(True)).withColumn("_bad", F.coalesce(failed, F.lit(False)) if failed is not None else F.lit(False))
        target = self._read(self.path).where(F.col(BUCKET).isin(touched)).withColumn("_t", F.lit(True))
        joined = target.alias("t").join(source.alias("s"), [BUCKET, *self.keys], "full" if insert else "left")
        in_s, in_t = F.col("_s").isNotNull(), F.col("_t").isNotNull()
        update = [c for c in self.columns if c not in self.keys] if update is None else update
        change = update if isinstance(update, Mapping) else {c: F.col(f"s.{c}") for c in update}

        def value(c: str) -> Column:
            if c in self.keys:
                return F.col(c)
            kept = F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
            return (F.when(in_s & in_t, change[c]).otherwise(kept) if c in change else kept).alias(c)
        merged = joined.select(*[value(c) for c in self.columns], BUCKET, in_s.alias("_in_s"), in_t.alias("_in_t"), "_bad").observe(
            done, F.count_if(F.col("_in_s")).alias("staged"), F.count_if(F.col("_in_s") & ~F.col("_in_t")).alias("inserted"),
            F.count_if(F.col("_in_s") & F.col("_in_t")).alias("updated"), F.count_if(F.col("_in_s") & F.col("_bad")).alias("failed"))
        (merged.select(*self.columns, BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(self.path))
        return counts | done.get
