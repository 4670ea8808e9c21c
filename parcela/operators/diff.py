"""Snapshot diff (k09): the change feed between two versions of a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, keys) -> DataFrame:
    """Rows that changed between ``old`` and ``new``.

    Output: key columns, ``_change_type`` in insert / delete / update_preimage /
    update_postimage, then the row values. A null-safe 64-bit hash of the
    non-key columns decides "changed"; equal hashes are confirmed column by
    column, so a hash collision cannot hide an update.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    vals = [c for c in old.columns if c not in keys]
    h = F.xxhash64(*[F.col(c) for c in vals]) if vals else F.lit(0)
    o = old.select(*keys, h.alias("_h"), F.struct(*vals).alias("_v"), F.lit(True).alias("_o"))
    n = new.select(*keys, h.alias("_h"), F.struct(*vals).alias("_v"), F.lit(True).alias("_n"))
    j = o.alias("o").join(n.alias("n"), keys, "full_outer")
    same = (F.col("o._h") == F.col("n._h")) & F.col("o._v").eqNullSafe(F.col("n._v"))
    ev = (F.when(F.col("o._o").isNull(), F.array(F.struct(F.lit("insert").alias("t"), F.col("n._v").alias("v"))))
           .when(F.col("n._n").isNull(), F.array(F.struct(F.lit("delete").alias("t"), F.col("o._v").alias("v"))))
           .when(~same, F.array(F.struct(F.lit("update_preimage").alias("t"), F.col("o._v").alias("v")),
                                F.struct(F.lit("update_postimage").alias("t"), F.col("n._v").alias("v")))))
    e = j.select(*keys, F.explode(ev).alias("_e"))
    return e.select(*keys, F.col("_e.t").alias("_change_type"), *[F.col(f"_e.v.{c}").alias(c) for c in vals])


# --- digests of key ranges: two versions of a table are compared without reading what is equal in both ---------------------------
RANGE = "range_"
FAN_OUT = 16


def range_of(keys, ranges: int):
    """The key range (by hash) that a row belongs to."""
    return F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int")


def write_version(df: DataFrame, path: str, keys, ranges: int = 256) -> None:
    """Write a version of a keyed table: its rows by key range under ``path/rows``, and under ``path/digests`` a hash tree over them.

    The digest of a range is its number of rows and three sums over hashes of its whole rows, so that rows may stand in any order and
    ranges add up; the digest of an inner node (``level`` above 0) is the sum of its ``FAN_OUT`` children."""
    keys, spark = ([keys] if isinstance(keys, str) else list(keys)), df.sparkSession
    df.withColumn(RANGE, range_of(keys, ranges)).write.partitionBy(RANGE).parquet(f"{path}/rows")
    written = spark.read.parquet(f"{path}/rows") if not df.isEmpty() else df.withColumn(RANGE, F.lit(0))
    row = F.xxhash64(*[F.struct(F.col(c)) for c in df.columns], *[F.col(c).isNull() for c in df.columns])
    bits = F.lit(1 << 31)                                              # sums of 31 bits a row, kept to 31 bits a range, stay within a long
    parts = [F.pmod(F.sum(F.pmod(h, bits)), bits) for h in (row, F.shiftrightunsigned(row, 31), F.xxhash64(row, F.lit(7)))]
    leaves = written.groupBy(F.col(RANGE).alias("node")).agg(F.count(F.lit(1)).alias("n"), *[p.alias(f"d{i}") for i, p in enumerate(parts)])
    leaves = leaves.withColumn("level", F.lit(0)).select("level", "node", "n", "d0", "d1", "d2")
    levels, level, width = [leaves], 0, ranges
    while width > 1:
        level, width = level + 1, -(-width // FAN_OUT)
        levels.append(leaves.groupBy(F.floor(F.col("node") / F.lit(FAN_OUT ** level)).cast("int").alias("node")).agg(*[F.sum(c).alias(c) for c in ("n", "d0", "d1", "d2")])
                      .select(F.lit(level).alias("level"), "node", "n", "d0", "d1", "d2"))
    tree = levels[0]
    for x in levels[1:]:
        tree = tree.unionByName(x)
    tree.coalesce(1).sortWithinPartitions("level", "node").write.parquet(f"{path}/digests")


def changed_ranges(spark, old: str, new: str) -> list[int]:
    """The key ranges whose digests differ: from the root down, only children of differing nodes are looked at."""
    both = [spark.read.parquet(f"{p}/digests") for p in (old, new)]
    top = max(b.agg(F.max("level")).first()[0] or 0 for b in both)
    nodes = None
    for level in range(top, -1, -1):
        o, n = (b.where((F.col("level") == level) & (F.lit(True) if nodes is None else F.floor(F.col("node") / FAN_OUT).isin(nodes))) for b in both)
        differ = o.select("node", F.struct("n", "d0", "d1", "d2").alias("o")).join(n.select("node", F.struct("n", "d0", "d1", "d2").alias("w")), "node", "full")
        nodes = sorted(r["node"] for r in differ.where(~F.col("o").eqNullSafe(F.col("w"))).select("node").collect())     # at most FAN_OUT a node above
        if not nodes:
            return []
    return nodes


def version_rows(spark, path: str, schema, ranges=None) -> DataFrame:
    """The rows of a version, or of some of its key ranges."""
    from pyspark.sql import types as T
    full = T.StructType([*schema.fields, T.StructField(RANGE, T.IntegerType())])
    df = spark.read.schema(full).parquet(f"{path}/rows")
    if ranges is not None:
        df = df.where(F.col(RANGE).isin(list(ranges)))
    return df.drop(RANGE)


def version_diff(spark, old: str, new: str, schema, keys) -> DataFrame:
    """``snapshot_diff`` of two versions that ``write_version`` wrote with equal ranges; only ranges that differ are read."""
    ranges = changed_ranges(spark, old, new)
    return snapshot_diff(version_rows(spark, old, schema, ranges), version_rows(spark, new, schema, ranges), keys)
