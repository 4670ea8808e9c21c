"""Table writes without a table format (k01, k02, k07, k08, k10).

Snapshots are written to a new version folder and then read back; no job ever
overwrites a path it is reading. All paths live under the shared folder named
by ``spark.checkpoint.dir`` unless the caller passes its own root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, root: str, committed_only: bool = True) -> list[int]:
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if not name.startswith("v="):
            continue
        done = fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))
        if done or not committed_only:
            out.append(int(name[2:]))
    return sorted(out)


def write_snapshot(df: DataFrame, root: str, partition_by=()) -> str:
    """k02: write ``df`` as the next version of the table at ``root``; return its path.
    The committed ``_SUCCESS`` marker makes the version visible to ``read_current``."""
    spark = df.sparkSession
    # a failed earlier attempt may have left an uncommitted folder: never reuse its number
    vs = _versions(spark, root, committed_only=False)
    path = f"{root.rstrip('/')}/v={(vs[-1] + 1) if vs else 0}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_current(spark: SparkSession, root: str) -> DataFrame:
    vs = _versions(spark, root)
    if not vs:
        raise FileNotFoundError(root)
    return spark.read.parquet(f"{root.rstrip('/')}/v={vs[-1]}")


def append(df: DataFrame, path: str, partition_by=()) -> None:
    """k01: append rows to a parquet table folder."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by) -> None:
    """k07/k08: dynamic partition overwrite: only the partitions present in ``df`` are replaced."""
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
