"""Helpers shared by the operators: reading tables, shared scratch tables, text columns as Python lists."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcela.session import scratch_path

# Rows and bytes handed to a Python worker at once; long texts make a batch shorter, not larger.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches that Python workers receive (texts may be very long)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder that ``spark.checkpoint.dir`` names."""
    return scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; a null text is an empty one."""
    return [x or "" for x in batch.column(column).to_pylist()]


def parts_of(texts: list, size: int) -> Iterator[slice]:
    """Consecutive texts of about ``size`` characters or bytes in all."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= size or i + 1 == len(texts):
            yield slice(start, i + 1)
            start, held = i + 1, 0


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(iterator of RecordBatch) -> iterator of dict of columns``, as mapInArrow."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    arrow, names = to_arrow_schema(_parse_datatype_string(schema)), df.columns
    if any("." in c or "`" in c for c in names):             # mapInArrow looks its columns up by unquoted names
        df = df.toDF(*(f"c{i}" for i in range(len(names))))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(b.rename_columns(names) for b in batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def crc_mod(column: str, n: int):
    """crc32 of the id as text, mod n: the folds of the contracts (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def fewest(rows: DataFrame, key: str, h: str, n: int) -> DataFrame:
    """The ``n`` rows of each ``key`` with the smallest hash ``h`` (ties by all columns), numbered from 1 as ``n``.

    Keys are few (classes). A first cut by the hash leaves some 4 n rows of a key, whatever it holds, for the exact
    order to sort; with n in the hundreds a cut that leaves fewer than n does not happen."""
    size = rows.groupBy(key).agg(F.count(F.lit(1)).alias("size_"))
    share = F.pmod(F.xxhash64(h), F.lit(1 << 30)) / F.lit(float(1 << 30))
    near = rows.join(F.broadcast(size), key).where(share < 4.0 * n / F.col("size_")).drop("size_")          # a row a class
    by = Window.partitionBy(key).orderBy(F.pmod(F.xxhash64(h), F.lit(1 << 30)), *rows.columns)
    return near.withColumn("n", F.row_number().over(by)).where(F.col("n") <= n)


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores added until none of them is one of ``columns`` (letter case does not tell names apart)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def fields(df: DataFrame, columns: list[str]) -> str:
    """``columns`` of ``df`` as the start of a schema string."""
    kinds = dict(df.dtypes)
    return "".join(f"{quoted(c)} {kinds[c]}, " for c in columns)


def quoted(column: str) -> str:
    """A column's name as ``select`` and ``col`` take it, whatever it holds."""
    return "`" + column.replace("`", "``") + "`"
