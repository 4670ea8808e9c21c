"""Output conventions for registered queries: stable value types for comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def finalize(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round DOUBLE columns to ``digits`` places and make timestamps zone-free."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def double_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
