"""Registry of named queries and their SQL oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``
(DuckDB SQL over the same parquet tables). A query without an oracle is one
SQL cannot express; it is checked against brute force in ``tests/``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .pipeline import Pipeline
from .report import finalize

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import oracle_sql as O  # noqa: E402

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None, raw: bool = False):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return df if raw else finalize(df)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def P(spark, sf_dir) -> Pipeline:
    return Pipeline(spark, sf_dir)


# --- composites -------------------------------------------------------------------------
from . import catalog_composites, catalog_functions, catalog_loads, catalog_relational, catalog_joins, catalog_sinks, catalog_sources, catalog_tools, catalog_sessions, catalog_streaming, catalog_validation, catalog_ingest  # noqa: E402,F401
