"""parcela: property and neighbourhood analytics expressed as Spark DataFrame plans.

Layout
------
functions/  Column -> Column expressions (text, numbers, dates, geo, labels, scoring)
operators/  DataFrame -> DataFrame building blocks (dedupe, latest, upsert, diff,
            distributed rank, grid spatial joins, pivots, scaling, windows, unpivot)
sources/    readers and parsers for landed payloads plus bindings from the test tables
plans/      silver / gold builds, query tools, session-log jobs, validation queries
streaming/  incremental (availableNow) loads with replay-safe foreachBatch sinks
"""

__version__ = "0.1.0"
