"""Frequent items of a whole corpus from bounded summaries: one per task, merged in groups.

A task counts every item of its documents in a counter that is cut back to its largest entries whenever it outgrows
four times the wanted size (lossy counting), and emits one packed row. Summaries are merged in about sqrt(tasks) groups and
the driver sees one bounded summary a group, so no item is ever shuffled on its own. Only used for tables whose content
cannot change a result (caches, lexicons).
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Callable, Iterable

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, texts_of

MAX_ITEM = 64          # characters; longer items stay out of a table of frequent ones


def _pack(counts: Counter, size: int) -> bytes:
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]
    return zlib.compress(json.dumps(top).encode("utf-8"), 1)


def _unpack(data: bytes) -> dict[str, int]:
    return dict(json.loads(zlib.decompress(data)))


def frequent_items(docs: DataFrame, items: Callable[[list[str]], Iterable[str]], size: int) -> list[str]:
    """At most ``size`` frequent items of ``docs.text``, most frequent first; ``items`` cuts a batch of texts."""

    def count(batches: Iterable[pa.RecordBatch]):
        counts: Counter = Counter()
        for b in batches:
            counts.update({w: n for w, n in Counter(items(texts_of(b))).items() if len(w) <= MAX_ITEM})
            if len(counts) > 4 * size:
                counts = Counter(dict(counts.most_common(2 * size)))
        if counts:
            yield {"task": [TaskContext.get().partitionId()], "summary": [_pack(counts, size)]}

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total: Counter = Counter()
        for data in pdf["summary"]:
            total.update(_unpack(data))
            if len(total) > 4 * size:
                total = Counter(dict(total.most_common(2 * size)))
        return pd.DataFrame({"summary": [_pack(total, size)]})

    parts = map_batches(docs.select("text"), count, "task int, summary binary")
    # Task t - 1 goes to group t - floor-square below t: of n tasks, about 2 sqrt(n) groups of sqrt(n) at most.
    root = F.ceil(F.sqrt(parts["task"] + 1))
    merged = parts.groupBy((parts["task"] + 1 - (root - 1) * (root - 1)).alias("g")).applyInPandas(merge, "summary binary")
    total: Counter = Counter()
    for row in merged.toLocalIterator():
        total.update(_unpack(bytes(row["summary"])))
    return [w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:size]]
