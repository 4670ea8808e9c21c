"""Operator 7, packing: best-fit decreasing into windows of ``capacity`` tokens.

A document's ids (with the end id) are first cut into full windows, each a sequence of its own; the rest, shorter than a
window, goes to the tightest open window. A segment tree over the remaining capacities 0..capacity finds it: leaf c
counts the open windows with c tokens left, and the first occupied leaf from the piece's length on is the best fit.

Texts never move: ids, cuts and checksums are made where the text is read, and only one narrow row a piece is written and
shuffled. Pieces are packed in groups of about ``group`` pieces, chosen by a hash of the whole piece and of a key that its row
is written with, so that no document, source or group of copies fills one of them, rows that repeat included; packing thousands at a time wastes at most a few windows a group.

Defined results: null and empty texts hold the end id alone; repeated rows and null ids are pieces of their own; further
columns are ignored; an empty table gives an empty result. Pieces of equal length are packed by doc_id and start.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, materialize, prepare, read_table, texts_of
from .subword import BYTE_BPE, little_endian, tokenizer_path, worker_ids

CAPACITY = 2048
END_ID = 1
GROUP = 4096


class BestFit:
    """Open windows by remaining capacity, and the tightest one that takes a piece."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.leaves = 1 << (capacity + 1).bit_length()
        self.tree = [0] * (2 * self.leaves)                   # open windows below each node
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.used: list[int] = []                             # tokens in each window

    def _add(self, left: int, by: int) -> None:
        node = left + self.leaves
        while node:
            self.tree[node] += by
            node >>= 1

    def tightest(self, size: int) -> int:
        """The smallest remaining capacity of at least ``size``, or -1."""
        node = size + self.leaves
        if self.tree[node]:
            return size
        while node > 1:
            if not node & 1 and self.tree[node + 1]:          # a right neighbour holds larger capacities
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return -1

    def place(self, size: int) -> tuple[int, int]:
        """Window and offset of a piece."""
        left = self.tightest(size)
        if left < 0:
            window, left = len(self.used), self.capacity
            self.used.append(0)
        else:
            window = self.open[left].pop()
            self._add(left, -1)
        offset = self.used[window]
        self.used[window] += size
        if left > size:
            self.open[left - size].append(window)
            self._add(left - size, 1)
        return window, offset


def pieces(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)
    path = tokenizer or tokenizer_path(BYTE_BPE)
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterable[pa.RecordBatch]):
        encoder = worker_ids(path)
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
            for doc, ids in zip(b.column("doc_id").to_pylist(), encoder.encode_batch(texts_of(b)), strict=True):
                ids = memoryview(ids + end)
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    out["doc_id"].append(doc)
                    out["start"].append(start)
                    out["length"].append(min(capacity, n - start))
                    out["ids_crc32"].append(zlib.crc32(ids[4 * start:4 * (start + capacity)]))
                    out["doc_tokens"].append(n)
            yield out

    return map_batches(docs.select("doc_id", "text"), cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """The pieces of ``docs`` with sequence_id and offset."""
    cut = materialize(pieces(docs, tokenizer, end_id, capacity).withColumn("row", F.monotonically_increasing_id()), "pieces")
    groups = -(-cut.count() // group) or 1

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "no_id", "doc_id", "start", "ids_crc32"], ascending=[False, False, True, True, True])
        windows = BestFit(capacity)
        placed = np.asarray([windows.place(n) for n in pdf["length"].tolist()], np.int64).reshape(-1, 2)
        return pdf.assign(sequence_id=pdf["g"].astype("int64") * (1 << 32) + placed[:, 0], offset=placed[:, 1]).drop(columns="g")

    kept = cut.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", F.col("doc_id").isNull().alias("no_id"),
                      F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens", "row"), F.lit(groups)).alias("g"))          # pandas has no null integers
    done = kept.groupBy("g").applyInPandas(fill, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, no_id boolean, "
                                                 "sequence_id long, offset long")
    return done.select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), *done.columns[1:5], "sequence_id", "offset")


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """The packed ids themselves: sequence_id and tokens, each piece at its offset (doc_id must name one row of ``docs``)."""
    prepare(docs.sparkSession)
    path = tokenizer or tokenizer_path(BYTE_BPE)
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterable[pa.RecordBatch]):
        encoder = worker_ids(path)
        for b in batches:
            out: dict[str, list] = {"doc_id": [], "start": [], "tokens": []}
            for doc, ids in zip(b.column("doc_id").to_pylist(), encoder.encode_batch(texts_of(b)), strict=True):
                tokens = little_endian(ids + end)
                for start in range(0, len(tokens), capacity):
                    out["doc_id"].append(doc)
                    out["start"].append(start)
                    out["tokens"].append(tokens[start:start + capacity])
            yield out

    parts = map_batches(docs.select("doc_id", "text"), cut, "doc_id long, start long, tokens array<long>")
    keyed = parts.join(packed.select("doc_id", "start", "sequence_id", "offset"),
                       parts["doc_id"].eqNullSafe(packed["doc_id"]) & (parts["start"] == packed["start"]))
    return (keyed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "tokens"))).alias("x"))
            .select("sequence_id", F.flatten(F.col("x.tokens")).alias("tokens")))


def op7_pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
