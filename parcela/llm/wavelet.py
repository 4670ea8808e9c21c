"""Operator 3, token-id output: one wavelet matrix per shard.

A shard holds the ids of whole documents in ascending doc_id order, end ids included, as a wavelet matrix: one bit-plane
per bit of the largest id, each with a directory of ones before every block. ``WaveletMatrix`` answers access, rank, select
and count on the planes and restores the whole sequence. A shard's file holds the planes (each compressed by zstandard if
that makes it smaller), the directories and the table of documents; Spark writes the files as binary rows of a Parquet
folder in the shared folder, so that task retries and lost executors leave whole files only.

Order: documents are range-partitioned by (doc_id, hash of the text), sorted within a partition and streamed into shards of
about ``shard_tokens`` ids, so a worker holds one shard at a time (a longer document makes a longer shard). Every shard
knows the ids before it in its partition; the ids before a partition come from one total per partition.

Defined results: null and empty texts hold the end id alone; null ids sort first; rows that repeat a doc_id stand side by
side, ordered by the hash of their text; further columns are ignored; an empty table gives no files and an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, prepare, read_table, scratch, texts_of
from .subword import WORD_BPE, little_endian, tokenizer_path, worker_ids

MAGIC = b"WMX1"
BLOCK = 512                   # bits of a directory block
SHARD_TOKENS = 1_000_000
END_ID = 2


class WaveletMatrix:
    """``planes`` from the highest bit down: packed bits, ones before each block, zeros in the plane."""

    def __init__(self, n: int, planes: list[tuple[np.ndarray, np.ndarray, int]]):
        self.n, self.planes = n, planes
        # zeros before each block, as the directories tell them; made when first asked for
        self._zeros: dict[int, np.ndarray] = {}

    @staticmethod
    def build(ids: np.ndarray) -> WaveletMatrix:
        levels = int(ids.max(initial=0)).bit_length()
        planes, seq = [], ids.astype(np.uint16 if levels <= 16 else np.uint32)
        for level in range(levels - 1, -1, -1):
            bits = seq & seq.dtype.type(1 << level) != 0
            packed = np.packbits(bits, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % (BLOCK // 8), np.uint8)])
            ones = np.bitwise_count(packed.reshape(-1, BLOCK // 8)).sum(1, dtype=np.int64)
            zeros = seq.compress(~bits)
            planes.append((packed, np.concatenate([[0], np.cumsum(ones)]).astype(np.int64), len(zeros)))
            seq = np.concatenate([zeros, seq.compress(bits)])
        return WaveletMatrix(len(ids), planes)

    def _ones(self, plane, i: int) -> int:
        """Ones before position i of a plane."""
        packed, before, _ = plane
        block, rest = divmod(i, BLOCK)
        at = block * (BLOCK // 8)
        part = int.from_bytes(packed[at:at + (rest + 7) // 8].tobytes(), "little") & ((1 << rest) - 1)
        return int(before[block]) + part.bit_count()

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in self.planes:
            bit = plane[0][i >> 3] >> (i & 7) & 1
            ones = self._ones(plane, i)
            i = plane[2] + ones if bit else i - ones
            value = value << 1 | int(bit)
        return value

    def _range(self, symbol: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a symbol before position ``end`` lie after the last plane."""
        lo, hi = 0, end
        if symbol >> len(self.planes):
            return 0, 0
        for k, plane in enumerate(self.planes):
            a, b = self._ones(plane, lo), self._ones(plane, hi)
            lo, hi = (plane[2] + a, plane[2] + b) if symbol >> (len(self.planes) - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, symbol: int, i: int) -> int:
        """Occurrences of a symbol before position i."""
        lo, hi = self._range(symbol, min(i, self.n))
        return hi - lo

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def select(self, symbol: int, k: int) -> int:
        """The position of the k-th occurrence (from 0) of a symbol."""
        lo, hi = self._range(symbol, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for level, plane in enumerate(reversed(self.planes)):
            one = symbol >> level & 1
            i = self._select_bit(level, plane, i - plane[2] if one else i, one)
        return i

    def _select_bit(self, level: int, plane, k: int, one: int) -> int:
        packed, starts, _ = plane
        if not one:
            if level not in self._zeros:
                self._zeros[level] = np.arange(len(starts), dtype=np.int64) * BLOCK - starts
            starts = self._zeros[level]
        block = int(np.searchsorted(starts, k, "right")) - 1
        at = block * (BLOCK // 8)
        bits = np.unpackbits(packed[at:at + BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == one)[k - int(starts[block])])

    def positions(self, symbol: int) -> list[int]:
        return [self.select(symbol, k) for k in range(self.count(symbol))]

    def to_array(self) -> np.ndarray:
        """The whole sequence, from the last plane up: each step undoes one stable partition."""
        seq = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level, (packed, _, zeros) in enumerate(reversed(self.planes)):
            bits = np.unpackbits(packed, count=self.n, bitorder="little").view(bool)
            out = np.empty_like(seq)
            out[np.flatnonzero(~bits)] = seq[:zeros]
            out[np.flatnonzero(bits)] = seq[zeros:] | seq.dtype.type(1 << level)
            seq = out
        return seq.astype(np.uint32)

    def dump(self) -> bytes:
        out = [struct.pack("<QI", self.n, len(self.planes))]
        for packed, before, zeros in self.planes:
            raw, steps = packed.tobytes(), np.diff(before).astype("<u2").tobytes()
            small = zstandard.ZstdCompressor(1).compress(raw)
            body = small if len(small) < len(raw) else raw
            out += [struct.pack("<QQQ?", zeros, len(raw), len(body), body is small), body, steps]
        return b"".join(out)

    @staticmethod
    def load(data: memoryview) -> WaveletMatrix:
        n, levels = struct.unpack_from("<QI", data)
        at, planes = 12, []
        for _ in range(levels):
            zeros, size, stored, is_small = struct.unpack_from("<QQQ?", data, at)
            at += 25
            body = data[at:at + stored]
            raw = zstandard.ZstdDecompressor().decompress(body, max_output_size=size) if is_small else body
            at += stored
            blocks = size * 8 // BLOCK
            steps = np.frombuffer(data[at:at + 2 * blocks], "<u2").astype(np.int64)
            at += 2 * blocks
            planes.append((np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum(steps)]), zeros))
        return WaveletMatrix(n, planes)


def dump_shard(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """One file: magic, number of documents, their ids (with a mask of nulls) and lengths, the matrix."""
    known = np.asarray([d is not None for d in doc_ids], bool)
    return b"".join([MAGIC, struct.pack("<Q", len(doc_ids)), np.asarray([d or 0 for d in doc_ids], "<i8").tobytes(),
                     known.tobytes(), np.asarray(lengths, "<u8").tobytes(), WaveletMatrix.build(ids).dump()])


def load_shard(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    view = memoryview(data)
    if view[:4] != MAGIC:
        raise ValueError("not a wavelet shard")
    n = struct.unpack_from("<Q", view, 4)[0]
    ids, known = np.frombuffer(view[12:12 + 8 * n], "<i8"), np.frombuffer(view[12 + 8 * n:12 + 9 * n], bool)
    lengths = np.frombuffer(view[12 + 9 * n:12 + 17 * n], "<u8").astype(np.int64)
    return [d if k else None for d, k in zip(ids.tolist(), known, strict=True)], lengths, WaveletMatrix.load(view[12 + 17 * n:])


def write_shards(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the shards of ``docs`` (doc_id, text) under ``path``: part, before (ids of the partition's earlier
    shards), n_tokens, file."""
    prepare(docs.sparkSession)
    name = tokenizer or tokenizer_path(WORD_BPE)
    end = int(end_id).to_bytes(4, "little")
    ordered = (docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
               .repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h"))

    def shards(batches: Iterable[pa.RecordBatch]):
        encoder, part = worker_ids(name), TaskContext.get().partitionId()
        ids: list[bytes] = []
        doc_ids: list[int | None] = []
        before = held = 0

        def shard():
            flat = little_endian(b"".join(ids))
            return {"part": [part], "before": [before], "n_tokens": [len(flat)],
                    "file": [dump_shard(doc_ids, [len(x) // 4 for x in ids], flat)]}

        for b in batches:
            for doc, x in zip(b.column("doc_id").to_pylist(), encoder.encode_batch(texts_of(b)), strict=True):
                doc_ids.append(doc)
                ids.append(x + end)
                held += len(x) // 4 + 1
                if held >= shard_tokens:
                    yield shard()
                    before += held
                    ids, doc_ids, held = [], [], 0
        if doc_ids:
            yield shard()

    map_batches(ordered, shards, "part int, before long, n_tokens long, file binary").write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    files = prepare(spark).read.schema("part int, before long, n_tokens long, file binary").parquet(path)
    totals = {r["part"]: r["n"] for r in files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    base, at = {}, 0                       # one number per partition of the writing job
    for part in sorted(totals):
        base[part] = at
        at += totals[part]
    bases = spark.sparkContext.broadcast(base)

    def rows(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            for k in range(b.num_rows):
                doc_ids, lengths, matrix = load_shard(b.column("file")[k].as_py())
                ids = matrix.to_array().astype("<u4")
                ends = np.cumsum(lengths)
                raw = memoryview(ids.tobytes())
                starts = ends - lengths
                yield {"doc_id": doc_ids, "n_tokens": lengths,
                       "start": starts + bases.value[b.column("part")[k].as_py()] + b.column("before")[k].as_py(),
                       "ids_crc32": [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]}

    return map_batches(files, rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3_wavelet_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "wavelet")
    write_shards(read_table(spark, sf_dir, "documents"), path)
    return read_shards(spark, path)
