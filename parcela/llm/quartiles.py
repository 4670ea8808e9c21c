"""Operator 6, document fingerprints: quartile digests of hashed byte triplets.

Every byte triplet within a sliding window of five bytes is hashed into one of ``BUCKETS`` counters. A digest holds, for every
bucket, the quartile of its count among all (two bits), and a header: a check byte, the length on a logarithmic scale, and the
three quartiles relative to the largest. ``likeness`` is one minus the digests' difference, bounded at the difference that
unrelated texts have, so that it runs from 0 to 1 and equal digests give 1.

The registered query compares each text with its edited text and with the next document in ascending doc_id. Rows are
dealt into ranges of doc_id of equal size, an id with many rows (or none) into ranges of its texts' hashes; one copy of the first document
of each range goes to the range before (the very first to the last), sorted behind its rows, so every task streams its documents with the next one at hand
and moves each text once. Only rows equal in id and text stay in one range.

Defined results: null texts are empty; texts under three bytes have an empty count and differ by length and check byte; the next of
the last row is the first (itself if alone); null ids sort first; rows that repeat an id follow each other by the hash of their
text; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, prepare, read_table

BUCKETS = 512
CHUNK = 1 << 20                 # bytes whose triplets are hashed at once
BOUND = 0.30                    # share of the largest difference from which texts count as unrelated
_PAIRS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))          # distances back of a triplet's other bytes


def counts(data: bytes) -> np.ndarray:
    """Triplets per bucket; chunks overlap by the window, so no triplet is lost or counted twice."""
    total = np.zeros(BUCKETS, np.int64)
    raw = np.frombuffer(data, np.uint8)
    for start in range(0, len(raw), CHUNK):
        lo = max(0, start - 4)
        part = raw[lo:start + CHUNK].astype(np.uint32)
        skip = start - lo                                    # bytes that belong to the chunk before
        for salt, (i, j) in enumerate(_PAIRS):
            first = max(j, skip)
            if first >= len(part):
                continue
            a, b, c = part[first:], part[first - i:len(part) - i], part[first - j:len(part) - j]
            h = (a | b << 8 | c << 16) * np.uint32(0x9E3779B1) + np.uint32(salt * 0x85EBCA6B & 0xFFFFFFFF)
            h = (h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
            total += np.bincount(h >> np.uint32(23), minlength=BUCKETS)
    return total


def digest(text: str | None) -> str:
    """The digest of a whole text as hexadecimal digits."""
    data = (text or "").encode("utf-8", "surrogatepass")
    n = counts(data)
    q = np.sort(n)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    code = (n[:, None] > q[None, :]).sum(1).astype(np.uint8)
    packed = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    size = min(255, round(16 * np.log2(1 + len(data)) / 2))
    ratios = [round(255 * int(x) / max(1, int(q[2]))) for x in q[:2]]
    head = bytes([zlib.crc32(data) & 255, size, *ratios])
    return (head + packed.tobytes()).hex()


def likeness(a: str, b: str) -> float:
    """1 for equal digests, down to 0 for a difference of ``BOUND`` of the largest and beyond."""
    if a == b:
        return 1.0
    x, y = bytes.fromhex(a), bytes.fromhex(b)
    p, q = np.frombuffer(x[4:], np.uint8), np.frombuffer(y[4:], np.uint8)
    shift = np.array([0, 2, 4, 6], np.uint8)
    steps = np.abs((p[:, None] >> shift & 3).astype(np.int64) - (q[:, None] >> shift & 3))
    body = np.where(steps == 3, 4, steps).sum() / (4 * BUCKETS)
    head = (abs(x[1] - y[1]) / 255 + (abs(x[2] - y[2]) + abs(x[3] - y[3])) / 510) / 10
    return float(np.clip(1 - (body + head) / BOUND, 0.0, 0.9999))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every row of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            yield {"doc_id": b.column("doc_id"), "fingerprint": [digest(t) for t in b.column("text").to_pylist()]}

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text whose last quarter of code points gives way to the first as many (or all) of the following one."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


_LEAST = -(2 ** 63)


def cuts_of(quantiles: list[int]) -> list[tuple[int, int]]:
    """First (key, hash) of every range but the lowest: a key that is m quantiles is cut into m ranges of its hashes."""
    return [(k, _LEAST + i * (2 ** 64 // m)) for k, m in sorted(Counter(quantiles).items()) for i in range(m)]


def place(cuts: list[tuple[int, int]], key: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The range of each (key, hash): how many cuts lie at or below it."""
    keys, hashes = np.asarray([k for k, _ in cuts], np.int64), np.asarray([x for _, x in cuts], np.int64)
    first, out = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
    several = np.flatnonzero(out - first > 1)
    for at in np.unique(first[several]).tolist():                          # the keys that hold several ranges
        rows = several[first[several] == at]
        out[rows] = at + np.searchsorted(hashes[at:out[rows[0]]], h[rows], "right")
    return out.astype(np.int64)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows dealt to ranges of (id, hash of the text) and sorted: (range, look, doc_id, text); look marks the one copy of the next
    range's first row."""
    spark = prepare(docs.sparkSession)
    keyed = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(_LEAST)).alias("key"), F.xxhash64("text").alias("h"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    quantiles = keyed.approxQuantile("key", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
    cuts = cuts_of([int(q) for q in quantiles])                            # fewer than the partitions

    @F.pandas_udf("long")
    def range_of(key: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series(place(cuts, key.to_numpy(np.int64), h.to_numpy(np.int64)))

    split = {k for k, m in Counter(k for k, _ in cuts).items() if m > 1}   # only these ids need the hash of the text to tell the range
    h = F.when(F.col("key").isin(*split), F.col("h")).otherwise(F.lit(_LEAST)) if split else F.lit(_LEAST)
    dealt = keyed.withColumn("range", range_of("key", h))
    firsts = dealt.groupBy("range").agg(F.min("key").alias("key")).collect()             # a row per range that is used
    firsts.sort(key=lambda r: r["range"])
    heads = spark.createDataFrame([(r["range"], r["key"], firsts[i - 1]["range"]) for i, r in enumerate(firsts)], "range long, key long, to long")
    looks = dealt.join(F.broadcast(heads), ["key", "range"]).groupBy("to").agg(F.min(F.struct("key", "h", "doc_id", "text")).alias("r"))
    both = dealt.select("range", F.lit(0).alias("look"), "key", "h", "doc_id", "text").unionAll(
        looks.select("to", F.lit(1), "r.key", "r.h", "r.doc_id", "r.text"))
    return (both.repartitionById(max(1, n), F.col("range").cast("int"))
            .sortWithinPartitions("range", "look", "key", "h").select("range", "look", "doc_id", "text"))


def compare_edited(docs: DataFrame) -> DataFrame:
    """The rows of the registered query, from ``docs`` (doc_id, text)."""

    def run(batches: Iterable[pa.RecordBatch]):
        held = None                    # (doc_id, text, digest) that waits for its next document
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")}
            for look, doc, text in zip(b.column("look").to_pylist(), b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                text = text or ""
                print_ = digest(text)
                if held is not None:
                    d, t, p = held
                    e = edited(t, text)
                    f = digest(e)
                    for k, v in zip(out, (d, len(t), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), p, f, likeness(p, f), likeness(p, print_)), strict=True):
                        out[k].append(v)
                held = None if look else (doc, text, print_)
            yield out

    return map_batches(with_next(docs), run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                       "edited_fingerprint string, near_edited double, near_next double")


def op6_quartile_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(read_table(spark, sf_dir, "documents"))
