"""Operator 5, SimHash near-duplicates: fingerprints of word shingles, linked within a few bits by vantage-point trees.

Fingerprints: A-Z lowered, words between ASCII white space, shingles of ``words`` words joined by a space (repeats count), XXH64
with seed 42; a bit is set if it is set in over half of the hashes.

Links: equal fingerprints collapse first. A routing tree, fitted on a bounded sample of the distinct fingerprints
(``SAMPLE``), parts all of them into shards by their Hamming distance to vantage points. A fingerprint is sent to its home shard and,
as a guest, to every later shard that the triangle bound lets hold one within ``bits``; every pair within ``bits`` meets in the
later home of the two. Inside a shard the same split goes on down to blocks that are compared bit by bit, links are merged on the
spot, and the shard emits a spanning forest. Shards over ``BLOCK`` points are cut into blocks and the points of earlier blocks
visit the later ones. The forests are joined by distributed components.

Defined results: texts without words, empty and null ones have fingerprint zero and link like any other; a null doc_id takes part by
its fingerprint, but component_id is the smallest doc_id that is not null (null if there is none); repeated rows are
returned each; further columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fields, fresh, map_batches, materialize, prepare, quoted, read_table
from .components import components
from .vantage import Router, hamming, hamming_forest

WORDS, BITS, SEED = 3, 2, 42
SAMPLE = 32_768            # distinct fingerprints that fit the routing tree
PER_LEAF = 4096            # distinct fingerprints wanted in a shard, as long as the sample allows
BLOCK = 65_536             # home points of a shard that are compared in one task


def fingerprint(text: str | None, words: int = WORDS) -> int:
    tokens = (text or "").encode("utf-8").lower().split()         # bytes: only A-Z and ASCII white space count
    if not tokens:
        return 0
    if len(tokens) <= words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(tokens), SEED)]
    else:
        line = b" ".join(tokens)
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[:len(tokens) - words + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[s:e], SEED) for s, e in zip(starts, ends[words - 1:].tolist(), strict=True)]
    raw = np.asarray(hashes, ">u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for s in range(0, len(raw), 1 << 16):
        counts += np.unpackbits(raw[s:s + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(raw)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` and f: the fingerprint as a signed long."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            f = np.asarray([fingerprint(t, words) for t in b.column("text").to_pylist()], np.uint64)
            yield {c: b.column(c) for c in keep} | {"f": f.view(np.int64)}

    return map_batches(docs.select(*map(quoted, keep), "text"), run, fields(docs, list(keep)) + "f long")


def links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """a, b: a forest of the links between the distinct fingerprints in ``distinct.f``, shard by shard."""
    spark = distinct.sparkSession
    n = distinct.count()
    leaves = max(1, min(-(-n // PER_LEAF), SAMPLE // 16))
    every = max(1, n // SAMPLE)
    sample = distinct.where(F.pmod(F.xxhash64("f"), F.lit(every)) == 0).limit(2 * SAMPLE).toPandas()["f"]
    router = spark.sparkContext.broadcast(Router(np.sort(sample.to_numpy(np.int64)).view(np.uint64), leaves, hamming, gap=1))

    def at_home(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            yield {"leaf": router.value.home(np.asarray(b.column("f"), np.int64).view(np.uint64))}

    sizes = map_batches(distinct, at_home, "leaf int").groupBy("leaf").count().collect()       # a row per shard
    blocks = spark.sparkContext.broadcast({r["leaf"]: -(-r["count"] // BLOCK) for r in sizes})

    def route(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            f = np.asarray(b.column("f"), np.int64).view(np.uint64)
            home = router.value.home(f)
            count = np.asarray([blocks.value[x] for x in home.tolist()])
            own = (f * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % count
            rows, leaf = router.value.visits(f, np.full(len(f), float(bits)))
            later = leaf > home[rows]
            out = [(home, own, f, np.ones(len(f), bool))]
            for k in range(1, max(blocks.value.values(), default=1)):           # later blocks of the same shard
                more = own + k < count
                out.append((home[more], own[more] + k, f[more], np.zeros(more.sum(), bool)))
            rows, leaf = rows[later], leaf[later]
            wide = np.asarray([blocks.value.get(x, 0) for x in leaf.tolist()], np.int64)
            for k in range(int(wide.max(initial=0))):
                more = wide > k
                out.append((leaf[more], np.full(more.sum(), k), f[rows[more]], np.zeros(more.sum(), bool)))
            leaf, block, f, is_home = (np.concatenate(x) for x in zip(*out, strict=True))
            yield {"leaf": leaf, "block": block, "f": f.view(np.int64), "home": is_home}

    def forest(pdf: pd.DataFrame) -> pd.DataFrame:
        f, is_home = pdf["f"].to_numpy(np.int64), pdf["home"].to_numpy(bool)
        f = np.concatenate([np.sort(f[is_home]), np.sort(f[~is_home])])
        n = int(is_home.sum())
        roots = hamming_forest(f[:n].view(np.uint64), f[n:].view(np.uint64), bits).roots()
        linked = roots != np.arange(len(f))
        return pd.DataFrame({"a": f[linked], "b": f[roots[linked]]})

    return (map_batches(distinct, route, "leaf int, block long, f long, home boolean")
            .groupBy("leaf", "block").applyInPandas(forest, "a long, b long"))


def firsts(prints: DataFrame, order: Column, bits: int = BITS) -> DataFrame:
    """g, first: the smallest ``order`` among the rows of ``prints`` in the component of every fingerprint g."""
    classes = materialize(prints.groupBy("f").agg(F.min(order).alias("own")), "classes")
    roots = components(links(classes.select("f"), bits), "a", "b")
    linked = roots.join(classes, roots["node"] == classes["f"]).select("f", "root", "own")
    lowest = linked.groupBy("root").agg(F.min("own").alias("lowest"))
    linked = linked.join(lowest, "root").select(F.col("f").alias("g"), "lowest")
    return classes.join(linked, classes["f"] == linked["g"], "left").select(
        F.col("f").alias("g"), F.coalesce("lowest", "own").alias("first"))


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """doc_id, fingerprint, component_id of every row of ``docs`` (doc_id, text)."""
    prints = materialize(fingerprints(docs, words), "simhash")
    named = firsts(prints, F.col("doc_id"), bits)
    return prints.join(named, prints["f"] == named["g"]).select(
        "doc_id", F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"), F.col("first").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """One row of ``docs`` (doc_id, text and more) of every component: the smallest doc_id, nulls last, then the smallest hash of
    the text, then any one of the rows that are left. Rows are told apart by a key that is written before it is used."""
    key, = fresh(docs.columns, "k_row")
    keyed = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    base = keyed.select("doc_id", F.xxhash64("text").alias("h"), F.col(key).alias("k"), "text")
    prints = materialize(fingerprints(base, words, ("doc_id", "h", "k")), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "k")
    stay = firsts(prints, order, bits).select(F.col("first.k").alias("stays")).distinct()
    return keyed.join(stay, keyed[key] == stay["stays"], "left_semi").select(*map(quoted, docs.columns))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
