"""Operator 1, fuzzy line dedup: one line stays of every group of near-equal lines of the whole corpus.

Lines are the text between line feeds, compared without white space at their ends; blank lines always stay. Two lines are linked if
the Jaccard similarity of their sets of ``SHINGLE``-character shingles is at least ``THRESHOLD`` (a shorter line is one shingle). Of
every component of links the first line stays: the smallest doc_id, then the smallest line number.

1. Signatures: ``BANDS`` bands of ``ROWS`` minima under multiplicative hash functions (at the threshold a pair meets in some band
   with probability 0.997). A task sends each distinct line once, as 16 bytes a band, packed by the band's bucket.
2. Candidates: a bucket keeps the bands that two different lines share. Equal sets of lines of several bands become one
   group. A bucket beyond ``BUCKET_BYTES`` (a very common band) is unpacked and grouped by Spark's own aggregates instead.
3. Verification: the texts of candidate lines (found by a Bloom filter of fixed size, then joined exactly) meet in their groups.
   Every line is compared with all lines of its group that are not yet in its component, so all links between components are
   found and no pairs are emitted. Groups over ``GROUP`` lines are cut into blocks and every two blocks meet.
4. Distributed components, then the first occurrence of each component; texts are rebuilt by one join with the lines that stay.

Defined results: null and empty texts have no lines and stay; a document may lose all lines and then has an empty text; rows
that repeat doc_id and text are one document (each copy returns the same lines); a null doc_id sorts first; further columns
pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fields, fresh, map_batches, materialize, parts_of, prepare, quoted, read_table
from .components import components

SHINGLE, THRESHOLD = 8, 0.8
BANDS, ROWS = 8, 3
SPREAD = 4                     # buckets per shuffle partition
FLUSH = 250_000                # lines a task packs at once
BUCKET_BYTES = 256 << 20       # packed bands that one task may group
GROUP = 16_384                 # lines of a group that one task compares
BLOOM_BITS = 1 << 26           # 8 MB, whatever the corpus
_FACTORS = (np.random.default_rng(1).integers(1 << 31, size=(BANDS * ROWS,), dtype=np.int64).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def lines_of(text: str | None) -> list[tuple[int, str]]:
    """Number and content of every line that is not blank."""
    return [(i, s) for i, line in enumerate((text or "").split("\n")) if (s := line.strip())]


def contents(texts: Iterable[str | None]) -> Iterable[str]:
    """The contents of ``lines_of`` of many texts."""
    return filter(None, map(str.strip, chain.from_iterable([t.split("\n") for t in texts if t])))


def line_key(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))


def _windows(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the shingles of all lines in one array, with each line's start and end in it."""
    padded = [x if len(x) >= SHINGLE else x.ljust(SHINGLE, "\n") for x in lines]
    chars = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, padded), np.int64, len(padded))
    ends = np.cumsum(size)
    h = np.zeros(max(0, len(chars) - SHINGLE + 1), np.uint64)
    for i in range(SHINGLE):
        h = (h + chars[i:len(h) + i] + np.uint64(1)) * _ODD
    h ^= h >> np.uint64(31)
    return h * _ODD, ends - size, ends - SHINGLE + 1


def bands_of(lines: list[str]) -> np.ndarray:
    """The band hashes of every line: (lines, BANDS) unsigned 64-bit numbers."""
    out = np.zeros((len(lines), BANDS), np.uint64)
    first, held = 0, 0
    for i, line in enumerate(lines):
        held += len(line) + SHINGLE
        if held >= 1 << 18 or i == len(lines) - 1:
            h, starts, ends = _windows(lines[first:i + 1])
            h = np.append((h >> np.uint64(32)).astype(np.uint32), np.uint32(0))
            cuts = np.stack([starts, ends], 1).reshape(-1)
            for band in range(BANDS):
                mixed = np.full(len(starts), band + 1, np.uint64)
                for row in range(ROWS):
                    x = h * _FACTORS[band * ROWS + row]
                    x ^= x >> np.uint32(15)
                    low = np.minimum.reduceat(x * _FACTORS[band * ROWS + row], cuts)[::2]
                    mixed = (mixed ^ low) * _ODD
                    mixed ^= mixed >> np.uint64(29)
                out[first:i + 1, band] = mixed
            first, held = i + 1, 0
    return out


def packed_bands(docs: DataFrame, buckets: int) -> DataFrame:
    """bucket, entries: (band, ref) pairs of the distinct lines of each task, packed by bucket of the band."""

    def run(batches: Iterable[pa.RecordBatch]):
        seen: set[int] = set()
        held: dict[int, str] = {}

        def pack():
            band = bands_of(list(held.values()))
            entries = np.empty((band.size, 2), np.uint64)
            entries[:, 0] = band.reshape(-1)
            entries[:, 1] = np.repeat(np.fromiter(held, np.uint64, len(held)), BANDS)
            bucket = (entries[:, 0] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            entries, bucket = entries[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            parts = np.split(entries, cuts)
            return {"bucket": bucket[np.concatenate([[0], cuts])], "entries": [p.astype("<u8").tobytes() for p in parts]}

        for b in batches:
            for line in dict.fromkeys(contents(b.column("text").to_pylist())):
                ref = int.from_bytes(line_key(line)[:8], "little")
                if ref not in seen:
                    seen.add(ref)
                    held[ref] = line
            if len(held) >= FLUSH or sum(map(len, held.values())) > 64 << 20:
                yield pack()
                held = {}
            if len(seen) > 8 * FLUSH:
                seen.clear()
        if held:
            yield pack()

    return map_batches(docs.select("text"), run, "bucket long, entries binary")


def candidate_groups(docs: DataFrame) -> DataFrame:
    """grp, ref: lines (by the first half of their key) that share a band with another one."""
    spark = docs.sparkSession
    buckets = SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = materialize(packed_bands(docs, buckets), "bands")
    sizes = packed.groupBy("bucket").agg(F.sum(F.length("entries")).alias("n")).where(F.col("n") > BUCKET_BYTES).collect()
    large = [r["bucket"] for r in sizes]                     # at most the number of buckets

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        e = np.frombuffer(b"".join(pdf["entries"]), "<u8").reshape(-1, 2)
        e = e[np.lexsort((e[:, 1], e[:, 0]))]
        e = e[np.concatenate([[True], (e[1:] != e[:-1]).any(1)])] if len(e) else e
        start = np.flatnonzero(np.concatenate([[True], e[1:, 0] != e[:-1, 0]])) if len(e) else np.zeros(0, int)
        size = np.diff(np.append(start, len(e)))
        mixed = (e[:, 1] ^ e[:, 1] >> np.uint64(31)) * _ODD
        name = np.add.reduceat(mixed ^ mixed >> np.uint64(29), start) * _ODD if len(e) else mixed      # of the set of lines
        keep = np.repeat(size > 1, size)
        return pd.DataFrame({"grp": np.repeat(name, size)[keep].view(np.int64), "ref": np.ascontiguousarray(e[keep, 1]).view(np.int64)})

    def unpack(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            for data in b.column("entries").to_pylist():
                e = np.frombuffer(data, "<i8").reshape(-1, 2)
                yield {"grp": e[:, 0], "ref": e[:, 1]}

    groups = packed.where(~F.col("bucket").isin(large)).groupBy("bucket").applyInPandas(group, "grp long, ref long")
    if large:
        rows = map_batches(packed.where(F.col("bucket").isin(large)).select("entries"), unpack, "grp long, ref long").distinct()
        shared = rows.groupBy("grp").agg(F.count("*").alias("n")).where("n > 1").select("grp")
        groups = groups.union(rows.join(shared, "grp").select("grp", "ref"))
    return materialize(groups.distinct(), "groups")


def bloom(refs: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size over ``refs.ref``: its words are or-ed on the executors, one row a slice."""
    slices = 256
    width = BLOOM_BITS // slices

    def bits(pdf: pd.DataFrame) -> pd.DataFrame:
        mask = np.zeros(width, bool)
        mask[pdf["bit"].to_numpy()] = True
        return pd.DataFrame({"s": pdf["s"].head(1), "mask": [np.packbits(mask, bitorder="little").tobytes()]})

    def where(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            at = np.unique(_bloom_bits(np.asarray(b.column("ref"), np.int64).view(np.uint64)))
            yield {"s": at // width, "bit": at % width}

    rows = map_batches(refs.select("ref"), where, "s long, bit long").distinct().groupBy("s").applyInPandas(bits, "s long, mask binary")
    out = np.zeros(BLOOM_BITS // 8, np.uint8)
    for r in rows.collect():
        out[r["s"] * width // 8:(r["s"] + 1) * width // 8] = np.frombuffer(bytes(r["mask"]), np.uint8)
    return out


def _bloom_bits(refs: np.ndarray) -> np.ndarray:
    return (np.concatenate([refs, refs >> np.uint64(32)]) % np.uint64(BLOOM_BITS)).astype(np.int64)


def _in_bloom(filter_: np.ndarray, refs: np.ndarray) -> np.ndarray:
    at = _bloom_bits(refs)
    hit = (filter_[at >> 3] >> (at & 7) & 1).astype(bool)
    return hit[:len(refs)] & hit[len(refs):]


def linked(lines: list[str], threshold: float = THRESHOLD) -> np.ndarray:
    """The component (a line's index) of every line under exact Jaccard similarity of at least the threshold."""
    h, starts, ends = _windows(lines)
    sets = [np.unique(h[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets)
    begin = np.cumsum(size) - size
    root = np.arange(len(lines))
    for i in range(len(lines) - 1):
        rest = np.flatnonzero(root[i + 1:] != root[i]) + i + 1
        rest = rest[np.minimum(size[rest], size[i]) >= threshold * np.maximum(size[rest], size[i])]
        if not len(rest):
            continue
        own = sets[i]
        if len(rest) == 1:
            common = np.asarray([len(np.intersect1d(own, sets[rest[0]], assume_unique=True))])
        else:
            rows = np.concatenate([flat[begin[j]:begin[j] + size[j]] for j in rest.tolist()])
            at = np.minimum(np.searchsorted(own, rows), len(own) - 1)
            ends_ = np.cumsum(size[rest])
            common = np.add.reduceat((own[at] == rows).astype(np.int64), np.concatenate([[0], ends_[:-1]]))
        hit = rest[common >= threshold * (size[i] + size[rest] - common) - 1e-9]
        if len(hit):
            joined = np.unique(np.append(root[hit], root[i]))
            root[np.isin(root, joined)] = joined[0]
    return root


def linked_pairs(lines: list[str], threshold: float = THRESHOLD) -> np.ndarray:
    """Whether lines 0 and 1, 2 and 3, ... are linked: ``linked`` for many groups of two at once."""
    h, starts, ends = _windows(lines)
    size = ends - starts
    ends_ = np.cumsum(size)
    at = np.arange(int(size.sum())) + np.repeat(starts - ends_ + size, size)
    x = (h[at] & ~np.uint64(1)) | np.repeat(np.arange(len(lines), dtype=np.uint64) & np.uint64(1), size)      # the last bit tells the line
    cuts = np.concatenate([[0], ends_[1::2]])
    for s, e in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
        x[s:e].sort()
    first = np.zeros(len(x), bool)
    first[cuts[:-1]] = True
    new = first.copy()
    new[1:] |= x[1:] != x[:-1]                                         # the distinct shingles of either line
    both = np.zeros(len(x), bool)
    both[1:] = ~first[1:] & (x[1:] == x[:-1] + np.uint64(1)) & (x[1:] & np.uint64(1)).astype(bool)
    n, common = (np.add.reduceat(a.astype(np.int64), cuts[:-1]) for a in (new, both))
    return common >= threshold * (n - common) - 1e-9                   # n counts the common ones twice


def line_links(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """a, b: keys of linked lines, a forest of every group."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(bloom(groups))

    def texts(batches: Iterable[pa.RecordBatch]):
        sent: set[bytes] = set()
        for b in batches:
            found = {line_key(line): line for line in dict.fromkeys(contents(b.column("text").to_pylist()))}
            keys = [k for k in found if k not in sent]
            ref = np.frombuffer(b"".join(k[:8] for k in keys), "<u8")
            keep = np.flatnonzero(_in_bloom(table.value, ref)).tolist()
            keys = [keys[i] for i in keep]
            sent.update(keys)
            if len(sent) > FLUSH:
                sent.clear()
            yield {"ref": ref[keep].view(np.int64), "key": keys, "line": [found[k] for k in keys]}

    lines = map_batches(docs.select("text"), texts, "ref long, key binary, line string").groupBy("key").agg(F.first("ref").alias("ref"), F.first("line").alias("line"))
    sizes = groups.groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select("grp", F.ceil(F.col("n") / GROUP).alias("blocks"))
    cut = groups.join(sizes, "grp", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("ref"), "blocks")
    cut = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cut = cut.select(F.xxhash64("grp", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), "ref")
    units = cut.join(lines, "ref").withColumn("part", F.pmod("unit", F.lit(SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions")))))

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        pdf = pdf.sort_values(["unit", "key"], ignore_index=True)
        unit, keys, lines = pdf["unit"].to_numpy(), pdf["key"].tolist(), pdf["line"].tolist()
        cuts = [0, *(np.flatnonzero(np.diff(unit)) + 1).tolist(), len(unit)]
        two = [s for s, e in zip(cuts, cuts[1:], strict=False) if e - s == 2]
        for part in parts_of([lines[s] + lines[s + 1] for s in two], 1 << 18):
            for s, hit in zip(two[part], linked_pairs([x for s in two[part] for x in lines[s:s + 2]]).tolist(), strict=True):
                if hit:
                    a.append(keys[s + 1])
                    b.append(keys[s])
        for s, e in zip(cuts, cuts[1:], strict=False):
            if e - s > 2:
                for i, r in enumerate(linked(lines[s:e]).tolist()):
                    if i != r:
                        a.append(keys[s + i])
                        b.append(keys[s + r])
        return pd.DataFrame({"a": a, "b": b})

    return units.groupBy("part").applyInPandas(verify, "a binary, b binary")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and more) with the lines that stay as text, and behind it n_lines and n_kept (blank lines not
    counted; with underscores if ``docs`` has such names)."""
    prepare(docs.sparkSession)
    base = docs.select("doc_id", "text")
    roots = components(line_links(base, candidate_groups(base)), "a", "b").select(F.col("node").alias("key"), "root")

    def occurrences(batches: Iterable[pa.RecordBatch]):
        """The lines of each document; a line that the task has sent from a document that comes first is not sent again."""
        sent: dict[str, tuple] = {}
        for b in batches:
            out: dict[str, list] = {"key": [], "doc_id": [], "h": [], "line": []}
            for doc, h, text in zip(b.column("doc_id").to_pylist(), b.column("h").to_pylist(), b.column("text").to_pylist(), strict=True):
                first: dict[str, int] = {}
                for i, line in lines_of(text):
                    first.setdefault(line, i)
                place = (doc is not None, doc or 0, h)
                new = [line for line in first if line not in sent or place < sent[line]]
                sent.update(dict.fromkeys(new, place))
                out["key"] += map(line_key, new)
                out["line"] += map(first.__getitem__, new)
                out["doc_id"] += [doc] * len(new)
                out["h"] += [h] * len(new)
            yield out
            if sum(map(len, sent)) > 64 << 20 or len(sent) > FLUSH:
                sent.clear()

    rows = map_batches(base.withColumn("h", F.xxhash64("text")), occurrences, "key binary, doc_id long, h long, line int")
    classes = rows.groupBy("key").agg(F.min(F.struct("doc_id", "h", "line")).alias("first"))
    named = classes.join(roots, "key", "left")
    kept = named.groupBy(F.coalesce("root", "key").alias("root")).agg(F.min("first").alias("first")).select("first.*")
    own, doc, h, stay, n_lines, n_kept = fresh(docs.columns, "k_own", "k_doc", "k_hash", "k_lines", "n_lines", "n_kept")
    kept = kept.groupBy(F.col("doc_id").alias(doc), F.col("h").alias(h)).agg(F.collect_list("line").alias(stay))
    joined = docs.withColumn(own, F.xxhash64("text")).join(kept, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(h)), "left")
    names = [c for c in docs.columns if c != "text"]
    joined = joined.select(*map(quoted, names), "text", stay)

    def rebuild(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            out: dict[str, list] = {"text": [], n_lines: [], n_kept: []}
            for text, keep in zip(b.column("text").to_pylist(), b.column(stay).to_pylist(), strict=True):
                keep = set(keep or ())
                lines = (text or "").split("\n")
                full = [bool(x.strip()) for x in lines]
                out["text"].append(None if text is None else "\n".join([x for i, x in enumerate(lines) if not full[i] or i in keep]))
                out[n_lines].append(sum(full))
                out[n_kept].append(len(keep))
            yield {c: b.column(c) for c in names} | out

    return map_batches(joined, rebuild, fields(docs, names) + f"text string, {n_lines} int, {n_kept} int")


def op1_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_kept", "text")
