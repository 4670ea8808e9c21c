"""Operator 12, cross-tokenizer alignment of a byte-level BPE (A) and a sentencepiece BPE (B) over the distinct texts of a corpus.

Exact-text deduplication: texts are shuffled by the full text, each distinct one is tokenised and aligned once, with the
number of its documents; a pair's count is the sum of those numbers; the measures of a text join its documents by the text's SHA-256.

Alignment: A reads space + text, B adds that space itself. Where a token of each ends at one byte, a group ends; two tokens are linked
if their bytes overlap. Neither tokenizer merges across a single space before a word (``chunks_of``),
so the ids of a text are those of its chunks between such spaces; distinct chunks are encoded in bulk and kept in a bounded cache, long
ones apart. Ends, groups and links of many texts are then found at once: a link ends wherever a token of either ends. A text has no tokens if it
is null or empty or if its tokens do not spell it (B spells U+2581 as a space).

Pair counts: a pair is one 31-bit number (``pair_of``). The most frequent pairs, at most ``table_size`` of them, go to the workers
as two sorted arrays with the flag of an A id's best count; the links of all other pairs are rows that meet the counts in a join by pair
and come back as one sum a text. Both ways are always there, and exact; the table's size only moves work between them.

Defined results: null and empty texts have zeros and the empty string as groups; repeated rows and null doc_ids are kept one by one and
count as documents of their own; further columns are ignored; an empty table gives an empty result. A document's text lies whole in a
task; its tokens are those of the libraries, strings of special tokens being plain text.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, materialize, parts_of, prepare, read_table, texts_of
from .subword import BYTE_BPE, Generations, WordIds, little_endian, numbered, tokenizer_path
from .token_counts import PIECE_BPE, SPACE, check_model

TABLE_SIZE = 1_000_000        # pairs in the broadcast arrays: 9 bytes each
CACHE_CHUNKS = 300_000        # chunks of a cache's generation; a worker keeps two
HELD_CHARS = 1 << 20          # of texts that are aligned at once (a longer text alone)
SHIFT = 15                    # bits of a B id in a pair
OF_B = 1 << 31                # tells B ids from A ids in one array
CELL = 6                      # bytes of an id and the mark behind it
VOID = b"void"                # instead of ids: the pieces do not spell the chunk

_APART = re.compile(r"(?<=\S) ").split
_WIDE = re.compile(r"^ | (?:\s|\Z)").search


def pair_of(a, b):
    return (a << SHIFT) | b


def chunks_of(text: str) -> list[str]:
    """The chunks of space + text, without the space that each begins with.

    B never merges across the border of a non-space and a space. For A such a space begins a pre-token if a non-space comes
    before it or behind it: white space before a word leaves its last character to the word."""
    if not text:
        return []
    if _WIDE(text) is None:                                           # a space is always followed by a non-space
        return text.split(" ")
    return _APART(text)


def _cells(shown: list[bytes]) -> np.ndarray:
    """Short byte strings as rows of ``CELL`` bytes, zeros behind them."""
    return np.frombuffer(b"".join(x.ljust(CELL, b"\0") for x in shown), np.uint8).reshape(-1, CELL)


class Aligner:
    """Both tokenizers with their tokens' sizes in bytes, and the B ids of chunks in a bounded cache."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        self.a = WordIds(byte_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        check_model(self.b)
        words = self.a.full.get_vocab(with_added_tokens=True)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        n_a, n_b = max(words.values()) + 1, len(pieces)
        if n_a >> 16 or n_b >> SHIFT:
            raise ValueError("ids do not fit into a pair")
        spelt = {i: len(w) for w, i in words.items()}                 # a character of the byte alphabet a byte
        self.a_sizes, self.b_sizes = np.asarray([spelt.get(i, 0) for i in range(n_a)]), np.fromiter(map(len, self.b_bytes), np.int64, n_b)
        self.lone = self.b.piece_to_id(SPACE)
        # How a token is shown: A inside and at the end of its part of a group, B likewise, B at the end of a text.
        self.shown = _cells([b"%d%s" % (i, end) for n, end in ((n_a, b","), (n_a, b"|"), (n_b, b","), (n_b, b";"), (n_b, b"")) for i in range(n)])
        self.width = (self.shown != 0).sum(1)
        self.first = dict(zip(("a", "a_last", "b", "b_last", "b_end"), np.cumsum([0, n_a, n_a, n_b, n_b]).tolist(), strict=True))
        self.known = Generations(CACHE_CHUNKS)

    def learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks as 32-bit numbers, A's, then B's with the highest bit; ``VOID`` where the tokens do not spell the chunk."""
        spaced = [" " + c for c in chunks]
        raw = [s.encode() for s in spaced]
        a_all = self.a.encode_parts([[self.a.words(s)] for s in spaced])
        b_all = [ids if c else [self.lone] for c, ids in zip(chunks, self.b.encode(chunks, num_threads=1), strict=True)]
        a_at, b_at = (np.concatenate([[0], np.cumsum(np.fromiter(map(len, x), np.int64, len(x)))]) for x in (a_all, b_all))
        a_at //= 4
        sizes = np.concatenate([[0], np.cumsum(self.a_sizes[little_endian(b"".join(a_all))])])[a_at]
        same = np.diff(sizes) == np.fromiter(map(len, raw), np.int64, len(raw))
        flat = list(chain.from_iterable(b_all))
        if b"".join([self.b_bytes[i] for i in flat]) != b"".join(raw):
            same &= [b"".join([self.b_bytes[i] for i in ids]) == r for ids, r in zip(b_all, raw, strict=True)]
        b_ids = (np.asarray(flat, "<u4") | np.uint32(OF_B)).tobytes()
        cuts = (4 * b_at).tolist()
        return [a + b_ids[s:e] if ok else VOID for a, s, e, ok in zip(a_all, cuts, cuts[1:], same.tolist(), strict=False)]

    def ids(self, texts: list[str]) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
        """Which texts have tokens, the ids of all their chunks, and how many of A and of B each text has."""
        cut = [chunks_of(t) for t in texts]
        distinct, places = numbered(list(chain.from_iterable(cut)))
        flat = list(map(self.known.lookup(distinct, self.learn).__getitem__, places))
        held, found, at = [], [], 0
        for i, chunks in enumerate(cut):
            parts = flat[at:at + len(chunks)]
            at += len(chunks)
            if parts and VOID not in parts:
                held.append(i)
                found.append(b"".join(parts))
        ids = little_endian(b"".join(found))
        n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        n_b = np.diff(np.concatenate([[0], np.cumsum(ids >= OF_B)])[np.cumsum(n)], prepend=0) if held else n
        return held, ids, n - n_b, n_b

    def align(self, ids: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> dict:
        """Columns of texts that have tokens, from the ends of all their tokens in one run of bytes."""
        is_b = ids >= OF_B
        a, b = ids[~is_b].astype(np.int64), (ids[is_b] ^ np.uint32(OF_B)).astype(np.int64)
        a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        ends = np.zeros((2, int(a_end[-1]) + 1), bool)
        ends[0, a_end] = ends[1, b_end] = True
        at = np.flatnonzero(ends[0] | ends[1])                        # every end of a token is the end of one link
        a_ends, b_ends = ends[0, at], ends[1, at]
        group = a_ends & b_ends
        done_a, done_b, done = np.cumsum(a_ends), np.cumsum(b_ends), np.cumsum(group)
        pairs = pair_of(a[done_a - a_ends], b[done_b - b_ends]).astype(np.int32)
        last_a = np.cumsum(n_a)
        text_end = np.searchsorted(at, a_end[last_a - 1]) + 1         # links of the texts so far
        n_links, n_groups = np.diff(text_end, prepend=0), np.diff(done[text_end - 1], prepend=0)
        # The order shown: the A tokens of a group, then its B tokens.
        a_of, b_of = (done - group)[a_ends], (done - group)[b_ends]   # the tokens' groups
        a_to, b_to = done_a[group], done_b[group]                     # the groups' ends among A and B tokens
        order = np.empty(len(a) + len(b), np.int64)
        a_last = np.arange(1, len(a) + 1) == a_to[a_of]
        b_last = np.arange(1, len(b) + 1) == b_to[b_of]
        order[np.arange(len(a)) + np.concatenate([[0], b_to])[a_of]] = a + np.where(a_last, self.first["a_last"], self.first["a"])
        order[np.arange(len(b)) + a_to[b_of]] = b + np.where(b_last, self.first["b_last"], self.first["b"])
        tokens = np.cumsum(n_a + n_b)
        order[tokens - 1] += self.first["b_end"] - self.first["b_last"]
        shown = self.shown[order].reshape(-1)
        bounds = np.concatenate([[0], np.cumsum(self.width[order])[tokens - 1]]).astype(np.int32)
        # Distinct links of each text.
        for s, e in zip([0, *text_end.tolist()], text_end.tolist(), strict=False):
            pairs[s:e].sort()
        new = np.concatenate([[True], pairs[1:] != pairs[:-1]])
        new[text_end[:-1]] = True
        start = np.flatnonzero(new)
        cuts = pa.array(np.concatenate([[0], np.searchsorted(start, text_end)]).astype(np.int32))
        return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
                "groups": pa.StringArray.from_buffers(len(n_a), pa.py_buffer(bounds), pa.py_buffer(shown[shown != 0].tobytes())),
                "pairs": pa.ListArray.from_arrays(cuts, pa.array(pairs[start])),
                "times": pa.ListArray.from_arrays(cuts, pa.array(np.diff(start, append=len(pairs)).astype(np.int32)))}


@functools.lru_cache(2)
def _worker_aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """text and n_docs of every distinct text that is not null or empty: the shuffle by full text."""
    return docs.where(F.length("text") > 0).groupBy("text").agg(F.count(F.lit(1)).alias("n_docs"))


def alignments(texts: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """key (the text's SHA-256), n_docs, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``), pairs and times (distinct links) of
    each row of ``texts`` (text, n_docs) that has tokens."""
    prepare(texts.sparkSession)
    paths = byte_path or tokenizer_path(BYTE_BPE), piece_path or tokenizer_path(PIECE_BPE)

    def run(batches: Iterable[pa.RecordBatch]):
        aligner = _worker_aligner(*paths)
        for b in batches:
            texts = texts_of(b)
            for part in parts_of(texts, HELD_CHARS):
                held, *ids = aligner.ids(texts[part])
                if held:
                    take = pa.array(held, pa.int64())
                    yield aligner.align(*ids) | {c: b.column(c)[part].take(take) for c in ("key", "n_docs")}

    keyed = texts.select(F.sha2("text", 256).alias("key"), "n_docs", "text")
    return map_batches(keyed, run, "key string, n_docs long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<int>, times array<int>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, count (documents that hold it linked) and best (no pair of its A id has a higher count)."""
    counts = materialize(aligned.select(F.explode("pairs").alias("pair"), "n_docs").groupBy("pair").agg(F.sum("n_docs").alias("count")), "pairs")
    a = F.shiftright("pair", SHIFT)
    top = counts.groupBy(a.alias("a")).agg(F.max("count").alias("top"))
    return counts.join(top, a == top["a"]).select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def _frequent(counts: DataFrame, size: int) -> DataFrame:
    """The pairs with the highest counts, at most ``size``: those above a count that a histogram of at most 1,024 steps gives."""
    step = F.floor(F.log2("count") * 16).cast("int").alias("step")
    steps = sorted(counts.groupBy(step).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    held, least = 0, None
    for s, n in steps:
        held += n
        if held > size:
            break
        least = s
    return counts.where(F.lit(False) if least is None else step >= least)


def measured(aligned: DataFrame, table_size: int = TABLE_SIZE) -> DataFrame:
    """key, n_best and count_sum of every row of ``aligned`` (read several times: a written table)."""
    spark = aligned.sparkSession
    counts = materialize(pair_counts(aligned), "counts")
    top = _frequent(counts, table_size)
    rows = top.select("pair", "count", "best").toArrow().sort_by("pair")         # at most table_size rows
    table = spark.sparkContext.broadcast(tuple(rows.column(c).to_numpy() for c in ("pair", "count", "best")))

    def run(batches: Iterable[pa.RecordBatch]):
        known, count, best = table.value
        for b in batches:
            lists = b.column("pairs")
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            pairs, times = lists.flatten().to_numpy(), b.column("times").flatten().to_numpy()
            at = np.searchsorted(known, pairs)
            at[at == len(known)] = 0
            hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            total = {}
            for name, values in (("count_sum", count), ("n_best", best)):
                value = np.where(hit, values[at], 0) * times if len(known) else np.zeros(len(pairs), np.int64)
                running = np.concatenate([[0], np.cumsum(value, dtype=np.int64)])
                total[name] = running[ends[1:]] - running[ends[:-1]]
            rest = np.flatnonzero(~hit)
            cuts = np.searchsorted(rest, ends).astype(np.int32)
            left = {k: pa.ListArray.from_arrays(pa.array(cuts), pa.array(v[rest])) for k, v in (("rest", pairs), ("rest_times", times))}
            yield {"key": b.column("key")} | total | left

    schema = "key string, n_best long, count_sum long, rest array<int>, rest_times array<int>"
    first = materialize(map_batches(aligned.select("key", "pairs", "times"), run, schema), "first")
    rare = first.where(F.size("rest") > 0).select("key", F.explode(F.arrays_zip("rest", "rest_times")).alias("x"))
    rare = rare.select("key", F.col("x.rest").alias("pair"), F.col("x.rest_times").alias("times")).join(counts, "pair")
    rare = rare.select("key", F.when(F.col("best"), F.col("times")).otherwise(0).cast("long").alias("n_best"), (F.col("count") * F.col("times")).alias("count_sum"))
    both = first.select("key", "n_best", "count_sum").unionByName(rare)
    return both.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def cross_align(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None, table_size: int = TABLE_SIZE,
                groups: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups of every row of ``docs`` (doc_id, text).

    ``groups`` is applied to the groups' text before it is written, say a digest."""
    docs = docs.select("doc_id", "text")
    found = alignments(distinct_texts(docs), byte_path, piece_path).withColumn("groups", groups(F.col("groups")))
    aligned = materialize(found, "aligned")
    per_text = aligned.drop("pairs", "times", "n_docs").join(measured(aligned, table_size), "key")
    named = docs.select("doc_id", F.when(F.length("text") > 0, F.sha2("text", 256)).alias("key"))
    numbers = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return named.join(per_text, "key", "left").select(
        "doc_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers), F.coalesce("groups", F.lit("")).alias("groups"))


def op12_cross_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = cross_align(read_table(spark, sf_dir, "documents"), groups=lambda c: F.sha2(c, 256))
    return done.withColumnRenamed("groups", "groups_sha256")
