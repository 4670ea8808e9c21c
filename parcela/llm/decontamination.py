"""Operator 13, benchmark decontamination with generalised suffix automata of the normalised items.

Texts become words: bytes A-Z in lower case, runs of digits, letters and all code points from U+0080 on. A window is ``window``
consecutive words of an item, or a whole item of fewer words. The words of the items build a generalised suffix automaton: its
states are the sets of equal end positions of the items' factors, a suffix link leads to the next shorter set. A document's words
stream through it; state and length are the longest factor that ends at each word. A length of ``window`` or more puts the last words
into a span and names the items of the window's state; marks on the link path find whole short items.

A word can only lengthen a match of two or more if it makes a factor with the word before it; runs of words without such a pair, found
by a sorted table of the items' pairs, are not streamed as they cannot hold a window (one-word items have their own mark).

Items of any number: long ones are cut into segments that overlap by ``window - 1`` words, segments are dealt by a hash into blocks of
about ``block_words`` words, an executor builds a block's automaton, and the arrays are shipped as one file a block, mapped by the
workers, of which a few blocks are open at a time. Documents never move: every block meets each batch where it is read, so no key, source or
group of copies has an effect on the tasks.

Defined results: null texts have no words; rows that repeat an item_id count as one item; a null item_id is named by the empty text;
items without words are never met; an empty benchmark hits nothing; repeated rows and null doc_ids are kept one by one; further
columns are ignored or, by ``decontaminate``, kept; empty tables give empty results.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fields, fresh, map_batches, materialize, parts_of, prepare, quoted, read_table
from .lexicon import ship
from .mapped import map_arrays, pack_arrays

WINDOW = 10
SEGMENT = 4096                # words of an item that one segment holds
BLOCK_WORDS = 200_000         # words of a block's items: some 10 MB of arrays
MAX_COVERAGE = 0.5            # share of hit words beyond which a document goes
HELD_BYTES = 4 << 20          # of texts whose words are held at once (a longer text alone)

_WORD = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD else 0x20 for b in range(256))
_RUNS = re.compile(b"[^ ]+").finditer


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class SuffixAutomaton:
    """``length`` and ``link`` of the states, arcs sorted by state << 32 | word; state 0 is the empty factor."""

    def __init__(self):
        self.length, self.link, self.arcs = [0], [-1], [{}]

    def _state(self, length: int, link: int, arcs: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.arcs.append(arcs)
        return len(self.length) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """The state of the factor that ``p`` and ``word`` make, apart from the longer ones of ``q``."""
        new = self._state(self.length[p] + 1, self.link[q], dict(self.arcs[q]))
        while p >= 0 and self.arcs[p].get(word) == q:
            self.arcs[p][word] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def extend(self, last: int, word: int) -> int:
        """The state of an item's words up to ``word``; ``last`` is the one before it (0 at the start)."""
        q = self.arcs[last].get(word)
        if q is not None:                                            # an earlier item holds these words
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and word not in self.arcs[p]:
            self.arcs[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.arcs[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return new

    def add(self, words: list[int]) -> int:
        last = 0
        for w in words:
            last = self.extend(last, w)
        return last


def _rows(pairs: list[tuple[int, int]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (state, value) pairs as offsets by state and values."""
    flat = np.asarray(sorted(set(pairs)), np.int64).reshape(-1, 2)
    return np.searchsorted(flat[:, 0], np.arange(n + 1)), flat[:, 1]


def build(segments: list[tuple[str, bool, bytes]], window: int) -> bytes:
    """The file of a block: (item, whole short item, words joined by spaces) of its segments."""
    segments = sorted(segments)
    vocabulary = sorted(set().union(*(s[2].split() for s in segments)))
    number = {w: i for i, w in enumerate(vocabulary)}
    names = sorted({s[0] for s in segments})
    named = {n: i for i, n in enumerate(names)}
    automaton = SuffixAutomaton()
    items = [(named[item], short, [number[w] for w in words.split()]) for item, short, words in segments]
    for _, _, words in items:
        automaton.add(words)
    n, length, link, arcs = len(automaton.length), automaton.length, automaton.link, automaton.arcs
    by_length = np.argsort(length, kind="stable")[1:].tolist()
    origin = [0] * n                                                 # the state of the last ``window`` words
    for s in by_length:
        if length[s] >= window:
            origin[s] = origin[link[s]] or s
    holds, shorts = [], []
    for item, short, words in items:                                 # items again, now that no state is split any more
        state = 0
        for i, w in enumerate(words):
            state = arcs[state][w]
            if not short and i + 1 >= window:
                holds.append((origin[state], item))
        if short:
            shorts.append((state, len(words) << 32 | item))
    hold_at, hold_item = _rows(holds, n)
    short_at, short_item = _rows(shorts, n)
    marked = [0] * n                                                 # nearest state on the link path that ends a short item
    for s in by_length:
        marked[s] = s if short_at[s + 1] > short_at[s] else marked[link[s]]
    key = np.asarray(sorted((s << 32 | w, t) for s, a in enumerate(arcs) for w, t in a.items()), np.int64).reshape(-1, 2)
    v = len(vocabulary)
    return pack_arrays({
        "length": np.asarray(length, np.int32), "link": np.asarray(link, np.int32), "key": key[:, 0], "target": key[:, 1].astype(np.int32),
        "origin": np.asarray(origin, np.int32), "marked": np.asarray(marked, np.int32),
        "hold_at": hold_at, "hold_item": hold_item, "short_at": short_at, "short_item": short_item,
        "pairs": np.asarray(sorted({w * v + x for w, t in arcs[0].items() for x in arcs[t]}), np.int64),
        "single": np.asarray([short_at[t + 1] > short_at[t] for _, t in sorted(arcs[0].items())], bool),
        "shortest": np.asarray([min([len(w) for _, s, w in items if s], default=window)], np.int64), "window": np.asarray([window], np.int64),
        "words": np.frombuffer(b" ".join(vocabulary), np.uint8), "items": np.frombuffer("\0".join(names).encode(), np.uint8)})


class Matcher:
    """A block's automaton, mapped: spans and items of the words of many documents."""

    def __init__(self, path: str):
        a = map_arrays(path)
        self.number = {w: i for i, w in enumerate(a["words"].tobytes().split())}
        self.items = a["items"].tobytes().decode().split("\0")
        self.pairs, self.single, self.window, self.shortest = a["pairs"], a["single"], int(a["window"][0]), int(a["shortest"][0])
        for name in ("length", "link", "key", "target", "origin", "marked", "hold_at", "hold_item", "short_at", "short_item"):
            setattr(self, name, memoryview(a[name]))

    def runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches of words that may hold a window; -1 is an unknown word or the end of a document."""
        if len(ids) == 0 or not len(self.pairs) and not self.single.any():
            return
        pair = ids[:-1] * len(self.number) + ids[1:]
        pair[(ids[:-1] < 0) | (ids[1:] < 0)] = -1
        at = np.searchsorted(self.pairs, pair)
        joined = np.zeros(len(ids) + 1, bool)                        # joined[i]: words i - 1 and i are a factor
        if len(self.pairs):
            joined[1:-1] = self.pairs[np.minimum(at, len(self.pairs) - 1)] == pair
        edge = np.flatnonzero(joined[1:] != joined[:-1])             # a run's first word, then its last
        first, last = edge[::2], edge[1::2]
        long = last - first + 1 >= min(self.shortest, self.window)
        yield from zip(first[long].tolist(), (last[long] + 1).tolist(), strict=True)
        if self.shortest == 1:
            alone = np.flatnonzero((ids >= 0) & ~joined[1:] & ~joined[:-1])
            for i in alone[self.single[ids[alone]]].tolist():
                yield i, i + 1

    def match(self, ids: list[int], start: int) -> Iterator[tuple[int, int, list[int]]]:
        """(first word, word behind, items) of every window that ends in a stretch whose words begin at ``start``."""
        key, target, link, length, window = self.key, self.target, self.link, self.length, self.window
        state = size = 0
        for i, w in enumerate(ids, start + 1):
            while True:
                at = bisect_left(key, state << 32 | w)
                if at < len(key) and key[at] == state << 32 | w:
                    state, size = target[at], size + 1
                    break
                if not state:
                    size = 0
                    break
                state = link[state]
                size = length[state]
            if size >= window:
                u = self.origin[state]
                yield i - window, i, self.hold_item[self.hold_at[u]:self.hold_at[u + 1]].tolist()
            s = self.marked[state]
            while s:
                for x in self.short_item[self.short_at[s]:self.short_at[s + 1]]:
                    if x >> 32 <= size:
                        yield i - (x >> 32), i, [x & 0xFFFFFFFF]
                s = self.marked[link[s]]

    def hits(self, words: list[bytes], ends: np.ndarray) -> Iterator[tuple[int, int, int, list[str]]]:
        """(document, first word, word behind, item names) over documents whose words end before ``ends``, each with a gap of one."""
        number = self.number
        ids = np.fromiter((number.get(w, -1) for w in words), np.int64, len(words))
        runs = list(self.runs(ids))
        docs = np.searchsorted(ends, [a for a, _ in runs], "right").tolist()
        for doc, (a, z) in zip(docs, runs, strict=True):
            for first, behind, found in self.match(ids[a:z].tolist(), a):
                yield doc, first, behind, [self.items[x] for x in found]


@functools.lru_cache(4)
def _worker_matcher(name: str) -> Matcher:
    return Matcher(SparkFiles.get(name))


def segments(items: DataFrame, window: int) -> DataFrame:
    """item, short, words: the items' words, long items in overlapping segments, repeats once."""

    def cut(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            out: dict[str, list] = {"item": [], "short": [], "words": []}
            for item, text in zip(b.column("item").to_pylist(), b.column("text").to_pylist(), strict=True):
                words = words_of((text or "").encode())
                for at in range(0, max(len(words) - window + 1, min(1, len(words))), SEGMENT):
                    out["item"].append(item)
                    out["short"].append(len(words) < window)
                    out["words"].append(b" ".join(words[at:at + SEGMENT + window - 1]))
            yield out

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return map_batches(named, cut, "item string, short boolean, words binary").distinct()


def ship_blocks(items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> list[str]:
    """Names of the shipped files, one a block."""
    cut = materialize(segments(items, window), "segments")
    n = cut.agg(F.sum(F.length("words") - F.length(F.regexp_replace(F.decode("words", "ISO-8859-1"), " ", "")) + 1)).first()[0] or 0
    if not n:
        return []

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"file": [build([(i, bool(s), bytes(w)) for i, s, w in zip(pdf["item"], pdf["short"], pdf["words"], strict=True)], window)]})

    block = F.pmod(F.xxhash64("item", "words"), F.lit(-(-n // block_words))).alias("block")
    built = materialize(cut.groupBy(block).applyInPandas(one, "file binary"), "automata")
    return [ship(items.sparkSession, bytes(r["file"]), "automaton") for r in built.toLocalIterator()]          # a block at a time


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return out


def _found(texts: list[bytes], names: list[str]) -> Iterator[tuple[int, list[list[int]], list[str]]]:
    """n_words, merged spans of word numbers and item names of each text."""
    for part in parts_of(texts, HELD_BYTES):
        yield from _found_in(texts[part], names)


def _found_in(texts: list[bytes], names: list[str]) -> Iterator[tuple[int, list[list[int]], list[str]]]:
    cut = [words_of(t) for t in texts]
    flat: list[bytes] = []
    for words in cut:
        flat += words
        flat.append(b"")                                             # no word: the gap between two documents
    ends = np.cumsum([len(w) + 1 for w in cut])
    spans: dict[int, set] = {}
    items: dict[int, set] = {}
    for name in names:
        for doc, first, behind, found in _worker_matcher(name).hits(flat, ends):
            at = int(ends[doc - 1]) if doc else 0
            spans.setdefault(doc, set()).add((first - at, behind - at))
            items.setdefault(doc, set()).update(found)
    for i, words in enumerate(cut):
        yield len(words), _merged(list(spans.get(i, ()))), sorted(items.get(i, ()))


def _bytes(b: pa.RecordBatch, column: str) -> list[bytes]:
    return [x or b"" for x in b.column(column).cast(pa.binary()).to_pylist()]


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, spans (first word, word behind) and item names of every row of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)
    names = ship_blocks(items, window, block_words)

    def run(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            found = list(_found(_bytes(b, "text"), names))
            yield {"doc_id": b.column("doc_id"), "n_words": [x[0] for x in found],
                   "spans": [[{"first": a, "behind": z} for a, z in x[1]] for x in found], "items": [x[2] for x in found]}

    return map_batches(docs.select("doc_id", "text"), run,
                       "doc_id long, n_words long, spans array<struct<first: long, behind: long>>, items array<string>")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the spans of benchmark words, and without the documents of which more than ``max_coverage`` is hit."""
    prepare(docs.sparkSession)
    names = ship_blocks(items, window, block_words)
    keep = [c for c in docs.columns if c.lower() != "text"]
    (gone,) = fresh(docs.columns, "gone")

    def run(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            texts, left, drop = _bytes(b, "text"), [], []
            for text, (n, spans, _) in zip(texts, _found(texts, names), strict=True):
                drop.append(sum(z - a for a, z in spans) > max_coverage * n)
                if spans:
                    at = [m.span() for m in _RUNS(text.translate(_FOLD))]
                    keeps = zip([0, *(at[z - 1][1] for _, z in spans)], [*(at[a][0] for a, _ in spans), len(text)], strict=True)
                    text = b"".join(text[s:e] for s, e in keeps)
                left.append(text)
            whole = [t.decode() if ok else None for t, ok in zip(left, b.column("text").is_valid().to_pylist(), strict=True)]
            yield {c: b.column(c) for c in keep} | {"text": whole, gone: drop}

    cut = map_batches(docs, run, fields(docs, keep) + f"text string, {gone} boolean")
    return cut.where(~F.col(gone)).select(*map(quoted, docs.columns))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["behind"] - s["first"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


ORACLE_SQL = r"""
WITH fold AS (SELECT translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, coalesce(item_id::VARCHAR, '') AS item FROM benchmark),
iw AS (SELECT item, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM fold),
win AS (SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS x
        FROM iw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
dw AS (SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS x
       FROM d, (SELECT DISTINCT m FROM win), unnest(range(1, len(w) - m + 2)) AS u(i)),
hit AS (SELECT r, dw.m, i, item FROM dw JOIN win ON dw.m = win.m AND dw.x = win.x),
cov AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS j FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r)"""
