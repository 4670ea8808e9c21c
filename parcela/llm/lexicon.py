"""Operator 10, BPE encoding and decoding with a minimal acyclic transducer of frequent words.

The corpus' frequent words (``frequent.frequent_items``, at most ``size``) become a minimal acyclic automaton that
shares prefixes and suffixes. Every arc carries the number of words that sort before those behind it in its state; the
sum along a word's path is the word's rank, which leads to its ids. The arrays are written as one file to the shared
folder, shipped by ``SparkContext.addFile`` and memory-mapped by the workers of an executor. The distinct words of every batch
step through it together; words that it lacks are merged by the library's model and kept in the worker's bounded cache: both ways give the ids of the
library on whole texts, special strings inside a text included.

Decoding is the library's ``decode(ids, skip_special_tokens=False)``: a file without decoder joins its tokens by one space.

Defined results: null and empty texts have no ids and decode to the empty text; repeated rows and null ids are kept one
by one; further columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import functools
import io
from collections.abc import Callable, Iterable
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from .common import map_batches, parts_of, prepare, read_table, scratch, texts_of
from .frequent import frequent_items
from .subword import WORD_BPE, WordIds, byte_level, little_endian, numbered, spell, tokenizer_path

LEXICON_SIZE = 30_000
HELD_CHARS = 4 << 20          # of texts that are encoded at once (a longer text alone)
MAPPED = "\x1c"               # before a counted word that is spelt in the byte alphabet already; no plain word holds it
_FIELDS = ("key", "target", "before", "final", "offset", "ids")


class Transducer:
    """Arcs sorted by key = state * 256 + byte, with the state they lead to and the words that sort before."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @staticmethod
    def build(words: dict[bytes, list[int]]) -> Transducer:
        """Incremental construction from sorted words: a state is frozen once no later word can pass it."""
        register: dict[tuple, int] = {}
        frozen: list[tuple] = []                   # (final, ((label, target), ...)) of each state

        def freeze(node: list) -> int:
            sign = (node[0], tuple(node[1].items()))
            if sign not in register:
                register[sign] = len(frozen)
                frozen.append(sign)
            return register[sign]

        path: list[list] = [[False, {}]]           # open states of the last word
        last = b""
        ordered = sorted(words)
        for w in ordered:
            common = 0
            while common < min(len(w), len(last)) and w[common] == last[common]:
                common += 1
            for depth in range(len(last), common, -1):
                path[depth - 1][1][last[depth - 1]] = freeze(path.pop())
            for _ in w[common:]:
                path.append([False, {}])
            path[len(w)][0] = True
            last = w
        for depth in range(len(last), 0, -1):
            path[depth - 1][1][last[depth - 1]] = freeze(path.pop())
        freeze(path[0])                            # the start is the last state
        behind: list[int] = []                     # words accepted from each state; targets come first
        key, target, before = [], [], []
        for state, (final, arcs) in enumerate(frozen):
            n = int(final)
            for byte, to in arcs:
                key.append((state << 8) | byte)
                target.append(to)
                before.append(n)
                n += behind[to]
            behind.append(n)
        flat = [i for w in ordered for i in words[w]]
        return Transducer({
            "key": np.asarray(key, np.int64),
            "target": np.asarray(target, np.int32), "before": np.asarray(before, np.int32),
            "final": np.asarray([f for f, _ in frozen], bool),
            "offset": np.cumsum([0, *(len(words[w]) for w in ordered)]).astype(np.int64),
            "ids": np.asarray(flat, np.uint32)})

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word, or -1: all words step through the automaton together, a byte a round."""
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        start = np.cumsum(size) - size
        text = np.frombuffer(b"".join(words), np.uint8)
        state = np.full(n, len(self.final) - 1, np.int64)
        rank = np.zeros(n, np.int64)
        alive = np.arange(n)
        for step in range(int(size.max(initial=0))):
            alive = alive[size[alive] > step]
            if not len(alive) or not len(self.key):
                break
            wanted = (state[alive] << 8) | text[start[alive] + step]
            at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
            found = self.key[at] == wanted
            rank[alive[~found]] = -1
            size[alive[~found]] = -1
            alive, at = alive[found], at[found]
            rank[alive] += self.before[at]
            state[alive] = self.target[at]
        return np.where((size >= 0) & self.final[state], rank, -1)

    def ids_of(self, rank: int) -> np.ndarray:
        return self.ids[self.offset[rank]:self.offset[rank + 1]]

    def dump(self) -> bytes:
        out = io.BytesIO()
        for name in _FIELDS:
            np.save(out, getattr(self, name))
            out.write(b"\0" * (-out.tell() % 64))
        return out.getvalue()

    @staticmethod
    def load(path: str) -> Transducer:
        """Map a file that ``dump`` made: arrays are views of the mapped pages."""
        data, arrays, at = np.memmap(path, np.uint8, "r"), {}, 0
        for name in _FIELDS:
            head = io.BytesIO(data[at:at + 4096].tobytes())
            np.lib.format.read_magic(head)
            shape, _, dtype = np.lib.format.read_array_header_1_0(head)
            at += head.tell()
            size = int(np.prod(shape)) * dtype.itemsize
            arrays[name] = data[at:at + size].view(dtype)
            at += size + -size % 64
        return Transducer(arrays)


class LexiconIds(WordIds):
    """Ids of words by the transducer, which is asked for the distinct words of every batch; the library's merges, kept in a cache, for
    those that it lacks."""

    def __init__(self, path: str, lexicon: Transducer):
        super().__init__(path)
        self.lexicon = lexicon
        self.held: list[bytes | None] = [None] * (len(lexicon.offset) - 1)        # the ids of ranks asked for so far
        self.asked = self.answered = 0                       # pre-tokens, and those that the transducer held
        tokens = {i: w for w, i in self.full.get_vocab(with_added_tokens=True).items()}
        n = max(tokens) + 1
        self.decimal = Shown([str(i) for i in range(n)])
        self.token = Shown([tokens.get(i, "") for i in range(n)])

    def ids_at(self, rank: int) -> bytes:
        ids = self.held[rank]
        if ids is None:
            ids = self.held[rank] = self.lexicon.ids_of(rank).astype("<u4").tobytes()
        return ids

    def lookup(self, words: list[str], mapped: bool) -> list[bytes]:
        distinct, at = numbered(words)
        ranks = self.lexicon.ranks((" ".join(distinct) if mapped else spell(distinct)).encode("utf-8").split(b" "))
        out = [self.ids_at(r) if r >= 0 else b"" for r in ranks.tolist()]
        unseen = np.flatnonzero(ranks < 0).tolist()
        for i, ids in zip(unseen, self.distinct([distinct[i] for i in unseen], mapped), strict=True):
            out[i] = ids
        self.asked += len(words)
        self.answered += int((ranks >= 0)[at].sum())
        return list(map(out.__getitem__, at))


class Shown:
    """A text for each id, and the texts of runs of ids joined by one space."""

    def __init__(self, texts: list[str]):
        parts = [t.encode("utf-8") + b" " for t in texts]
        self.size = np.fromiter(map(len, parts), np.int64, len(parts))
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)

    def join(self, runs: list[np.ndarray]) -> list[bytes]:
        ids = np.concatenate([np.zeros(0, np.uint32), *runs])
        size = self.size[ids]
        ends = np.cumsum(size)
        joined = self.bytes[np.arange(int(size.sum())) + np.repeat(self.start[ids] - ends + size, size)].tobytes()
        cuts = np.concatenate([[0], ends])[np.cumsum([0, *map(len, runs)])].tolist()
        return [joined[s:e - 1] if e > s else b"" for s, e in zip(cuts, cuts[1:], strict=False)]


def build_lexicon(docs: DataFrame, path: str, size: int = LEXICON_SIZE) -> Transducer:
    """The transducer of the corpus' frequent words, spelt in the byte alphabet."""

    def words(texts: list[str]):
        cut = _plain(path)
        parts = [p for text in texts for p in cut._cut(text) if p.__class__ is tuple]
        return chain.from_iterable([MAPPED + w for w in words] if mapped else words for words, mapped in parts)

    top = [w[1:] if w[0] == MAPPED else byte_level(w) for w in frequent_items(docs, words, size)]
    ids = _plain(path).merge(top, True) if top else []
    return Transducer.build({w.encode("utf-8"): little_endian(i).tolist() for w, i in zip(top, ids, strict=True)})


@functools.lru_cache(2)
def _plain(path: str) -> WordIds:
    return WordIds(path)


def ship(spark: SparkSession, data: bytes, stem: str) -> str:
    """Write bytes to the shared folder by Hadoop's file system and let every executor fetch them; the file's name."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{scratch(spark, stem)}.bin")          # a name of its own: a session holds one file a name
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    out.write(bytearray(data))
    out.close()
    spark.sparkContext.addFile(fs.makeQualified(path).toString())
    return path.getName()


@functools.lru_cache(2)
def _worker_encoder(path: str, name: str) -> LexiconIds:
    return LexiconIds(path, Transducer.load(SparkFiles.get(name)))


def _rounds(docs: DataFrame, tokenizer: str | None, size: int, out: Callable[[LexiconIds, list[np.ndarray], list[bytes]], dict], schema: str) -> DataFrame:
    """doc_id and the columns that ``out`` makes of the texts' ids and decoded texts (UTF-8)."""
    spark = prepare(docs.sparkSession)
    path = tokenizer or tokenizer_path(WORD_BPE)
    docs = docs.select("doc_id", "text")
    name = ship(spark, build_lexicon(docs, path, size).dump(), "lexicon")

    def run(batches: Iterable[pa.RecordBatch]):
        encoder = _worker_encoder(path, name)
        for b in batches:
            texts = texts_of(b)
            for part in parts_of(texts, HELD_CHARS):
                ids = [little_endian(x) for x in encoder.encode_batch(texts[part])]
                if encoder.full.decoder is None:
                    decoded = encoder.token.join(ids)
                else:
                    decoded = [t.encode("utf-8") for t in encoder.full.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)]
                yield {"doc_id": b.column("doc_id")[part]} | out(encoder, ids, decoded)

    return map_batches(docs, run, "doc_id long, " + schema)


def bpe_round_trip(docs: DataFrame, tokenizer: str | None = None, size: int = LEXICON_SIZE) -> DataFrame:
    """doc_id, ids, decoded of every row of ``docs`` (doc_id, text)."""

    def whole(_: LexiconIds, ids: list[np.ndarray], decoded: list[bytes]) -> dict:
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        flat = np.concatenate(ids).astype(np.int32)
        return {"ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), "decoded": [x.decode("utf-8") for x in decoded]}

    return _rounds(docs, tokenizer, size, whole, "ids array<int>, decoded string")


def bpe_digests(docs: DataFrame, tokenizer: str | None = None, size: int = LEXICON_SIZE) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids' decimal text and of the decoded text: ``bpe_round_trip`` without sending ids
    and texts out of the task."""

    def digests(encoder: LexiconIds, ids: list[np.ndarray], decoded: list[bytes]) -> dict:
        sha = [[sha256(x).hexdigest() for x in texts] for texts in (encoder.decimal.join(ids), decoded)]
        return {"n_tokens": [len(x) for x in ids], "ids_sha256": sha[0], "decoded_sha256": sha[1]}

    return _rounds(docs, tokenizer, size, digests, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read_table(spark, sf_dir, "documents"))
