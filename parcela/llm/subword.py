"""Ids of whole texts as the tokenizers library gives them, by one dictionary lookup per pre-token.

A BPE tokenizer merges only inside a pre-token, so the ids of a text are the ids of its pre-tokens in order.
``WordIds`` splits a text into pre-tokens and encodes distinct ones in bulk, by the library's own
model without normalizer and pre-tokenizer. Texts of Latin letters are split by a compiled pattern; any other text is
normalised and split by the library itself. Special strings inside a text become their ids, as the library does.
"""

from __future__ import annotations

import functools
import json
import os
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Callable
from itertools import count

import numpy as np

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
LONG_WORD = 256                # characters; longer pre-tokens are not kept
MERGED = 512                   # pre-tokens that the model merges in one call
CACHE_WORDS = 300_000          # distinct pre-tokens of a cache's generation; it keeps two

# Characters the compiled pattern may split: Latin-1 and Latin Extended-A without the four information separators
# and the dotted capital I (whose lower case is two characters), general punctuation, the euro sign.
_PLAIN = re.compile("[\x00-\x1b\x20-įı-ſ‐-‧€]*")
_SPACES = "\t\n\x0b\x0c\r \x85\xa0"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _class(kind: str) -> str:
    """The plain characters of a general category, as a pattern class."""
    return "".join(re.escape(chr(c)) for c in range(0x180) if unicodedata.category(chr(c)).startswith(kind))


@functools.lru_cache(1)
def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def byte_level(word: str) -> str:
    return word.encode("utf-8").decode("latin-1").translate(byte_alphabet())


@functools.lru_cache(1)
def _alphabet_points() -> np.ndarray:
    """Code points of the byte alphabet; byte 255, which UTF-8 never has, stands for the space between two words."""
    points = np.asarray([ord(byte_alphabet()[b]) for b in range(256)], "<u4")
    points[255] = ord(" ")
    return points


def spell(words: list[str]) -> str:
    """The words in the byte alphabet, joined by spaces."""
    raw = np.frombuffer(b"\xff".join([w.encode("utf-8") for w in words]), np.uint8)
    return _alphabet_points()[raw].tobytes().decode("utf-32-le")


class Generations:
    """A bounded cache: at the bound, only what is asked for again outlives the next generation."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def lookup(self, keys: list[str], make: Callable[[list[str]], list]) -> list:
        """The value of each key; ``make`` gives those of distinct keys that the cache lacks. Long keys are not kept."""
        out = list(map(self.young.get, keys))
        at = [i for i, x in enumerate(out) if x is None]
        if not at:
            return out
        wanted = list(dict.fromkeys([keys[i] for i in at]))
        new = [k for k in wanted if k not in self.old]
        made = dict(zip(new, make(new), strict=True)) if new else {}
        if len(new) < len(wanted):
            made.update((k, self.old[k]) for k in wanted if k in self.old)
        for i in at:
            out[i] = made[keys[i]]
        if len(self.young) + len(made) > self.size:
            made, self.young, self.old = dict(zip(keys, out, strict=True)), {}, self.young
        if len(max(wanted, key=len)) > LONG_WORD:
            made = {k: x for k, x in made.items() if len(k) <= LONG_WORD}
        if len(made) <= self.size:
            self.young.update(made)
        return out


def numbered(words: list[str]) -> tuple[list[str], list[int]]:
    """The distinct words and the place of each word among them."""
    number: defaultdict[str, int] = defaultdict(count().__next__)
    at = list(map(number.__getitem__, words))
    return list(number), at


class WordIds:
    """Pre-tokens and ids of one tokenizer file; ``lookup`` keeps ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # Spark runs the tasks side by side
        from tokenizers import Tokenizer
        spec = json.load(open(path, encoding="utf-8"))
        self.full = Tokenizer.from_file(path)
        self.full.no_truncation()
        self.full.no_padding()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.model = Tokenizer.from_str(json.dumps(              # pre-tokens in the byte alphabet, between spaces
            spec | {"added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None}))
        suffix = spec["model"]["end_of_word_suffix"] or ""
        vocab = spec["model"]["vocab"]
        self.spelt = np.zeros(max(vocab.values()) + 1, np.int64)              # characters of a word that a token stands for
        self.spelt[list(vocab.values())] = [len(t.removesuffix(suffix)) for t in vocab]
        letters, numbers, spaces = _class("L"), _class("N"), _SPACES
        other = f"[^{spaces}{letters}{numbers}]+"
        ends = "'s|'t|'re|'ve|'m|'ll|'d|"
        self.lower = spec["normalizer"] is not None
        if self.lower:
            self.split = re.compile(f"[{letters}]+|[{numbers}]|{ends}{other}").findall
        else:
            self.split = re.compile(f" ?[{letters}]+| ?[{numbers}]+|{ends} ?{other}"
                                    f"|[{spaces}]+(?![^{spaces}])|[{spaces}]+").findall
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        self.known = Generations(CACHE_WORDS), Generations(CACHE_WORDS)          # ids of pre-tokens as in the text, in the byte alphabet

    def words(self, text: str) -> tuple[list[str], bool]:
        """Pre-tokens of a text without special strings; True if they are spelt in the byte alphabet already."""
        if _PLAIN.fullmatch(text):
            return self.split(text.lower() if self.lower else text), False
        if self.full.normalizer is not None:
            text = self.full.normalizer.normalize_str(text)
        return [w for w, _ in self.full.pre_tokenizer.pre_tokenize_str(text)], True

    def merge(self, words: list[str], mapped: bool) -> list[bytes]:
        """Ids of single pre-tokens, by the library's merges."""
        out: list[bytes] = []
        for s in range(0, len(words), MERGED):                   # the byte alphabet has no white space
            part = words[s:s + MERGED]
            text = " ".join(part) if mapped else spell(part)
            e, = self.model.encode_batch_fast([text], add_special_tokens=False)          # without offsets and places of words
            flat = np.asarray(e.ids, "<u4")
            spelt, ends = np.cumsum(self.spelt[flat]), np.cumsum([len(w) for w in (part if mapped else text.split(" "))])
            if len(flat) and spelt[-1] == ends[-1]:
                cuts = [0, *(4 * np.searchsorted(spelt, ends, "right")).tolist()]
            else:                                                # a vocabulary that lacks a byte
                e = self.model.encode(text, add_special_tokens=False)
                cuts = (4 * np.searchsorted(np.asarray(e.word_ids, np.int64), np.arange(len(part) + 1))).tolist()
            ids = flat.tobytes()
            out += [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return out

    def lookup(self, words: list[str], mapped: bool) -> list[bytes]:
        """The ids of each word. Words are numbered first: the cache, which is large, is asked once for each distinct one."""
        distinct, at = numbered(words)
        return list(map(self.distinct(distinct, mapped).__getitem__, at))

    def distinct(self, words: list[str], mapped: bool) -> list[bytes]:
        """``lookup`` of distinct words: from the cache, or merged."""
        return self.known[mapped].lookup(words, lambda new: self.merge(new, mapped))

    def _cut(self, text: str) -> list:
        """The parts of a text: ids of a special string, or (pre-tokens, spelt in the byte alphabet)."""
        if not text:
            return []
        if "<|" in text and any(s in text for s in self.special):
            return [self.special[p].to_bytes(4, "little") if p in self.special else self.words(p)
                    for p in self.cut_special(text) if p]
        return [self.words(text)]

    def encode_parts(self, parts: list[list]) -> list[bytes]:
        """The ids of texts that ``_cut`` has cut."""
        flat: tuple[list[str], list[str]] = [], []
        for ps in parts:
            for p in ps:
                if p.__class__ is tuple:
                    flat[p[1]].extend(p[0])
        values = [self.lookup(words, bool(mapped)) if words else [] for mapped, words in enumerate(flat)]
        at, out = [0, 0], []
        for ps in parts:
            ids: list[bytes] = []
            for p in ps:
                if p.__class__ is tuple:
                    start = at[p[1]]
                    at[p[1]] = end = start + len(p[0])
                    ids += values[p[1]][start:end]
                else:
                    ids.append(p)
            out.append(b"".join(ids))
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes."""
        return self.encode_parts([self._cut(t) for t in texts])

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]


@functools.lru_cache(4)
def worker_ids(path: str) -> WordIds:
    """One encoder per worker process and file."""
    return WordIds(path)


def little_endian(ids: bytes) -> np.ndarray:
    out = np.frombuffer(ids, "<u4")
    return out if sys.byteorder == "little" else out.astype(np.uint32)
