"""Operator 8, language identification: interpolated Kneser-Ney character models, one per language.

Texts are lowered, every run of other characters becomes one space, and each language gets a character model of order ``ORDER``.
Highest-order counts are raw, lower orders count the distinct characters before a gram, each order takes off its own discount
n1 / (n1 + 2 n2) and gives the mass to the next lower order, down to the uniform distribution. All languages share one sorted
array of gram hashes per order; a row holds the interpolated log probability for every language and the log weight with which a
longer gram backs off to it, so one lookup serves all languages and an unseen gram falls back order by order.

A text goes to the language of the lowest cross-entropy per character over the whole text. ``score`` is that language's
share under a softmax of the entropies whose temperature is fitted on texts kept out of the counts. Rejection: those texts
also give the highest entropy of a plausible text (``REJECT_QUANTILE`` of them plus ``MARGIN``); a text beyond it, or without
letters, is rejected.

Training reads at most ``TRAIN_DOCS`` documents a language (those with the smallest hash of their id and text) and counts their grams on the
executors, over their whole texts; only sums of grams and a row of entropies for every calibration text reach the driver.

Defined results: null texts and texts without letters are ``und`` with score 0; rows that repeat are returned each; rows without lang
never train; an empty table, or one without any labelled text, gives ``und`` throughout; further columns are ignored.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, fewest, fields, map_batches, materialize, prepare, quoted, read_table

ORDER = 4
TRAIN_DOCS = 600             # documents a language that are read for training, one in six of them for calibration
SLICE = 1 << 20              # characters of a text that are counted at once
REJECT_QUANTILE = 0.999
MARGIN = 0.75                # nats a character beyond the quantile
SPACE, ASTRAL = 32, 0xFFFF
_MULT = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(1)
def fold_table() -> np.ndarray:
    """The folded character of every character of the basic plane: lower case of a letter, else a space."""
    out = np.full(0x10000, SPACE, np.uint32)
    for c in range(0x10000):
        ch = chr(c)
        if unicodedata.category(ch)[0] == "L":
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def folded(text: str | None) -> np.ndarray:
    """Folded characters of a text with one space between words and at both ends; empty without letters."""
    raw = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    chars = fold_table()[np.minimum(raw, 0xFFFF)]
    for i in np.flatnonzero(raw > 0xFFFF).tolist():                       # rare: letters of other planes share one sign
        chars[i] = ASTRAL if unicodedata.category(chr(raw[i]))[0] == "L" else SPACE
    blank = chars == SPACE
    if blank.all():
        return np.zeros(0, np.uint32)
    keep = ~blank
    keep[1:] |= ~blank[:-1]                                               # the first blank of a run
    chars = chars[keep]
    return np.concatenate([np.full(int(chars[0] != SPACE), SPACE, np.uint32), chars, np.full(int(chars[-1] != SPACE), SPACE, np.uint32)])


def grams(chars: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams, in order."""
    h = np.zeros(max(0, len(chars) - n + 1), np.uint64)
    for i in range(n):
        h = (h ^ chars[i:len(h) + i].astype(np.uint64) + np.uint64(1)) * _MULT
        h ^= h >> np.uint64(29)
    return h


class Model:
    """keys[n]: sorted hashes of the n-grams; logp[n], back[n]: a row a gram, a column a language."""

    def __init__(self, langs: list[str], keys: list[np.ndarray], logp: list[np.ndarray], back: list[np.ndarray], floor: np.ndarray,
                 temperature: float = 1.0, limit: float = np.inf):
        self.langs, self.keys, self.logp, self.back, self.floor = langs, keys, logp, back, floor
        self.temperature, self.limit = temperature, limit

    @staticmethod
    def fit(counts: dict[str, tuple[np.ndarray, np.ndarray]], alphabet: int) -> Model:
        """counts: of each language, the distinct ORDER-grams as rows of characters and how often each occurs."""
        langs = sorted(counts)
        per = {lang: _kneser_ney(*counts[lang], alphabet) for lang in langs}
        keys, logp, back = [np.zeros(0, np.uint64)], [np.zeros((0, len(langs)))], [np.zeros((0, len(langs)))]
        floor = np.log(np.asarray([per[lang][0] for lang in langs]) / alphabet)
        for n in range(1, ORDER + 1):
            # A context at the start of a text alone is no gram that anything precedes; it needs a row for its weight.
            chars = np.unique(np.concatenate([per[lang][part][n][0] for lang in langs for part in (1, 2)]), axis=0)
            key = _row_keys(chars)
            order = np.argsort(key)
            chars, key = chars[order], key[order]
            # A gram that a language has not seen backs off there: weight of its context, then the shorter gram.
            p = np.empty((len(key), len(langs)))
            if n == 1:
                p[:] = floor
            else:
                at = _find(keys[n - 1], _row_keys(chars[:, :-1]))
                p[:] = np.where(at[:, None] >= 0, back[n - 1][np.maximum(at, 0)], 0.0)
                p += _logp(keys, logp, back, floor, chars[:, 1:], n - 1)
            for i, lang in enumerate(langs):
                own, values = per[lang][1][n]
                p[_find(key, _row_keys(own)), i] = np.log(values)
            w = np.zeros((len(key), len(langs)))
            for i, lang in enumerate(langs):
                contexts, weights = per[lang][2][n]
                at = _find(key, _row_keys(contexts))
                w[at[at >= 0], i] = np.log(weights[at >= 0])
            keys.append(key)
            logp.append(p)
            back.append(w)
        return Model(langs, keys, [x.astype(np.float32) for x in logp], [x.astype(np.float32) for x in back], floor.astype(np.float32))

    def entropy(self, texts: list[np.ndarray]) -> np.ndarray:
        """Cross-entropy a character of every folded text under every language; all texts of a batch at once."""
        out = np.zeros((len(texts), len(self.langs)))
        size = np.asarray([max(0, len(t) - ORDER + 1) for t in texts])
        rows = [(i, s) for i, n in enumerate(size.tolist()) for s in range(0, n, 1 << 18)]
        todo: list[tuple[int, np.ndarray]] = []
        held = 0
        for k, (i, s) in enumerate(rows):
            todo.append((i, texts[i][s:s + (1 << 18) + ORDER - 1]))
            held += len(todo[-1][1])
            if held >= 1 << 18 or k == len(rows) - 1:
                h = [np.concatenate([grams(t, n) if n == ORDER else grams(t, n)[ORDER - n:] for _, t in todo]) for n in range(1, ORDER + 1)]
                context = [np.concatenate([grams(t, n)[ORDER - 1 - n:len(t) - n] for _, t in todo]) for n in range(1, ORDER)]
                p = self._score(h, context)
                ends = np.cumsum([len(t) - ORDER + 1 for _, t in todo])
                np.add.at(out, [i for i, _ in todo], np.add.reduceat(p, np.concatenate([[0], ends[:-1]]), axis=0))
                todo, held = [], 0
        for i in np.flatnonzero((size == 0) & np.asarray([len(t) > 0 for t in texts], bool)).tolist():
            t = texts[i]                                                  # shorter than a gram: the grams that end in it
            chars = np.stack([t])
            out[i] = _logp(self.keys, self.logp, self.back, self.floor, chars, len(t))[0]
            size[i] = 1
        return -out / np.maximum(size, 1)[:, None]

    def _score(self, h: list[np.ndarray], context: list[np.ndarray]) -> np.ndarray:
        p = np.zeros((len(h[0]), len(self.langs)), np.float64)
        left = np.arange(len(p))
        for n in range(ORDER, 0, -1):
            at = _find(self.keys[n], h[n - 1][left])
            seen = at >= 0
            p[left[seen]] += self.logp[n][at[seen]]
            left = left[~seen]
            if n > 1 and len(left):
                at = _find(self.keys[n - 1], context[n - 2][left])
                p[left] += np.where(at[:, None] >= 0, self.back[n - 1][np.maximum(at, 0)], 0)
        p[left] += self.floor
        return p

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, score, rejected of every text."""
        chars = [folded(t) for t in texts]
        letters = np.asarray([len(c) > 0 for c in chars], bool)
        if not self.langs or not len(texts):
            return ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
        e = self.entropy(chars)
        low = e.min(1)
        share = np.exp(-(e - low[:, None]) / self.temperature)
        best = e.argmin(1)
        score = 1 / share.sum(1)
        lang = [self.langs[b] if ok else "und" for b, ok in zip(best.tolist(), letters.tolist(), strict=True)]
        return lang, np.where(letters, score, 0.0).tolist(), (~letters | (low > self.limit)).tolist()


def _row_keys(chars: np.ndarray) -> np.ndarray:
    h = np.zeros(len(chars), np.uint64)
    for i in range(chars.shape[1]):
        h = (h ^ chars[:, i].astype(np.uint64) + np.uint64(1)) * _MULT
        h ^= h >> np.uint64(29)
    return h


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _logp(keys, logp, back, floor, chars: np.ndarray, n: int) -> np.ndarray:
    """Log probability of the last character of every gram of n characters (at most ORDER of them count), by backing off."""
    chars = chars[:, -ORDER:]
    n = min(n, ORDER)
    out = np.zeros((len(chars), len(floor)))
    left = np.arange(len(chars))
    for k in range(n, 0, -1):
        part = chars[left][:, chars.shape[1] - k:]
        at = _find(keys[k], _row_keys(part))
        out[left[at >= 0]] += logp[k][at[at >= 0]]
        left, part = left[at < 0], part[at < 0]
        if k > 1 and len(left):
            at = _find(keys[k - 1], _row_keys(part[:, :-1]))
            out[left] += np.where(at[:, None] >= 0, back[k - 1][np.maximum(at, 0)], 0.0)
    out[left] += floor
    return out


def _kneser_ney(chars: np.ndarray, n: np.ndarray, alphabet: int):
    """Interpolated probabilities of one language: the weight of the uniform distribution; by order the grams and their
    probabilities; by order the contexts (as grams of that order) and their weights."""
    table = {ORDER: (chars, n)}
    for k in range(ORDER - 1, 0, -1):                 # distinct characters before a gram
        table[k] = np.unique(table[k + 1][0][:, 1:], axis=0, return_counts=True)
    probs, weights = {}, {k: (np.zeros((0, k), np.uint32), np.zeros(0)) for k in range(ORDER + 1)}
    lower_keys = lower_p = None
    uniform = 1.0
    for k in range(1, ORDER + 1):
        g, c = table[k]
        ones, twos = int((c == 1).sum()), int((c == 2).sum())
        d = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones + twos else 0.5
        contexts, at = np.unique(g[:, :-1], axis=0, return_inverse=True) if k > 1 else (np.zeros((1, 0), np.uint32), np.zeros(len(g), int))
        at = at.reshape(-1)
        total = np.bincount(at, c, len(contexts))
        weight = d * np.bincount(at, minlength=len(contexts)) / total
        if k == 1:
            low = np.full(len(g), 1 / alphabet)
            uniform = float(weight[0])
        else:
            low = lower_p[_find(lower_keys, _row_keys(g[:, 1:]))]
            weights[k - 1] = (contexts, weight)
        p = (c - d) / total[at] + weight[at] * low
        probs[k] = (g, p)
        key = _row_keys(g)
        order = np.argsort(key)
        lower_keys, lower_p = key[order], p[order]
    return uniform, probs, weights


def train(rows: DataFrame, usable: Column, docs_per_lang: int = TRAIN_DOCS) -> Model:
    """A model from the labelled rows (doc_id, text, lang) where ``usable`` holds."""
    prepare(rows.sparkSession)
    rows = rows.select("doc_id", "text", "lang", usable.alias("u")).where("u and lang is not null and text is not null")
    few = fewest(rows.select("lang", F.xxhash64("doc_id", "text").alias("h")).distinct(), "lang", "h", docs_per_lang).drop("lang")
    few = few.groupBy("h").agg(F.min("n").alias("n"))
    once = rows.withColumn("h", F.xxhash64("doc_id", "text")).join(F.broadcast(few), "h").groupBy("h", "lang").agg(      # a row however often it repeats
        F.first("text").alias("text"), F.first("n").alias("n"))
    chosen = materialize(once.select("lang", "text", (F.col("n") % 6 == 0).alias("calibrate")), "languages")           # docs_per_lang rows a language

    def count(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            for lang, text, calibrate in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), b.column("calibrate").to_pylist(), strict=True):
                if calibrate:
                    continue
                c = folded(text)
                for s in range(0, len(c) - ORDER + 1, SLICE):
                    part = c[s:s + SLICE + ORDER - 1]
                    packed = np.zeros(len(part) - ORDER + 1, np.uint64)       # characters are below 2 ** 16, a gram is one number
                    for i in range(ORDER):
                        packed = packed << np.uint64(16) | part[i:len(packed) + i].astype(np.uint64)
                    g, n = np.unique(packed, return_counts=True)
                    yield {"lang": [lang] * len(n), "gram": g.view(np.int64), "n": n}

    summed = map_batches(chosen.select("lang", "text", "calibrate"), count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    counts = {}
    for lang, part in summed.groupby("lang"):
        part = part.sort_values("gram")
        packed = part["gram"].to_numpy(np.int64).view(np.uint64)
        shifts = np.arange(ORDER - 1, -1, -1, dtype=np.uint64) * np.uint64(16)
        counts[lang] = ((packed[:, None] >> shifts & np.uint64(0xFFFF)).astype(np.uint32), part["n"].to_numpy())
    if not counts:
        return Model([], [], [], [], np.zeros(0))
    alphabet = len({c for g, _ in counts.values() for c in np.unique(g).tolist()}) + 1
    model = Model.fit(counts, alphabet)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def entropies(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            texts = [folded(t) for t in b.column("text").to_pylist()]
            keep = [i for i, (t, lang) in enumerate(zip(texts, b.column("lang").to_pylist(), strict=True)) if len(t) and lang in shared.value.langs]
            yield {"lang": b.column("lang").take(pa.array(keep, pa.int64())), "e": shared.value.entropy([texts[i] for i in keep]).tolist()}

    held = map_batches(chosen.where("calibrate").select("lang", "text"), entropies, "lang string, e array<double>").toPandas()
    return calibrate_model(model, np.asarray(held["e"].tolist(), float).reshape(-1, len(model.langs)), held["lang"].tolist())


def calibrate_model(model: Model, e: np.ndarray, langs: list[str]) -> Model:
    """Fit the temperature and the limit of rejection on the entropies of texts that were not counted."""
    if len(langs):
        right = np.asarray([model.langs.index(lang) for lang in langs])
        best = np.inf
        for t in np.geomspace(0.005, 1, 30):
            z = -(e - e.min(1, keepdims=True)) / t
            loss = float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), right]))
            if loss < best:
                best, model.temperature = loss, float(t)
        model.limit = float(np.quantile(e.min(1), REJECT_QUANTILE)) + MARGIN
    return model


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None, names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """The columns in ``keep`` with language, score and rejection (named by ``names``) for every row of ``docs``."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)           # bounded by the training texts
    keep = ["doc_id"] if keep is None else keep

    def run(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            yield {c: b.column(c) for c in keep} | dict(zip(names, shared.value.predict(b.column("text").to_pylist()), strict=True))

    lang, score, rejected = names
    return map_batches(docs.select(*map(quoted, dict.fromkeys([*keep, "text"]))), run, fields(docs, keep) + f"{lang} string, {score} double, {rejected} boolean")


def learnable() -> Column:
    return crc_mod("doc_id", 3) != 1


def op8_language_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, learnable())
    out = identify(docs, model)
    return out.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")
