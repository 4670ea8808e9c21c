"""Operator 9, quality classifier: a byte-level convolutional network in numpy.

The UTF-8 bytes of the whole text are cut into chunks of ``CHUNK`` bytes that overlap by ``OVERLAP``. Every byte becomes a learned
vector of ``EMBED`` numbers and one channel that tells whether the four bytes ending there stood within the last ``LAGS`` bytes of the
chunk. ``FILTERS`` learned filters of ``WIDTH`` bytes run over each chunk in steps of ``STEP`` bytes, from its first byte to its last, and
are max-pooled; the mean and the largest of the pooled values over all chunks go through one hidden layer into one probability.

Training: a sample of at most ``TRAIN_ROWS`` labelled documents, half of each class, those with the smallest hash of their id, and of
at most ``TRAIN_BYTES`` in all (half for each class; a document longer than ``LONGEST`` bytes is not drawn). The whole texts of the
sample reach the driver, where the network is fitted by Adam on all their chunks. The logit is then moved by the classes' shares in
all labels. Scoring reads every chunk of every document, whatever its length.

Defined results: null and empty texts are one chunk of zero bytes and get its score; rows that repeat are scored each; labels that are
null never train; without two classes among the labels every score is the share of class 1 (0.5 without labels); further columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import crc_mod, fewest, fields, map_batches, prepare, quoted, read_table

CHUNK, OVERLAP = 257, 32       # CHUNK - WIDTH is a multiple of STEP
EMBED, WIDTH, STEP, FILTERS, HIDDEN = 7, 8, 3, 16, 16
LAGS = 32
TRAIN_ROWS, TRAIN_BYTES, LONGEST = 3000, 32 << 20, 1 << 20
AT_ONCE = 256                 # chunks whose windows are held at once
EPOCHS, BATCH, RATE = 8, 32, 4e-3
LEAST_STEPS = 700             # of few documents, more passes
CUT = 0.3


def chunks_of(text: str | None) -> np.ndarray:
    """All chunks of a text as rows of bytes; the last one is filled with zeros."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(raw) - OVERLAP) // step))
    padded = np.zeros((n - 1) * step + CHUNK, np.uint8)
    padded[:len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


def repeats(chunks: np.ndarray) -> np.ndarray:
    """1 where the four bytes ending there stood up to LAGS bytes earlier in the chunk."""
    x = chunks.astype(np.uint32)
    four = x[:, 3:] | x[:, 2:-1] << 8 | x[:, 1:-2] << 16 | x[:, :-3] << 24
    hit = np.zeros(four.shape, bool)
    for lag in range(2, LAGS + 1):
        hit[:, lag:] |= four[:, lag:] == four[:, :-lag]
    out = np.zeros(chunks.shape, np.float32)
    out[:, 3:] = hit & (four != 0)
    return out


class Network:
    """Weights by name; ``forward`` of chunks that belong to documents by their starts."""

    def __init__(self, rng: np.random.Generator):
        inputs = WIDTH * (EMBED + 1)
        self.w = {"embed": rng.normal(0, 0.5, (256, EMBED)), "filters": rng.normal(0, (2 / inputs) ** 0.5, (inputs, FILTERS)),
                  "bias": np.zeros(FILTERS), "hidden": rng.normal(0, (1 / (2 * FILTERS)) ** 0.5, (2 * FILTERS, HIDDEN)),
                  "hidden_bias": np.zeros(HIDDEN), "out": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "out_bias": np.zeros(1)}
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}
        self.shift = 0.0

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        x = np.concatenate([self.w["embed"][chunks], repeats(chunks)[:, :, None]], 2)
        x = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1)[:, ::STEP]              # chunk, position, channel, byte
        return x.reshape(x.shape[0], x.shape[1], -1)

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        """Max-pooled filters of every chunk, a bounded number of chunks at once."""
        out = [np.zeros((0, FILTERS), np.float32)]
        for s in range(0, len(chunks), AT_ONCE):
            x = self.windows(chunks[s:s + AT_ONCE])
            out.append(np.maximum((x.reshape(-1, x.shape[2]) @ self.w["filters"]).reshape(x.shape[0], x.shape[1], -1).max(1) + self.w["bias"], 0))
        return np.concatenate(out)

    def peaks(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every chunk and filter: the position of the largest value, that value, and the window there."""
        x = self.windows(chunks)
        a = (x.reshape(-1, x.shape[2]) @ self.w["filters"]).reshape(x.shape[0], x.shape[1], -1)
        at = a.argmax(1)
        return at, np.take_along_axis(a, at[:, None, :], 1)[:, 0] + self.w["bias"], x[np.arange(len(x))[:, None], at]

    def head(self, mean: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = np.concatenate([mean, top], 1)
        h = np.tanh(x @ self.w["hidden"] + self.w["hidden_bias"])
        return x, h, h @ self.w["out"] + self.w["out_bias"]

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability of class 1 of every whole text."""
        mean, top = np.zeros((len(texts), FILTERS), np.float32), np.zeros((len(texts), FILTERS), np.float32)
        held: list[tuple[int, np.ndarray]] = []
        size = 0
        for i, text in enumerate(texts):
            c = chunks_of(text)
            held.append((i, c))
            size += len(c)
            if size >= 2048 or i == len(texts) - 1:
                if len(held) == 1:
                    p = self.pooled(c)
                    mean[i], top[i] = p.mean(0), p.max(0)
                else:
                    p, starts = self.pooled(np.concatenate([x for _, x in held])), np.cumsum([0, *(len(x) for _, x in held)])
                    rows = [k for k, _ in held]
                    mean[rows] = np.add.reduceat(p, starts[:-1]) / np.diff(starts)[:, None]
                    top[rows] = np.maximum.reduceat(p, starts[:-1])
                held, size = [], 0
        z = self.head(mean, top)[2].astype(np.float64) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def gradients(self, chunks: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, n = self.w, len(y)
        peaks = [self.peaks(chunks[s:s + AT_ONCE]) for s in range(0, len(chunks), AT_ONCE)]
        at, raw, picked = (np.concatenate(part) for part in zip(*peaks, strict=True))        # picked: chunk, filter, input
        p = np.maximum(raw, 0)
        count = np.diff(np.append(starts, len(p)))
        doc = np.repeat(np.arange(n), count)
        mean, top = np.add.reduceat(p, starts) / count[:, None], np.maximum.reduceat(p, starts)
        f, h, z = self.head(mean, top)
        dz = (1 / (1 + np.exp(-z)) - y) / n
        dh = dz[:, None] * w["out"] * (1 - h * h)
        df = dh @ w["hidden"].T
        best = p == top[doc]
        ties = np.add.reduceat(best.astype(np.float32), starts)
        dp = df[doc, :FILTERS] / count[doc][:, None] + best * df[doc, FILTERS:] / ties[doc]
        dp = np.where(raw > 0, dp, 0).astype(np.float32)
        g = {"out": h.T @ dz, "out_bias": dz.sum(keepdims=True), "hidden": f.T @ dh, "hidden_bias": dh.sum(0), "bias": dp.sum(0)}
        rows = np.arange(len(p))[:, None]
        g["filters"] = np.einsum("cfi,cf->if", picked, dp)
        dx = dp[:, :, None] * w["filters"].T[None]                           # chunk, filter, input
        dx = dx.reshape(len(p), FILTERS, EMBED + 1, WIDTH)[:, :, :EMBED]
        byte = chunks[rows[:, :, None], at[:, :, None] * STEP + np.arange(WIDTH)]            # chunk, filter, byte
        g["embed"] = np.stack([np.bincount(byte.reshape(-1), dx[:, :, e].reshape(-1), 256) for e in range(EMBED)], 1)
        return g


def fit(samples: list[tuple[np.ndarray, int]], seed: int = 5) -> Network:
    """A network fitted to (chunks, label) of each document."""
    rng = np.random.default_rng(seed)
    net = Network(rng)
    m = {k: np.zeros_like(v) for k, v in net.w.items()}
    v = {k: np.zeros_like(x) for k, x in net.w.items()}
    batches = -(-len(samples) // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // batches))
    steps, t = epochs * batches, 0
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for s in range(0, len(order), BATCH):
            part = [samples[i] for i in order[s:s + BATCH]]
            chunks = [c for c, _ in part]
            starts = np.cumsum([0, *map(len, chunks)])[:-1]
            g = net.gradients(np.concatenate(chunks), starts, np.asarray([y for _, y in part], np.float32))
            t += 1
            rate = RATE * (1 - t / (steps + 1))
            for k, x in g.items():
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.999 * v[k] + 0.001 * x * x
                net.w[k] -= (rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8) + 1e-5 * net.w[k]).astype(np.float32)
    return net


def train(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = TRAIN_ROWS) -> Network:
    """A network from ``labels`` (doc_id, quality) where ``usable`` holds and the texts of ``docs``."""
    prepare(docs.sparkSession)
    marked = labels.where(usable).select("doc_id", F.col("quality").cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    shares = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    few = fewest(marked.distinct(), "y", "doc_id", rows // 2)
    chosen = docs.select("doc_id", "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= LONGEST).join(F.broadcast(few), "doc_id")
    once = chosen.groupBy("doc_id", "y").agg(F.min("n").alias("n"), F.min("text").alias("text"))         # a doc_id may repeat any number of times
    upto = Window.partitionBy("y").orderBy("n")                                                         # at most half of ``rows``
    once = once.withColumn("upto", F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(upto)).where(F.col("upto") <= TRAIN_BYTES // 2)
    got = once.select("doc_id", "y", "text").toPandas().sort_values(["doc_id", "y"])                      # at most ``TRAIN_BYTES``
    samples = [(chunks_of(t), y) for t, y in zip(got["text"], got["y"], strict=True)]
    ones = sum(y for _, y in samples)
    if 0 < ones < len(samples):
        net = fit(samples)
        net.shift = float(np.log(shares[1] / shares[0]) - np.log(ones / (len(samples) - ones)))
        return net
    net = Network(np.random.default_rng(0))
    net.w["out"][:] = 0
    share = shares.get(1, 0) / max(1, sum(shares.values())) if shares else 0.5
    net.shift = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    return net


def scored(docs: DataFrame, net: Network, keep: list[str] | None = None, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """The columns in ``keep`` with score and prediction (named by ``names``) for every row of ``docs``."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(net)               # some thousand numbers
    keep = ["doc_id"] if keep is None else keep

    def run(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            p = shared.value.score(b.column("text").to_pylist())
            yield {c: b.column(c) for c in keep} | {names[0]: p, names[1]: (p >= CUT).astype(np.int32)}

    return map_batches(docs.select(*map(quoted, dict.fromkeys([*keep, "text"]))), run, fields(docs, keep) + f"{names[0]} double, {names[1]} int")


def learnable() -> Column:
    return crc_mod("doc_id", 5) != 0


def op9_quality_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    net = train(docs, read_table(spark, sf_dir, "labels"), learnable())
    return scored(docs, net).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
