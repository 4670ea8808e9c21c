"""Operator 11, fill-in-the-middle: two cuts of a text found by an indexable skip list.

The units of a text (code points, or the matches of a pattern from left to right; what lies between two matches is a unit too)
are the nodes of a skip list. A node's tower has a seeded geometric height, so lane k is an express lane over about one in
``SPACING ** k`` units. Every link carries its unit-width and its code-point-width; a descent adds up both and stops at the
wanted unit rank exactly, with the code points before it. Towers depend on the rank alone: texts share them, and the links over
units of one code point as well.

The draws are the first 8-digit groups of a SHA-256 over the seed and the doc_id: a document is cut alike in every run and in every
partitioning, and the job has no shuffle. Rows that repeat a doc_id and a text give equal rows.

Defined results: null texts count as empty, empty texts stay plain; a null doc_id draws as the empty text; texts that hold one of
the markers stay plain, so the markers of an output are unambiguous; further columns are ignored; an empty table gives an empty
result. A text is held whole by its task.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, prepare, read_table, texts_of

PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
SEED = 1
PERCENT = 90                  # of the documents that can be cut
SPM_PERCENT = 20              # of the cut ones, suffix first
SPACING = 16                  # units of a lane between two towers of the next one


class Towers:
    """Which units have towers of at least k lanes, for all k; grows with the longest text asked for."""

    def __init__(self, spacing: int = SPACING, seed: int = 11):
        self.spacing, self.rng = spacing, np.random.default_rng(seed)
        self.height = np.full(1, 64, np.int8)                       # the head stands in every lane
        self.lanes: list[np.ndarray] = []                           # unit ranks of lane k + 1
        self.down: list[np.ndarray] = []                            # their places one lane below

    def grow(self, n: int) -> None:
        if n <= len(self.height):
            return
        more = self.rng.geometric(1 - 1 / self.spacing, max(n, 2 * len(self.height), 1 << 16) - len(self.height)) - 1
        self.height = np.concatenate([self.height, np.minimum(more, 63).astype(np.int8)])
        self.lanes, below = [], None
        self.down = []
        for k in range(1, int(self.height[1:].max()) + 1):
            at = np.flatnonzero(self.height >= k)
            self.lanes.append(at)
            self.down.append(at if below is None else np.searchsorted(below, at))
            below = at


class SkipList:
    """Lanes from the top down to the units; ``widths`` are the units' code points (None: one each)."""

    def __init__(self, n: int, widths: np.ndarray | None, towers: Towers):
        towers.grow(n)
        self.n, self.base = n, widths
        self.express: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []     # unit-widths, code-point-widths, place below
        for at, down in zip(towers.lanes, towers.down, strict=True):
            at = at[:np.searchsorted(at, n)]
            if len(at) < 2:
                break
            units = np.diff(at, append=n)
            points = units if widths is None else np.add.reduceat(widths, at)
            self.express.insert(0, (units, points, down))

    def reach(self, rank: int) -> int:
        """Code points before the unit of this rank (0 to n)."""
        if not 0 <= rank <= self.n:
            raise IndexError(rank)
        left, points, node = rank, 0, 0
        for units, widths, down in self.express:
            while node < len(units) and units[node] <= left:
                left -= int(units[node])
                points += int(widths[node])
                node += 1
            if not left:                                             # the end of a link: no lower lane can add to it
                return points
            node = int(down[node])
        return points + (left if self.base is None else int(self.base[node:node + left].sum()))


@functools.lru_cache(1)
def towers() -> Towers:
    return Towers()


def unit_widths(text: str, pattern: re.Pattern | None) -> tuple[int, np.ndarray | None]:
    """Number of units and their code points; no pattern: a code point is a unit."""
    if pattern is None:
        return len(text), None
    at, ends = 0, []
    for m in pattern.finditer(text):
        if m.end() == m.start():
            continue
        if m.start() > at:
            ends.append(m.start())
        ends.append(at := m.end())
    if at < len(text):
        ends.append(len(text))
    return len(ends), np.diff(np.asarray(ends, np.int64), prepend=0)


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned 32-bit numbers of a document."""
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(x[8 * i:8 * i + 8], 16) for i in range(4)]


def fill_in_middle(docs: DataFrame, unit: str | None = None, seed: int = SEED, percent: int = PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars and output of every row of ``docs`` (doc_id, text).

    ``unit`` is a pattern (Python's ``re``) of a unit, say ``r"\\S+\\s*"`` for words or ``r".*\\n"`` for lines; None: code points."""
    prepare(docs.sparkSession)

    def cut(batches: Iterable[pa.RecordBatch]):
        pattern = re.compile(unit) if unit else None
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("n", "form", "prefix_chars", "middle_chars", "output")}
            for doc, text in zip(b.column("doc_id").to_pylist(), texts_of(b), strict=True):
                h = draws(doc, seed)
                n, widths = unit_widths(text, pattern)
                form, first, middle, made = "plain", None, None, text
                if text and h[2] % 100 < percent and not any(m in text for m in MARKS):
                    units = SkipList(n, widths, towers())
                    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
                    a, z = units.reach(lo), units.reach(hi)
                    first, middle = a, z - a
                    if h[3] % 100 < spm_percent:
                        form, made = "spm", f"{SUFFIX}{text[z:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:z]}"
                    else:
                        form, made = "psm", f"{PREFIX}{text[:a]}{SUFFIX}{text[z:]}{MIDDLE}{text[a:z]}"
                for k, v in zip(out, (n, form, first, middle, made), strict=True):
                    out[k].append(v)
            yield out | {"doc_id": b.column("doc_id")}

    return map_batches(docs.select("doc_id", "text"), cut,
                       "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str, form: str) -> Column:
    """The exact text from an output and its form, as a Column."""
    part = F.split(output, "|".join(MARKS), -1)                       # empty, first part, second part, middle
    return (F.when(F.col(form) == "psm", F.concat(part[1], part[3], part[2]))
            .when(F.col(form) == "spm", F.concat(part[2], part[3], part[1])).otherwise(F.col(output)))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_in_middle(read_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored("output", "form"), 256).alias("restored_sha256"))


ORACLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
                  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT *, ('0x' || substr(x, 1, 8))::BIGINT AS h1, ('0x' || substr(x, 9, 8))::BIGINT AS h2,
             ('0x' || substr(x, 17, 8))::BIGINT AS h3, ('0x' || substr(x, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(t, 1, lo) AS a, substr(t, lo + 1, hi - lo) AS m, substr(t, hi + 1) AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m
                        ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""
