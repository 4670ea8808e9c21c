"""Operators 11 and 13 against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcela.llm import decontamination, fill_middle

from conftest import frame, odd_rows, prose  # noqa: I001


def bag(rows):
    return Counter(map(tuple, rows))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_fim(doc, text):
    text = text or ""
    x, n = sha(f"1:{'' if doc is None else doc}"), len(text)
    h = [int(x[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc, n, "plain", None, None, sha(text), sha(text)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, m, z = text[:lo], text[lo:hi], text[hi:]
    form, out = ("spm", f"<S>{z}<P>{a}<M>{m}") if h[3] % 100 < 20 else ("psm", f"<P>{a}<S>{z}<M>{m}")
    return doc, n, form, lo, hi - lo, sha(out), sha(text)


def test_fill_in_middle(spark, folder, empty):
    rows = odd_rows() + [(1000 + i, t) for i, t in enumerate(["a<P>b", "x<S", "<", "<<P", "P>S>M>", "<M>", "<P", "👍🏽" * 200] * 20)]
    got = fill_middle.op11_fill_in_middle(spark, folder(documents=frame(spark, rows)))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    want = bag(plain_fim(*r) for r in rows)
    assert bag(got.collect()) == want and {r[2] for r in want} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(empty).collect() == []


@pytest.mark.parametrize("unit", [r"\S+\s*", r"[^\n]*\n", r"\d", r"(?s:.)"])
def test_units_of_a_pattern(spark, unit):
    """Cuts lie at unit borders, and an output gives back its text."""
    rows = [(i, prose(i, 1 + 40 * i)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = fill_middle.fill_in_middle(docs, unit=unit, percent=100)
    got = made.withColumn("again", fill_middle.restored("output", "form")).collect()
    texts = dict(rows)
    for r in got:
        ends, at = {0, len(texts[r.doc_id])}, 0
        for m in re.finditer(unit, texts[r.doc_id]):
            ends |= {m.start(), m.end()}
        assert r.n == len(ends) - 1 and r.again == texts[r.doc_id]
        if r.form != "plain":
            x = sha(f"1:{r.doc_id}")
            lo, hi = sorted(int(x[i:i + 8], 16) % (r.n + 1) for i in (0, 8))
            cut = sorted(ends)
            assert (r.prefix_chars, r.middle_chars) == (cut[lo], cut[hi] - cut[lo])


def test_skip_list_reaches_every_rank():
    rng, towers = np.random.default_rng(1), fill_middle.Towers(spacing=4, seed=3)
    for n in (1, 2, 5, 300, 70_000):
        widths = rng.integers(1, 9, n)
        for w in (widths, None):
            units = fill_middle.SkipList(n, w, towers)
            before = np.concatenate([[0], np.cumsum(widths if w is not None else np.ones(n, int))])
            for rank in {0, 1, n, n // 2, *rng.integers(0, n + 1, 200).tolist()}:
                assert units.reach(rank) == before[rank]
    assert len(fill_middle.SkipList(70_000, None, towers).express) >= 5
    with pytest.raises(IndexError):
        fill_middle.SkipList(3, None, towers).reach(4)


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def plain_hits(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        for i in range(max(len(w) - window + 1, min(1, len(w)))):
            windows.setdefault(tuple(w[i:i + window]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, met = plain_words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if x := windows.get(tuple(w[i:i + size])):
                    hit.update(range(i, i + size))
                    met |= x
        out.append((doc, len(w), len(hit), len(met), sha(",".join(sorted(met))), bool(hit)))
    return out


def leaky(seed, letters="abc", n_docs=60):
    """Documents and items over few words: factors of all lengths are shared."""
    rng = random.Random(seed)
    line = lambda n: " ".join(rng.choice(letters) for _ in range(n))
    items = [(f"i{k}", line(rng.choice([0, 1, 2, 3, 7, 9, 10, 11, 25, 40]))) for k in range(25)]
    items += [items[0], ("i3", line(12)), (None, line(10)), ("x", None), ("y", "..."), ("Z10", "É中 Ab-9")]
    docs = []
    for k in range(n_docs):
        parts = [line(rng.randint(0, 30)) for _ in range(3)]
        item = rng.choice(items)[1] or ""
        docs.append((k, "Q, ".join(parts) if k % 3 else f"{parts[0]}\n{item.upper()}. {parts[1]}"))
    return docs + [(None, None), (5, ""), (7, "é中 aB 9"), docs[0], docs[0]], items


@pytest.mark.parametrize("letters,block", [("ab", 40), ("abcdefgh", 100_000), ("abcdefghijklmnopqrstuvwxyz", 150)])
def test_decontamination_brute_force(spark, folder, letters, block):
    docs, items = leaky(len(letters), letters)
    if len(letters) > 8:                                   # no one-word items: most words are not hit
        items = [x for x in items if len(plain_words(x[1])) > 2]
    d, b = frame(spark, docs), spark.createDataFrame(items, "item_id string, text string")
    got = decontamination.contamination(d, b, block_words=block)
    rows = [(r.doc_id, r.n_words, n := sum(s.behind - s.first for s in r.spans), len(r.items), sha(",".join(r.items)), n > 0) for r in got.collect()]
    assert bag(rows) == bag(plain_hits(docs, items))
    if block > 1000:
        q = decontamination.op13_decontamination(spark, folder(documents=d, benchmark=b))
        assert q.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
        assert bag(q.collect()) == bag(rows)


def test_long_items_meet_in_segments(spark):
    item = prose(8, 20_000)
    words = plain_words(item)
    docs = [(0, " ".join(words)), (1, " ".join(words[4080:4110])), (2, " ".join(words[4090:4099])), (3, " ".join(words[8180:8200]))]
    got = decontamination.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                        spark.createDataFrame([(1, item)], "item_id long, text string"), block_words=5000)
    assert {r.doc_id: sum(s.behind - s.first for s in r.spans) for r in got.collect()} == {0: len(words), 1: 30, 2: 0, 3: 20}


def test_odd_documents_and_empty_tables(spark, odd, empty):
    items = spark.createDataFrame([("a", prose(2, 300)), ("b", "日本語のテキスト")], "item_id string, text string")
    got = decontamination.contamination(odd, items).collect()
    assert bag((r.doc_id, r.n_words, sum(s.behind - s.first for s in r.spans)) for r in got) == bag(
        x[:3] for x in plain_hits(odd_rows(), [("a", prose(2, 300)), ("b", "日本語のテキスト")]))
    assert decontamination.contamination(empty, items).collect() == []
    none = decontamination.contamination(odd, items.limit(0)).collect()
    assert len(none) == len(odd_rows()) and not any(r.spans or r.items for r in none)


def test_spans_are_removed_and_covered_documents_go(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    clean = "an entirely different text of no test, " * 3
    docs = [(0, clean), (1, f"{clean}! {passage.upper()}; {clean}"), (2, f"so: {passage}"), (3, None), (4, "")]
    d = frame(spark, docs).withColumn("odd.name", F.lit(1))
    out = decontamination.decontaminate(d, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert out.columns == d.columns
    assert {r.doc_id: r.text for r in out.collect()} == {0: clean, 1: f"{clean}! ; {clean}", 3: None, 4: ""}
