"""Operators 1, 4, 5 and 6 against brute force on small fixtures."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from parcela.llm import lines, neighbours, quartiles, simhash
from parcela.llm.components import components
from parcela.llm.vantage import Router, Tree, euclid, hamming, hamming_forest

from conftest import frame, odd_rows, prose  # noqa: I001


def union(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near_lines(n):
    """Lines with copies that differ in a letter or two."""
    rng, out = random.Random(6), []
    for i in range(n):
        base = prose(100 + i % 40, 25).replace("\n", " ")
        at = rng.randrange(len(base))
        out.append(base if rng.random() < 0.4 else base[:at] + rng.choice("xyz") + base[at + 1:])
    return out


def line_oracle(rows):
    """The kept (doc_id, text, line number) by comparing every two distinct lines."""
    def order(d, t):
        return (d is not None, d, signed(t))

    def signed(t):
        h = xxhash.xxh64_intdigest(t.encode(), 42)
        return h - (1 << 64) if h >> 63 else h
    first = {}
    for d, t in sorted({(d, t) for d, t in rows if t}, key=lambda x: order(*x)):
        for i, s in lines.lines_of(t):
            first.setdefault(s, (d, t, i))
    keys = list(first)
    sets = [{s[i:i + lines.SHINGLE] for i in range(len(s) - lines.SHINGLE + 1)} or {s} for s in keys]
    pairs = [(i, j) for i in range(len(keys)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    return {first[keys[i]] for i, r in enumerate(union(len(keys), pairs)) if i == r}


@pytest.mark.parametrize("which", ["odd", "near"])
def test_line_dedup(spark, which):
    many = near_lines(160)
    rows = odd_rows()[:10] + odd_rows()[12:] if which == "odd" else [(i, "\n".join(many[4 * i:4 * i + 4]) + "\n\n") for i in range(40)]
    got = lines.dedup_lines(frame(spark, rows)).collect()
    kept = line_oracle(rows)
    want = Counter()
    for d, t in rows:
        full = [i for i, _ in lines.lines_of(t)]
        stay = [i for i in full if (d, t, i) in kept]
        want[d, None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in full or i in stay), len(full), len(stay)] += 1
    assert Counter((r.doc_id, r.text, r.n_lines_, r.n_kept) for r in got) == want


def test_line_dedup_hot_paths(spark, monkeypatch):
    """Buckets and groups over their bounds take the other way and find the same lines."""
    many = near_lines(200)
    rows = [(i, "\n".join(many[5 * i:5 * i + 5])) for i in range(40)]
    want = {r.doc_id: r.text for r in lines.dedup_lines(frame(spark, rows)).collect()}
    monkeypatch.setattr(lines, "BUCKET_BYTES", 0)
    monkeypatch.setattr(lines, "GROUP", 3)
    assert {r.doc_id: r.text for r in lines.dedup_lines(frame(spark, rows)).collect()} == want


def test_line_dedup_empty(empty):
    assert lines.dedup_lines(empty).collect() == []


def test_linked_is_exact_jaccard():
    many = near_lines(60)
    sets = [{s[i:i + 8] for i in range(len(s) - 7)} for s in many]
    pairs = [(i, j) for i in range(60) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert lines.linked(many).tolist() == union(60, pairs)


def test_components(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)] + [(i, i + 1) for i in range(500, 560)] + [(900, i) for i in range(901, 960)]
    root = union(1000, pairs)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {i: root[i] for p in pairs if p[0] != p[1] for i in p}
    assert components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long"), "a", "b").collect() == []


def fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\x09\x0a\x0b\x0c\x0d":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, folder, odd, empty):
    rows = [r for r in odd_rows() if len(r[1] or "") < 40_000 or r[0] is None]
    extra = [(1000 + i, prose(50 + i % 7, 400) + " end" * (i // 7)) for i in range(40)]
    rows += extra
    prints = [fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    root = union(len(rows), pairs)
    low = defaultdict(list)
    for i, r in enumerate(root):
        low[r].append(rows[i][0])
    want = Counter((rows[i][0], f"{prints[i]:016x}", min((d for d in low[r] if d is not None), default=None)) for i, r in enumerate(root))
    assert Counter(map(tuple, simhash.op5_simhash_near_dedup(spark, folder(documents=frame(spark, rows))).collect())) == want
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.near_duplicates(odd).count() == len(odd_rows())


def test_simhash_many_shards(spark, monkeypatch):
    """Routing over shards and blocks loses no link."""
    monkeypatch.setattr(simhash, "PER_LEAF", 40)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    flips = [f ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for f in base for a, b in rng.integers(0, 63, (3, 2))]
    f = np.unique(np.concatenate([base, np.asarray(flips, np.uint64)]))
    pairs = [(i, int(j)) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f[:i] ^ f[i]) <= 2)]
    root = union(len(f), pairs)
    distinct = spark.createDataFrame([(int(x),) for x in f.view(np.int64)], "f long").repartition(4)
    got = {r.node: r.root for r in components(simhash.links(distinct), "a", "b").collect()}
    groups = defaultdict(set)
    for i, r in enumerate(root):
        groups[r].add(int(f.view(np.int64)[i]))
    assert sorted(map(sorted, (g for g in groups.values() if len(g) > 1))) == sorted(sorted(k for k, v in got.items() if v == r) for r in set(got.values()))


def test_hamming_forest_dense():
    rng = np.random.default_rng(9)
    f = np.unique(np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64)))
    pairs = [(i, int(j)) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f[:i] ^ f[i]) <= 2)]
    assert hamming_forest(f, np.zeros(0, np.uint64), 2, leaf=16).roots().tolist() == union(len(f), pairs)


def test_router_bounds():
    rng = np.random.default_rng(10)
    x = rng.normal(size=(800, 5))
    router = Router(x[:200], 16, euclid)
    home = router.home(x)
    assert 2 <= router.leaves == len(set(home.tolist())) or router.leaves >= len(set(home.tolist()))
    rows, leaf = router.visits(x[:50], np.full(50, 0.7))
    seen = set(zip(rows.tolist(), leaf.tolist(), strict=True))
    for i in range(50):
        for j in np.flatnonzero(euclid(x, x[i]) <= 0.7):
            assert (i, home[j]) in seen
    same = Router(np.zeros((100, 3)), 8, euclid)
    assert same.leaves == 1 and set(same.home(np.zeros((5, 3))).tolist()) == {0}
    bits = Router(np.arange(64, dtype=np.uint64), 8, hamming, gap=1)
    assert set(bits.home(np.arange(64, dtype=np.uint64)).tolist()) <= set(range(bits.leaves))


def test_tree_is_exact_at_one():
    rng = np.random.default_rng(11)
    x = rng.integers(0, 4, (600, 4)).astype(float)
    ids = rng.permutation(600)
    q = rng.integers(0, 4, (40, 4)).astype(float)
    d, i = Tree(x, ids, leaf=8).nearest(q, 7)
    for k in range(40):
        e = euclid(x, q[k])
        order = np.lexsort((ids, e))[:7]
        assert i[k].tolist() == order.tolist() and np.array_equal(d[k], e[order])
    d, i = Tree(x[:3], ids[:3]).nearest(q[:1], 7)
    assert (i[0] >= 0).sum() == 3 and np.isinf(d[0, 3:]).all()


def vectors():
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] + rng.normal(size=8) * 0.3]) for i in range(900)]
    rows += [(1000 + i, rows[5][1]) for i in range(300)]                          # a hot vector, queries among its copies
    rows += [(2000, None), (2100, [0.0] * 8), (2200, [float("nan")] * 8), (2300, [None] + [1.0] * 7), (2400, []), (2500, [float("inf")] + [1.0] * 7),
             (None, [1.0] * 8), (2600, [1.0] * 3), (2700, [2.0] * 3), (100, rows[100][1]), (2800, [5.0] * 2), (2900, [-0.0] + [1.0] * 7), (2901, [0.0] + [1.0] * 7)]
    return rows


@pytest.mark.parametrize("relax,least", [(1.0, 1.0), (neighbours.RELAX, 0.9)])
def test_neighbours(spark, monkeypatch, relax, least):
    monkeypatch.setattr(neighbours, "PER_LEAF", 100)
    monkeypatch.setattr(neighbours, "BLOCK", 60)
    monkeypatch.setattr(neighbours, "CHUNK", 3)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit("clash")).withColumn("q", F.lit(1)).repartition(4)
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0, relax=relax).collect():
        got[r.query_id].append(r)
    good = {d: np.asarray(v, np.float32).astype(float) for d, v in rows if d is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    hit = total = 0
    for q in (d for d in good if d % 100 == 0):
        near = sorted((float(np.sqrt(((good[q] - v) ** 2).sum())), d) for d, v in good.items() if d != q and len(v) == len(good[q]))[:10]
        mine = sorted(got.pop(q, []), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(near) + 1))
        assert all(abs(r.score - np.sqrt(((good[q] - good[r.vec_id]) ** 2).sum())) < 1e-12 for r in mine)
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        hit += len({d for _, d in near} & {r.vec_id for r in mine})
        total += len(near)
    assert not got and hit >= least * total


@pytest.mark.parametrize("kind", ["float", "double"])
def test_one_id_on_two_vectors(spark, kind):
    """Each row is a query and a candidate of its own; scores are those of the vectors as they are held."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=5)) for i in range(150)] + [(0, rng.normal(size=5)), (100, rng.normal(size=5)), (7, rng.normal(size=5))]
    rows.append(rows[0])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], f"vec_id long, embedding array<{kind}>").repartition(3)
    held = [(i, np.asarray(v, np.float32 if kind == "float" else np.float64).astype(float)) for i, v in rows[:-1]]
    want = Counter()
    for at, (q, v) in enumerate(held):
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), d) for i, (d, w) in enumerate(held) if i != at)[:10]
            want.update((q, n + 1, d, round(x, 11)) for n, (x, d) in enumerate(near))
    got = neighbours.nearest(df, F.col("vec_id") % 100 == 0, relax=1.0).collect()
    assert Counter((r.query_id, r["rank"], r.vec_id, round(r.score, 11)) for r in got) == want and len(got) == 40


def test_neighbours_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(none, F.col("vec_id") % 100 == 0).collect() == []


def test_digests(spark, odd, empty):
    got = Counter((r.doc_id, r.fingerprint) for r in quartiles.digests(odd).collect())
    assert got == Counter((d, quartiles.digest(t)) for d, t in odd_rows())
    assert quartiles.digests(empty).collect() == []
    long = prose(1, 90_000).encode()
    plain = np.zeros(quartiles.BUCKETS, np.int64)
    for s in range(0, len(long), 1000):                      # overlapping pieces count every triplet once
        plain += quartiles.counts(long[max(0, s - 4):s + 1000]) - (quartiles.counts(long[s - 4:s]) if s else 0)
    assert (quartiles.counts(long) == plain).all()
    a = quartiles.digest(prose(1, 400))
    assert quartiles.likeness(a, a) == 1 and 0 <= quartiles.likeness(a, quartiles.digest("")) < 1
    assert quartiles.likeness(a, quartiles.digest(prose(1, 400) + " more")) > quartiles.likeness(a, quartiles.digest("# $$$ *** %%% " * 40))


@pytest.mark.parametrize("parts", [1, 5])
def test_edited_query(spark, folder, odd, empty, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = quartiles.op6_quartile_fingerprints(spark, folder(documents=odd)).collect()
        assert quartiles.op6_quartile_fingerprints(spark, folder(documents=empty)).collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)

    def signed(t):
        h = xxhash.xxh64_intdigest(t.encode(), 42) if t is not None else 42
        return h - (1 << 64) if h >> 63 else h
    rows = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0], signed(r[1])))
    want = Counter()
    for (d, t), (_, n) in zip(rows, rows[1:] + rows[:1], strict=True):
        t, n = t or "", n or ""
        k = len(t) // 4
        e = t[:len(t) - k] + n[:k]
        f, g, h = map(quartiles.digest, (t, e, n))
        want[d, len(t), hashlib.sha256(e.encode()).hexdigest(), f, g, quartiles.likeness(f, g), quartiles.likeness(f, h)] += 1
    assert Counter(map(tuple, got)) == want


def test_edited_deals_hot_ids(spark):
    rows = [(None if i % 4 else i, f"text {i} " + "word " * (i % 7)) for i in range(2000)] + [(None, "copy")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    dealt = quartiles.with_next(docs)
    size = [r["n"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert max(size) < 900 and dealt.where("look = 1").count() == dealt.select("range").distinct().count()
    assert dealt.where("look = 0").count() == len(rows)
    got = quartiles.compare_edited(docs).collect()
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((d, len(t)) for d, t in rows)
    cuts = quartiles.cuts_of([5, 5, 5, 9])
    keys, hashes = np.asarray([4, 5, 5, 5, 7, 9]), np.asarray([0, -2 ** 63, 0, 2 ** 63 - 1, 0, -1])
    assert quartiles.place(cuts, keys, hashes).tolist() == [sum(c <= x for c in cuts) for x in zip(keys.tolist(), hashes.tolist(), strict=True)]


def test_pipeline_dedup_stages_by_brute_force(spark):
    """The two dedup stages of the pipeline on repeated rows, null ids and one id on two texts, without their operators."""
    def signed(t):
        h = xxhash.xxh64_intdigest(t.encode(), 42)
        return h - (1 << 64) if h >> 63 else h
    many = near_lines(80)
    text = ["\n".join(many[4 * i:4 * i + 4]) for i in range(20)]
    long = [" ".join(f"w{100 * i + j}" for j in range(90)) for i in range(4)]                # no line is near another
    rows = [(i, t) for i, t in enumerate(text)] + [(3, text[3])] * 3 + [(None, text[5])] * 2 + [(8, text[9]), (30, " \n")]
    rows += [(None, long[0])] * 3 + [(40, long[1])] * 4 + [(41, long[2]), (41, long[3]), (41, long[3])]
    kept, left = line_oracle(rows), []
    for d, t in rows:
        full = [i for i, _ in lines.lines_of(t)]
        stay = [i for i in full if (d, t, i) in kept]
        if stay or not full:
            left.append((d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in full or i in stay)))
    now = corpus_pipeline.materialize(corpus_pipeline.line_dedup(spark, frame(spark, rows).repartition(3), ""), "lines")
    assert Counter((r.doc_id, r.text) for r in now.collect()) == Counter(left)
    prints = [fingerprint(t) for _, t in left]
    root = union(len(left), [(i, j) for i in range(len(left)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    first = {}
    for (d, t), r in zip(left, root, strict=True):
        first[r] = min(first.get(r, (2,)), (d is None, d or 0, signed(t), d, t), key=lambda x: x[:3])
    got = corpus_pipeline.simhash_near_dedup(spark, now, "").collect()
    assert len(got) < len(left) and Counter((r.doc_id, r.text) for r in got) == Counter(x[3:] for x in first.values())


def test_pairs_of_lines_link_as_groups_do():
    rng = random.Random(9)
    base = [prose(i, 3 + i % 20).replace("\n", " ") for i in range(120)] + ["ab", "ab ", "x", "aaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaa", "日本語のテキスト"]
    flat = []
    for x in base:
        y = list(x)
        for _ in range(rng.randint(0, 3)):
            y[rng.randrange(len(y))] = rng.choice("abc xyz")
        flat += [x, "".join(y)]
    for i in range(0, len(flat), 7):
        flat += [flat[i], rng.choice(flat)]
    got = lines.linked_pairs(flat).tolist()
    want = [int(lines.linked(flat[i:i + 2])[1]) == 0 for i in range(0, len(flat), 2)]
    assert got == want and 0 < sum(want) < len(want)
