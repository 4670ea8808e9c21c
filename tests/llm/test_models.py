"""Operators 8 and 9 by held-out accuracy and properties of the models, and the pipeline against its parts."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parcela.llm import language, lines, packing, quality, simhash

from conftest import CLASHES, frame, odd_rows, prose  # noqa: I001

SMALL = "/root/testdata/sf0.01"


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def test_language_held_out(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = language.op8_language_kneser_ney(spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(truth)
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


def test_kneser_ney_sums_to_one():
    text = language.folded(prose(1, 3000))
    counts = {"x": np.unique(np.lib.stride_tricks.sliding_window_view(text, 4), axis=0, return_counts=True),
              "y": np.unique(np.lib.stride_tricks.sliding_window_view(text[::-1].copy(), 4), axis=0, return_counts=True)}
    alphabet = len(set(text.tolist())) + 1
    m = language.Model.fit(counts, alphabet)
    signs = np.unique(text)
    for context in ([32, 116, 104], [113, 113, 113], [120, 122, 32]):
        every = np.concatenate([np.tile(np.asarray(context, np.uint32), (len(signs), 1)), signs[:, None]], 1)
        total = np.exp(language._logp(m.keys, m.logp, m.back, m.floor, every, 4)).sum(0)
        unseen = np.exp(language._logp(m.keys, m.logp, m.back, m.floor, np.asarray([[*context, 9999]], np.uint32), 4))[0]
        assert np.allclose(total + unseen, 1, atol=1e-3)
    one, two = m.entropy([text]), m.entropy([text[:50], text, text[:5]])
    assert np.allclose(one[0], two[1]) and one[0, 0] < one[0, 1]


def test_kneser_ney_equals_plain_recursion():
    """Dictionaries of strings and the textbook recursion, against the sorted hash arrays."""
    texts = {"en": [prose(s, 60) for s in range(4)], "xx": ["zazu kolo mizu " * 5, "äöü kolo zazu"]}
    text = {lang: [language.folded(t) for t in ts] for lang, ts in texts.items()}
    counts, plain = {}, {}
    for lang, ts in text.items():
        top = Counter(tuple(t[i:i + language.ORDER].tolist()) for t in ts for i in range(len(t) - language.ORDER + 1))
        counts[lang] = (np.asarray(list(top), np.uint32), np.asarray(list(top.values())))
        tables = {language.ORDER: top}
        for k in range(language.ORDER - 1, 0, -1):
            tables[k] = Counter(g[1:] for g in tables[k + 1])
        plain[lang] = tables
    alphabet = len({c for t in plain.values() for g in t[language.ORDER] for c in g}) + 1
    model = language.Model.fit(counts, alphabet)

    def prob(tables, gram):
        if not gram:
            return 1 / alphabet
        table = tables[len(gram)]
        ones, twos = (sum(v == n for v in table.values()) for n in (1, 2))
        d = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones + twos else 0.5
        after = [v for g, v in table.items() if g[:-1] == gram[:-1]]
        low = prob(tables, gram[1:])
        return (max(0, table[gram] - d) + d * len(after) * low) / sum(after) if after else low

    asked = [language.folded(t) for t in ("the fox zazu", "kolo qqq ö", prose(9, 12))]
    got = model.entropy(asked)
    for i, t in enumerate(asked):
        grams = [tuple(t[k:k + language.ORDER].tolist()) for k in range(len(t) - language.ORDER + 1)]
        for j, lang in enumerate(model.langs):
            assert abs(got[i, j] + np.mean([np.log(prob(plain[lang], g)) for g in grams])) < 1e-4, (i, lang)


def test_rejection_rates(spark):
    """Lettered gibberish and languages that were not learned go, real texts stay; README gives the rates."""
    rng = np.random.default_rng(6)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.train(docs, language.learnable())
    real = [r.text for r in docs.where("text is not null").collect() if any(c.isalpha() for c in r.text)]
    noise = ["".join(rng.choice(list("qxzjvkwpfyg hbd"), 400)) for _ in range(100)]
    other = ["Съешь же ещё этих мягких французских булок да выпей чаю " * 4, "日本語の文章はこのように書かれています。" * 5, "Το γρήγορο καφέ αλεπού πηδά πάνω από " * 4]
    rate = [float(np.mean(model.predict(t)[2])) for t in (real, noise, other)]
    print("rejected: real, gibberish, not learned", rate)
    assert rate[0] < 0.002 and rate[1] > 0.95 and rate[2] == 1


def test_language_odd(spark, odd, empty):
    model = language.train(odd, language.learnable())
    got = language.identify(odd, model, odd.columns, ("p", "s", "r")).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(odd_rows())
    for r in got:
        bare = not any(c.isalpha() for c in r.text or "")
        assert (r.p == "und") == bare and (not bare or r.r and r.s == 0) and r.lang_pred == "lang_pred"
    none = language.train(empty, language.learnable())
    assert language.identify(empty, none).collect() == []
    assert {(r.lang_pred, r.score) for r in language.identify(odd, none).collect()} == {("und", 0.0)}


def test_quality_held_out(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    got = quality.op9_quality_byte_cnn(spark, SMALL).collect()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert len(held) > 40 and np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.9


def test_network_gradients():
    rng = np.random.default_rng(13)
    net = quality.Network(rng)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    chunks = rng.integers(0, 256, (5, quality.CHUNK)).astype(np.uint8)
    starts, y = np.asarray([0, 2]), np.asarray([1.0, 0.0])

    def loss():
        p = np.concatenate([net.pooled(chunks)])
        z = net.head(np.add.reduceat(p, starts) / np.asarray([[2], [3]]), np.maximum.reduceat(p, starts))[2]
        return float(np.mean(np.log1p(np.exp(z)) - y * z))
    g = net.gradients(chunks, starts, y)
    for k, w in net.w.items():
        at = np.unravel_index(np.abs(g[k]).argmax(), w.shape)
        old, eps = w[at], 1e-5
        w[at] = old + eps
        up = loss()
        w[at] = old - eps
        down = loss()
        w[at] = old
        assert abs((up - down) / (2 * eps) - g[k][at]) < 1e-4 + 0.02 * abs(g[k][at]), k


def test_chunks_cover_the_text():
    for n in (0, 1, 32, 33, 255, 256, 257, 5000):
        text = "".join(chr(97 + i % 26) for i in range(n))
        c = quality.chunks_of(text)
        step = quality.CHUNK - quality.OVERLAP
        whole = b"".join([c[0].tobytes(), *(x[quality.OVERLAP:].tobytes() for x in c[1:])])
        assert whole.rstrip(b"\0").decode() == text and len(c) <= max(1, -(-n // step) + 1)


def test_network_equals_plain_loops():
    """One byte, window and filter at a time, over every chunk of the text up to its last byte."""
    rng = np.random.default_rng(4)
    net = quality.Network(rng)
    w, shift = {k: v.astype(float) for k, v in net.w.items()}, 0.3
    net.shift = shift
    assert (quality.CHUNK - quality.WIDTH) % quality.STEP == 0

    def plain(text):
        raw, step = list((text or "").encode()), quality.CHUNK - quality.OVERLAP
        pooled = []
        for s in [0, *range(step, max(0, len(raw) - quality.OVERLAP), step)]:
            chunk = raw[s:s + quality.CHUNK]
            chunk += [0] * (quality.CHUNK - len(chunk))
            rows = []
            for i, byte in enumerate(chunk):
                four = chunk[i - 3:i + 1] if i >= 3 else None
                seen = four is not None and any(four) and any(chunk[i - lag - 3:i - lag + 1] == four for lag in range(2, min(quality.LAGS, i - 3) + 1))
                rows.append([*w["embed"][byte], float(seen)])
            best = [-np.inf] * quality.FILTERS
            for at in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STEP):
                for f in range(quality.FILTERS):
                    v = sum(rows[at + k][c] * w["filters"][c * quality.WIDTH + k, f] for c in range(quality.EMBED + 1) for k in range(quality.WIDTH))
                    best[f] = max(best[f], v)
            pooled.append([max(0.0, b + c) for b, c in zip(best, w["bias"], strict=True)])
        x = [sum(col) / len(pooled) for col in zip(*pooled, strict=True)] + [max(col) for col in zip(*pooled, strict=True)]
        h = [np.tanh(sum(a * b for a, b in zip(x, w["hidden"][:, j], strict=True)) + w["hidden_bias"][j]) for j in range(quality.HIDDEN)]
        return 1 / (1 + np.exp(-(sum(a * b for a, b in zip(h, w["out"], strict=True)) + w["out_bias"][0] + shift)))

    texts = [None, "abcabcabcabc", "é" * 129, prose(3, 60), "x" * 256 + "\x01", "日本" * 100]
    assert np.allclose(net.score(texts), [plain(t) for t in texts], atol=1e-5)


def test_scores_do_not_depend_on_the_batch(spark):
    net = quality.Network(np.random.default_rng(1))
    texts = [t for _, t in odd_rows()]
    assert np.allclose(net.score(texts), [net.score([t])[0] for t in texts], atol=1e-5)


def test_quality_odd(spark, odd, empty):
    labels = spark.createDataFrame([(d, i % 2, None) for i, (d, _) in enumerate(odd_rows())] + [(None, 1, 1), (5, None, 0)], "doc_id long, quality int, toxic int")
    net = quality.train(odd, labels, quality.learnable())
    got = quality.scored(odd, net, odd.columns, ("p", "q")).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(odd_rows()) and all(r.score == "score" for r in got)
    none = quality.train(odd, labels.limit(0), quality.learnable())
    assert {r.score for r in quality.scored(odd, none).collect()} == {0.5}
    assert quality.scored(empty, net).collect() == []


@pytest.fixture(scope="module")
def corpus(spark, folder):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("h", F.lit(1)).withColumn("lang_pred", F.lit("x"))
    extra = [(5000 + i, t, "en", "s", 0, 1, "x") for i, t in enumerate([None, "", "12 34 ..", "\n"])]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    return folder(documents=docs, labels=spark.read.parquet(f"{SMALL}/labels.parquet")), docs


def test_pipeline_stages(spark, corpus):
    root, docs = corpus
    read, now = {}, spark.read.parquet(f"{root}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        read[name] = now
        now = corpus_pipeline.materialize(stage(spark, now, root), name)
        if name != "packing":
            assert now.columns == docs.columns and now.dtypes == docs.dtypes
    read["out"] = now
    ids = {k: {r.doc_id for r in v.select("doc_id").collect()} for k, v in read.items()}
    assert not {5000, 5001, 5002, 5003} & ids["quality_classifier"]                    # rejected by the language stage
    assert len(ids["quality_classifier"]) > 0.99 * len(ids["language_id"]) - 4
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    clean = [d for d, q in labels.items() if q == 1 and d in ids["quality_classifier"]]
    junk = [d for d, q in labels.items() if q == 0 and d in ids["quality_classifier"]]
    assert np.mean([d in ids["line_dedup"] for d in clean]) > 0.97 and np.mean([d in ids["line_dedup"] for d in junk]) < 0.2
    want = {r.doc_id: r.text for r in lines.dedup_lines(read["line_dedup"]).collect() if r.n_kept}
    assert {r.doc_id: r.text for r in read["simhash_near_dedup"].collect()} == want
    seen = {s for r in read["simhash_near_dedup"].collect() for s in [x for _, x in lines.lines_of(r.text)]}
    assert len(seen) == sum(len(lines.lines_of(t)) for t in want.values())             # no line twice
    keep = {r.component_id for r in simhash.near_duplicates(read["simhash_near_dedup"]).collect()}
    assert ids["packing"] == keep
    assert Counter(map(tuple, now.drop("sequence_id", "offset").collect())) == Counter(map(tuple, packing.pieces(read["packing"]).collect()))


def test_pipeline_run_and_empty(spark, folder, corpus):
    assert corpus_pipeline.run(spark, corpus[0]).count() > 500
    none = folder(documents=frame(spark, []), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert corpus_pipeline.run(spark, none).collect() == []
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_classifier", "line_dedup", "simhash_near_dedup", "packing"]
    assert set(CLASHES)


def test_near_dedup_keeps_one_row_of_a_group(spark):
    """Rows that repeat doc_id and text, copies without doc_id, and one doc_id on two texts: one row of each group stays."""
    a, b, c, d, e = (prose(60 + i, 80) for i in range(5))
    rows = [(1, a), (1, a), (1, a), (2, a), (None, a),                     # repeated rows, a copy with and one without an id
            (None, b), (None, b), (None, b),                               # copies without ids only
            (3, c), (7, c), (7, d), (7, d),                                # doc 7 is a copy of doc 3 and has a text of its own
            (9, e)]
    got = corpus_pipeline.simhash_near_dedup(spark, frame(spark, rows).repartition(4), "")
    assert got.columns == frame(spark, []).columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(1, a), (None, b), (3, c), (7, d), (9, e)])
    assert corpus_pipeline.simhash_near_dedup(spark, frame(spark, []), "").collect() == []


def test_language_trains_on_whole_texts(spark):
    """A long labelled text that opens with digits and signs still teaches its class what comes after them."""
    rng = np.random.default_rng(3)
    words = {"en": "river stone meadow willow harbour lantern".split(), "de": "zwölf schön gärten brücke straße mühle".split()}
    rows = [(2 * i + k, "12 34 .. " * 2500 + " ".join(rng.choice(words[lang], 200)), lang) for i in range(40) for k, lang in enumerate(words)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert model.langs == ["de", "en"] and np.isfinite(model.limit)
    assert model.predict(["schön gärten brücke", "meadow willow harbour"])[0] == ["de", "en"]


def test_repeated_rows_stay_bounded(spark, monkeypatch):
    """Rows that repeat fill no packing group, and train the models as one row."""
    packed = packing.pack(frame(spark, [(1, "a b c")] * 4000 + [(None, "d")] * 4000).repartition(4), group=200).collect()
    sizes = Counter(r.sequence_id >> 32 for r in packed)
    assert len(packed) == 8000 and len(sizes) == 40 and max(sizes.values()) < 400

    seen = []
    monkeypatch.setattr(language, "calibrate_model", lambda model, e, langs: seen.append(Counter(langs)) or model)
    monkeypatch.setattr(quality, "fit", lambda samples: seen.append(len(samples)) or quality.Network(np.random.default_rng(1)))
    rows = [(i, prose(700 + i, 30)) for i in range(24)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, quality int")
    for repeat in (1, 30):
        docs = frame(spark, [r for r in rows for _ in range(repeat)], ("en",))
        language.train(docs, F.lit(True))
        quality.train(docs, labels, F.lit(True))
    assert seen == [Counter(en=4), 24] * 2
