"""Operators 2, 3, 7 and 10 against the tokenizers' own libraries on whole texts."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from parcela.llm import lexicon, packing, subword, token_counts, wavelet
from parcela.llm.subword import BYTE_BPE, WORD_BPE, tokenizer_path

from conftest import odd_rows  # noqa: I001


def ids_of(name):
    full = Tokenizer.from_file(tokenizer_path(name))
    return lambda text: full.encode(text or "", add_special_tokens=False).ids


def bag(rows):
    return Counter(map(tuple, rows))


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_subword_equals_library(name):
    rng, lib, own = random.Random(1), ids_of(name), subword.WordIds(tokenizer_path(name))
    texts = ["".join(rng.choice("ab 'sStTZ9²½\n\t\xa0\x85_-!?éÉßſıĲŉ“—€ 　́中Σ\x1c") for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += [t or "" for _, t in odd_rows()]
    for t, ids in zip(texts, own.encode_batch(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == lib(t), t[:80]


def test_token_counts(spark, odd, empty):
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(token_counts.PIECE_BPE))
    want = bag((d, len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for d, t in odd_rows())
    for size in (5, 50_000):                                # the table only saves time
        assert bag(token_counts.token_counts(odd, table_size=size).collect()) == want
    assert token_counts.token_counts(empty).collect() == []


def test_pretokens_add_up():
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(token_counts.PIECE_BPE))
    rng = random.Random(2)
    for _ in range(2000):
        t = "".join(rng.choice("ab ▁ \n\t.<s>é中👍\x00") for _ in range(rng.randint(0, 12)))
        assert sum(token_counts.piece_counts(sp, token_counts.pretokens(t))) == len(sp.encode(t)), repr(t)


def test_lexicon_round_trip(spark, odd, empty):
    full = Tokenizer.from_file(tokenizer_path(WORD_BPE))
    want = []
    for d, t in odd_rows():
        ids = full.encode(t or "", add_special_tokens=False).ids
        want.append((d, tuple(ids), full.decode(ids, skip_special_tokens=False)))
    for size in (3, 10_000):
        got = lexicon.bpe_round_trip(odd, size=size).collect()
        assert bag((r.doc_id, tuple(r.ids), r.decoded) for r in got) == bag(want)
    assert lexicon.bpe_round_trip(empty).collect() == []


def test_transducer(tmp_path):
    rng = random.Random(3)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))).encode(): [rng.randrange(999) for _ in range(rng.randint(0, 3))] for _ in range(300)}
    made = lexicon.Transducer.build(words)
    (tmp_path / "t.bin").write_bytes(made.dump())
    read = lexicon.Transducer.load(str(tmp_path / "t.bin"))
    asked = sorted(words) + [b"", b"zz", b"abcabcabc", "é".encode(), b"a\x00"]
    for w, r in zip(asked, read.ranks(asked).tolist(), strict=True):
        assert (read.ids_of(r).tolist() if r >= 0 else None) == words.get(w), w
    assert len(read.final) < sum(map(len, words))           # shared prefixes and suffixes
    assert lexicon.Transducer.build({}).ranks([b"a", b""]).tolist() == [-1, -1]


def test_lexicon_query(spark, folder, odd):
    full = Tokenizer.from_file(tokenizer_path(WORD_BPE))
    want = []
    for d, t in odd_rows():
        ids = full.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(full.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert bag(lexicon.op10_bpe_lexicon(spark, folder(documents=odd)).collect()) == bag(want)


def test_wavelet_matrix():
    rng = np.random.default_rng(4)
    for n, top in ((0, 1), (1, 1), (1, 50_000), (700, 3), (5000, 49_000)):
        seq = rng.integers(0, top, n)
        m = wavelet.WaveletMatrix.load(memoryview(wavelet.WaveletMatrix.build(seq).dump()))
        assert m.to_array().tolist() == seq.tolist()
        for i in rng.integers(0, max(1, n), 20 if n else 0).tolist():
            s = int(seq[i])
            assert m.access(i) == s and m.rank(s, i) == (seq[:i] == s).sum() and m.count(s) == (seq == s).sum()
            assert m.select(s, m.rank(s, i)) == i
            assert m.positions(s)[:50] == np.flatnonzero(seq == s)[:50].tolist()
        assert m.count(1 << 20) == 0


@pytest.mark.parametrize("shard", [50, 1_000_000])
def test_wavelet_shards(spark, odd, empty, tmp_path, shard):
    wavelet.write_shards(odd, f"{tmp_path}/a", shard_tokens=shard)
    got = wavelet.read_shards(spark, f"{tmp_path}/a").orderBy("start").collect()
    lib, at = ids_of(WORD_BPE), 0
    tokens = defaultdict(list)
    for d, t in odd_rows():
        tokens[d].append(zlib.crc32(np.asarray([*lib(t), 2], "<u4").tobytes()))
    assert [r.doc_id for r in got] == sorted((d for d, _ in odd_rows()), key=lambda d: (d is not None, d))
    for r in got:
        assert r.start == at
        at += r.n_tokens
        tokens[r.doc_id].remove(r.ids_crc32)
    assert not any(tokens.values()) and at == sum(len(lib(t)) + 1 for _, t in odd_rows())
    wavelet.write_shards(empty, f"{tmp_path}/b")
    assert wavelet.read_shards(spark, f"{tmp_path}/b").collect() == []


def test_packing(spark, odd, empty):
    lib = ids_of(BYTE_BPE)
    got = packing.pack(odd).collect()
    want = Counter()
    for d, t in odd_rows():
        ids = np.asarray([*lib(t), 1], "<u4")
        for s in range(0, len(ids), 2048):
            want[d, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes()), len(ids)] += 1
    assert bag(r[:5] for r in got) == want
    used = defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, r.length))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(empty).collect() == []


def test_best_fit_is_tightest():
    rng = random.Random(5)
    sizes = sorted((rng.randint(1, 100) for _ in range(500)), reverse=True)
    tree, left = packing.BestFit(100), []
    for s in sizes:
        fits = [x for x in left if x >= s]
        window, offset = tree.place(s)
        if fits:
            assert 100 - offset == min(fits)
            left.remove(min(fits))
        else:
            assert offset == 0
        left.append(100 - offset - s)
    assert len(tree.used) <= 1.02 * sum(sizes) / 100 + 2


def test_sequences_hold_the_tokens(spark):
    docs = spark.createDataFrame([(i, "word " * (i * 700)) for i in range(6)], "doc_id long, text string")
    packed = packing.pack(docs)
    lib = ids_of(BYTE_BPE)
    tokens = {r.sequence_id: r.tokens for r in packing.sequences(docs, packed).collect()}
    for r in packed.collect():
        assert tokens[r.sequence_id][r.offset:r.offset + r.length] == [*lib("word " * (r.doc_id * 700)), 1][r.start:r.start + r.length]
