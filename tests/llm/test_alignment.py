"""Operator 12 against both libraries on whole texts and plain counts."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from parcela.llm import alignment
from parcela.llm.subword import BYTE_BPE, byte_alphabet, tokenizer_path
from parcela.llm.token_counts import PIECE_BPE

from conftest import frame, odd_rows  # noqa: I001


def bag(rows):
    return Counter(map(tuple, rows))


@pytest.fixture(scope="module")
def plain():
    """ids and bytes of both tokenisations of a text, or None."""
    full = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    full.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_BPE))
    back = {c: b for b, c in byte_alphabet().items()}

    def piece(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    def cut(text):
        if not text:
            return None
        e, ids = full.encode(" " + text, add_special_tokens=False), sp.encode(text)
        a = [bytes(back[c] for c in t) for t in e.tokens]
        b = [piece(i) for i in ids]
        whole = (" " + text).encode()
        return (e.ids, a, ids, b) if b"".join(a) == whole and b"".join(b) == whole else None

    return cut


def plain_groups(a_ids, a, b_ids, b):
    spans = lambda parts: [(sum(map(len, parts[:i])), sum(map(len, parts[:i + 1]))) for i in range(len(parts))]
    ca, cb = spans(a), spans(b)
    links = [(x, y) for x, (s, e) in zip(a_ids, ca) for y, (t, f) in zip(b_ids, cb) if s < f and t < e]
    groups, at = [], 0
    for end in sorted({e for _, e in ca} & {e for _, e in cb}):
        inside = lambda ids, c: ",".join(str(i) for i, (s, e) in zip(ids, c) if at <= s and e <= end)  # noqa: B023, E731
        groups.append(f"{inside(a_ids, ca)}|{inside(b_ids, cb)}")
        at = end
    return groups, links


def plain_rows(rows, cut):
    made, count = [], Counter()
    for _, text in rows:
        tokens = cut(text)
        made.append((tokens, *plain_groups(*tokens)) if tokens else None)
        if tokens:
            count.update(set(made[-1][2]))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for (doc, _), x in zip(rows, made):
        if x is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
        else:
            (a_ids, _, b_ids, _), groups, links = x
            out.append((doc, len(a_ids), len(b_ids), len(groups), len(links), sum(count[k] == top[k[0]] for k in links),
                        sum(count[k] for k in links), ";".join(groups)))
    return out


def small_rows():
    """The odd rows, the long ones cut: the plain version is quadratic."""
    rng = random.Random(6)
    rows = [(d, t[:1500] if t else t) for d, t in odd_rows()]
    rows += [(100 + i, "".join(rng.choice(["the ", "token", "izer", " ", "\n", "\t", "é", "中", "👍", "<s>", "<0x41>", "’s", "'ll", "12", " ", "\x1c", "\xa0", ". "])
                               for _ in range(rng.randint(1, 25)))) for i in range(150)]
    return rows + rows[-9:] + [(7, "same text")] * 5


@pytest.mark.parametrize("size", [0, 300, 1_000_000])
def test_alignment_brute_force(spark, plain, size):
    """The size of the broadcast table has no effect: pairs that it lacks are joined."""
    rows = small_rows()
    got = alignment.cross_align(frame(spark, rows).repartition(3), table_size=size)
    assert bag(got.collect()) == bag(plain_rows(rows, plain))


def test_alignment_query(spark, plain, folder, empty):
    rows = small_rows()
    got = alignment.op12_cross_alignment(spark, folder(documents=frame(spark, rows)))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in plain_rows(rows, plain)]
    assert bag(got.collect()) == bag(want)
    assert alignment.cross_align(empty).collect() == []
    none = alignment.cross_align(frame(spark, [(1, None), (2, ""), (3, "▁"), (None, "")])).collect()
    assert bag(none) == bag([(d, 0, 0, 0, 0, 0, 0, "") for d in (1, 2, 3, None)])


def test_chunks_add_up(plain):
    """Chunk by chunk, ids are the libraries' on whole texts, and the cache may start anew at any time."""
    rng, own = random.Random(7), alignment.Aligner(tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE))
    texts = ["".join(rng.choice("ab  \n\t.'s<é中👍\x00\x1c\x85\xa0　▁9") for _ in range(rng.randint(1, 14))) for _ in range(3000)] + [" ", "  ", "a ", " a"]
    held, *ids = own.ids(texts)
    assert held == [i for i, t in enumerate(texts) if plain(t)]
    out = own.align(*ids)
    for k, i in enumerate(held):
        groups, links = plain_groups(*plain(texts[i]))
        assert out["groups"][k].as_py() == ";".join(groups) and out["n_links"][k] == len(links), repr(texts[i])
        assert dict(zip(out["pairs"][k].as_py(), out["times"][k].as_py(), strict=True)) == Counter(alignment.pair_of(*x) for x in links)
