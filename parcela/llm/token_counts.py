"""Operator 2, token counts: a map-side lookup in two tiers, without any shuffle of pre-tokens.

A sentencepiece BPE model whose pieces hold a space only as a prefix never merges across the border between a non-space
and a space. A text is then the sum of its pre-tokens, each a run of spaces with the non-spaces behind it
(``check_model`` verifies this on the vocabulary). Tier one is a broadcast table of the corpus' frequent pre-tokens and their
token numbers (``frequent.frequent_items``, bounded by ``table_size``); tier two encodes a miss with the library and
keeps its length in the worker's bounded cache. The job has no exchange but that of the bounded summaries.

Defined results: null and empty texts have 0 tokens and 0 bytes; rows repeated or with a null doc_id are kept one by
one; further columns of the input are ignored; an empty table gives an empty result. A single pre-token without spaces
may be as long as the text: the library encodes it as one.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import map_batches, prepare, read_table, texts_of
from .frequent import frequent_items
from .subword import LONG_WORD, tokenizer_path

PIECE_BPE = "piece_bpe_32k.model"
TABLE_SIZE = 50_000        # pre-tokens in the broadcast table, each of at most frequent.MAX_ITEM characters
CACHE_SIZE = 300_000       # lengths a worker keeps beside it
LIMIT = 4096
SPACE = "▁"           # how the model spells a space; in a text it counts as one
_RUNS = re.compile(" *[^ ]+| +").findall


def check_model(sp) -> None:
    """Raise unless texts are the sum of their pre-tokens for this model."""
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
        raise ValueError("a piece crosses the border between a word and a space")
    if sp.encode("a  b ", out_type=str)[0][0] != SPACE or "".join(sp.encode("a  b ", out_type=str)) != f"{SPACE}a{SPACE * 2}b{SPACE}":
        raise ValueError("the model's normalizer changes spaces")


@functools.lru_cache(2)
def worker_model(path: str):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    check_model(sp)
    return sp


def pretokens(text: str) -> list[str]:
    """Pre-tokens as the text of which the model's own leading space has been taken away."""
    if not text:
        return []
    text = text.replace(SPACE, " ")
    if "  " not in text and text[0] != " ":                   # the model's leading space would join a first one
        return text.split(" ")
    return [w[1:] for w in _RUNS(" " + text)]


def piece_counts(sp, words: list[str]) -> list[int]:
    """Tokens of each pre-token; an empty one is a lone space, itself one piece."""
    lone = sp.piece_to_id(SPACE)
    one = 1 if lone != sp.unk_id() else len(sp.encode(" ")) - 1
    return [len(ids) if w else one for w, ids in zip(words, sp.encode(words, num_threads=1), strict=True)]


def token_counts(docs: DataFrame, model: str | None = None, limit: int = LIMIT, table_size: int = TABLE_SIZE) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` (doc_id, text)."""
    spark = prepare(docs.sparkSession)
    path = model or tokenizer_path(PIECE_BPE)
    docs = docs.select("doc_id", "text")
    words = frequent_items(docs, lambda texts: chain.from_iterable(map(pretokens, texts)), table_size)
    lengths = np.asarray(piece_counts(worker_model(path), words), np.uint16) if words else np.zeros(0, np.uint16)
    # joined by a byte that UTF-8 never has
    table = spark.sparkContext.broadcast((b"\xff".join(w.encode("utf-8") for w in words), lengths))

    def count(batches: Iterable[pa.RecordBatch]):
        blob, known = table.value
        tier1 = {w.decode("utf-8"): n for w, n in zip(blob.split(b"\xff") if len(known) else (), known.tolist(), strict=True)}
        tier2: dict[str, int] = {}
        sp = worker_model(path)
        for b in batches:
            texts = texts_of(b)
            cut = [pretokens(t) for t in texts]
            wanted = set().union(*cut)
            wanted.difference_update(tier1)
            missing = list(wanted.difference(tier2))
            if len(tier2) + len(missing) > CACHE_SIZE:
                tier2.clear()
                missing = list(wanted)
            tier2.update(zip(missing, piece_counts(sp, missing), strict=True))
            both = tier1 | {w: tier2[w] for w in wanted}
            n = [sum(map(both.__getitem__, ws)) for ws in cut]
            for w in missing:
                if len(w) > LONG_WORD:                       # long pre-tokens are not kept
                    del tier2[w]
            yield {"doc_id": b.column("doc_id"), "n_bytes": [len(t.encode("utf-8")) for t in texts],
                   "n_tokens": n, "over_limit": [x > limit for x in n]}

    return map_batches(docs, count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))
