import random

import pytest
from pyspark.sql import types as T

# Names that the operators use inside, as further columns of the input.
CLASHES = ["h", "f", "g", "key", "part", "score", "lang_pred", "rejected", "predicted", "n_lines", "k_lines", "n_tokens", "first", "root", "u", "v"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       *(T.StructField(c, T.StringType()) for c in CLASHES)])
WORDS = "the quick brown fox jumps over a lazy dog while seven wizards brew potions near an old mill by the river".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = [rng.choice(WORDS) + rng.choice(["", "", "", "s", "ed", ",", "."]) for _ in range(n)]
    return "".join(w + ("\n" if i % 23 == 22 else " ") for i, w in enumerate(words)).strip()


def odd_rows() -> list[tuple]:
    """Nulls, empty and long texts, ties, repeated rows, near copies, signs of many planes and special strings."""
    long = prose(1, 30_000)
    texts = [None, "", " ", "\n\n", "a", "ab", "one two", prose(2, 300), prose(2, 300), prose(2, 300) + " tail", long, "x" * 50_000,
             "no\nline\nis\ntwice\nno", "日本語のテキスト。\nもう一行", "emoji 👍🏽 𝒜𝓑 ok", "a<|endoftext|>b<|startoftext|> c", "tabs\tand\x0bfeeds\x0c\x1c\x85\xa0 end",
             "İstanbul ΣΑΣ ﬁ don't WE'LL 12 ½²", "  two  spaces ▁ and ▁▁ marks ", "\x00nul\x00", prose(3, 500), "# $$$ *** %%% " * 40]
    rows = [(i * 3 % 70, t) for i, t in enumerate(texts)]
    rows += [(None, prose(4, 50)), (None, None), rows[7], rows[7], (rows[8][0], prose(5, 80))]
    return rows


def frame(spark, rows, langs=("en", "de")):
    full = [(d, t, langs[i % len(langs)], f"src{i % 3}", len(t or ""), *(c for c in CLASHES)) for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, odd_rows()).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def folder(tmp_path_factory):
    """Writes tables into a folder of its own, as the queries read them."""
    def write(**tables):
        root = tmp_path_factory.mktemp("tables")
        for name, df in tables.items():
            df.write.parquet(f"{root}/{name}.parquet")
        return str(root)
    return write
