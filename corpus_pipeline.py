"""A corpus from documents to packed sequences: every stage is one operator of parcela.llm over all its predecessor kept.

language ID   learns from the folds of sf_dir's documents that the operator may learn from; rejected documents go
quality       learns from sf_dir's labels likewise; documents predicted 0 go
line dedup    a line stays once in the corpus; documents that lose all their lines go; n_chars counts the text that stays
near dedup    one row of each SimHash component stays: the smallest doc_id, rows without one last; of rows that repeat it the
              smallest hash of the text, then any one
packing       pieces of the documents that are left, in sequences

Every stage's result is written as Parquet into the shared folder and read back. Null and empty texts go at the first stage; an
empty table runs through all stages; the columns of the documents, whatever they are, pass through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.llm import language, lines, packing, quality, simhash
from parcela.llm.common import fresh, materialize, quoted, read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.train(read_table(spark, sf_dir, "documents"), language.learnable())
    names = fresh(docs.columns, "lang_pred", "lang_score", "lang_rejected")
    return language.identify(docs, model, docs.columns, tuple(names)).where(~F.col(names[2])).select(*map(quoted, docs.columns))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = quality.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), quality.learnable())
    names = fresh(docs.columns, "quality_score", "quality_predicted")
    return quality.scored(docs, net, docs.columns, tuple(names)).where(F.col(names[1]) == 1).select(*map(quoted, docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(docs)
    n_lines, n_kept = out.columns[-2:]
    out = out.where((F.col(n_lines) == 0) | (F.col(n_kept) > 0))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*map(quoted, docs.columns))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("quality_classifier", quality_classifier), ("line_dedup", line_dedup),
          ("simhash_near_dedup", simhash_near_dedup), ("packing", pack)]

# Fitted models, tokenizers and signatures are beyond SQL: tests/llm compares the line-dedup and near-dedup stages with brute-force
# versions, the fitted stages with held-out labels and packing with its pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
