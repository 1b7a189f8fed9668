"""Corpus pipeline: documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that :func:`run` writes as
Parquet to the shared folder and rereads as the next stage's documents. All stages but
the last return the columns of ``documents``; each works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import ngram_join, packing_bm25, source_mix, suffix_dedup, toxicity_fm
from touchline.llm.common import read, stage


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` again from the text, where the table has that column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores below one half."""
    model = toxicity_fm.train(docs, read(spark, sf_dir, "labels"))
    return toxicity_fm.keep_clean(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near copies: five words, similarity 0.8."""
    return ngram_join.one_per_group(docs, k=5, threshold=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that a document with a smaller doc_id also holds are cut."""
    return _with_length(suffix_dedup.without_repeats(docs))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, dropped or cut so that sources come to their target weights."""
    return _with_length(source_mix.mixed_documents(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows filled with lexical neighbours, with their ids."""
    return packing_bm25.pack_bm25(docs)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("source_mixing", source_mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: Models, components, suffix arrays and tokenizers are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None
