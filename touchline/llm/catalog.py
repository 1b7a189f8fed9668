"""Registered queries of this subpackage: name -> fn(spark, sf_dir), and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (
    embedding_graph,
    license_scan,
    ngram_join,
    packing_bfd,
    packing_bm25,
    quality_rules,
    sharding,
    source_mix,
    spelling,
    suffix_dedup,
    toxicity_fm,
    warc,
    whitening,
)
from touchline.llm.common import read
from touchline.session import shared_dir


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(read(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.pages_through_archives(read(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(read(spark, sf_dir, "documents")).drop("spans")


def op4_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_graph.embedding_links(read(spark, sf_dir, "embeddings"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(read(spark, sf_dir, "documents"), with_text=False).drop("kept")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # failed_rule names the first rule of a timed order, so it may differ between runs.
    return quality_rules.quality_rules(read(spark, sf_dir, "documents")).drop("failed_rule")


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = source_mix.mix(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op8_packing_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_bm25.pack_bm25(read(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op9_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_fm.train(docs, read(spark, sf_dir, "labels"))
    out = toxicity_fm.score(docs, model)
    return out.select("doc_id", toxicity_fm.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
                      (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op10_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-matrices")
    packing_bfd.write_matrices(packing_bfd.pack_bfd(read(spark, sf_dir, "documents")), path)
    return packing_bfd.pieces(spark.read.parquet(path))


def op11_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(read(spark, sf_dir, "documents")).drop("source")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_warc": op2_warc,
    "op3_license_scan": op3_license_scan,
    "op4_embedding_graph": op4_embedding_graph,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_source_mix": op7_source_mix,
    "op8_packing_bm25": op8_packing_bm25,
    "op9_toxicity_fm": op9_toxicity_fm,
    "op10_token_matrices": op10_token_matrices,
    "op11_interleave": op11_interleave,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_whitening": op13_whitening,
}

ORACLE = {
    "op6_quality_rules": quality_rules.ORACLE,
    "op7_source_mix": source_mix.ORACLE,
}
