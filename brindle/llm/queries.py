"""The registered queries of the corpus operators: thin calls with production parameters over whole tables.

A null doc_id is in no fold: nothing is learnt from it and it is not held out.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import filter_audit, fingerprints, html_extract, mixing, packing, partenum, quality, rp_forest, sharding, suffix_repeats, toxicity, variants, warc
from brindle.llm.common import fold, scratch_path
from brindle.llm.oracles import ORACLES as ORACLES


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    model = quality.fit_quality(docs, labels, learn=fold(F.col("doc_id"), 5) != 0)
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs, labels, learn=fold(F.col("doc_id"), 4) != 2)
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.near_duplicates(_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), scratch_path(spark, "warc"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_components(_table(spark, sf_dir, "documents").select("doc_id", "text"), n=4, least=85, most=100)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"), _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_sharding": op2_sharding,
    "op3_mixing": op3_mixing,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_toxicity": op5_toxicity,
    "op6_embedding_near_dups": op6_embedding_near_dups,
    "op7_warc": op7_warc,
    "op8_fingerprints": op8_fingerprints,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_packing": op10_packing,
    "op11_suffix_array_dedup": op11_suffix_array_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_filter_audit": op13_filter_audit,
}
