"""From raw documents to packed sequences: five stages, each written before the next one reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import mixing, packing, partenum, quality, toxicity
from brindle.llm.common import fold, written

TOKENIZER = "byte_bpe_50k.json"


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the compression classifier rejects.

    Null texts are judged as empty ones, equal rows alike; a null doc_id teaches nothing but is judged like others. An
    empty table stays empty; all columns are kept.
    """
    return quality.keep_quality(docs, _labels(spark, sf_dir), learn=fold(F.col("doc_id"), 5) != 0)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the counterfactual-regularised classifier calls toxic.

    Nulls, repeated rows, empty tables and further columns as in the first stage.
    """
    return toxicity.drop_toxic(docs, _labels(spark, sf_dir), learn=fold(F.col("doc_id"), 4) != 2)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each component of similar documents (five words, 0.8).

    A repeated row stays once, a row with a null doc_id only if its component has no other; null and empty texts are
    similar to nothing and all stay. An empty table stays empty; all columns are kept.
    """
    return partenum.one_of_each(docs, n=5, least=80, most=100)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats, keeps or leaves out documents so that sources meet their targets.

    A null source is a source of its own. Documents without words (null texts as well) are not in the mix. An empty
    table stays empty; all columns are kept, n_chars is that of the text given.
    """
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences; a row for each piece.

    A null text is one end token; repeated rows are documents of their own; an empty table gives no pieces.
    """
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The classifiers and the packing cannot be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
