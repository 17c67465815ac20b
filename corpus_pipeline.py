"""From raw documents to packed training sequences, stage by stage.

Every stage takes what its predecessor kept and returns the columns of
documents (the last one: pieces of sequences). Between stages rows are written
as Parquet to the shared folder and read again, so a lost executor repeats one
stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.llm import ngram_join, packing, pii, quality_crf, substring
from tagwright.llm.frames import small_batches
from tagwright.llm.queries import PII_KEY
from tagwright.workspace import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF, trained on ``labels``, accepts."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_crf.keep_good(docs, quality_crf.train_quality(docs, labels))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates."""
    small_batches(spark)
    return ngram_join.keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without words of passages that a document of smaller id holds."""
    small_batches(spark)
    return substring.remove_repeated(docs)


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; ``n_chars`` follows the text."""
    small_batches(spark)
    out = pii.pseudonymise(docs, PII_KEY)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
        F.length("text").cast(docs.schema["n_chars"].dataType)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the sequences they lie in."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("PII", pii_pseudonyms),
    ("packing", pack_sequences),
]

#: trained models, links and tokenizers are beyond SQL; tests hold the result against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return docs
