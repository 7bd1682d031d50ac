"""A training corpus from raw documents: classify, remove repeated lines, keep one of near copies, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes each stage's result
into the shared folder and reads it again, so a lost executor costs at most
one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import lines, mixing, ngram_join, packing, quality
from tidemark.llm.queries import vocabulary_path
from tidemark.llm.store import written
from tidemark.session import ship_package


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on this stage's input and the labels, accepts."""
    ship_package(spark)
    weights = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, weights).where("predicted = 1").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line matches; one that loses every line with a word goes."""
    ship_package(spark)
    kept = lines.dedup(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]") | (F.col("n_removed") == 0))
    n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", n_chars).select(docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship_package(spark)
    return ngram_join.representatives(docs, ngram_join.join(docs)).select(docs.columns)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    ship_package(spark)
    return mixing.mixed_documents(docs, mixing.mix(docs))


def packing_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences, with their ids."""
    ship_package(spark)
    return packing.pack(docs, vocabulary_path())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("mixing", mixing_to_weights),
    ("packing", packing_sequences),
]

#: SQL can express neither the classifier nor the tokeniser.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
