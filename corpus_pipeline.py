"""The training-data pipeline over documents: five stages, each a query of the operators in solidspark.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
docs of the next. All but the last return the columns of documents; where a stage changes texts, ``n_chars``
follows. Rows with null ids or texts pass the stages that their operators define so (see there)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solidspark.llm import decontam, linedup, minhash, packing, quality
from solidspark.llm.common import stage, table
from solidspark.skew import shuffled


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` but those with an id of ``ids`` (doc_id, distinct)."""
    gone = ids.select(F.col("doc_id").alias("_gone"))
    return docs.join(shuffled(gone), docs["doc_id"].eqNullSafe(gone["_gone"]), "left_anti")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score under its threshold) go."""
    scored = quality.score(docs, table(spark, sf_dir, "labels"))
    rejected = scored.groupBy("doc_id").agg(F.max("predicted").alias("p")).where("p = 0")
    return _without(docs, rejected)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows go; a document that loses its last line goes with it."""
    found = linedup.dedup_lines(docs).where((F.size("removed") < F.col("n_lines")) | (F.size("removed") == 0))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return _without(docs, minhash.near_duplicates(docs).where("not kept").select("doc_id").distinct())


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontam.flag(docs, table(spark, sf_dir, "benchmark")).where("not contaminated").select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document that is left, and its place in a sequence of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: A learned score decides the first stage: SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{k}")
    return docs
