"""A corpus pipeline: quality, exact copies, near copies, mixing by source, packing.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns the documents that
stay, with the columns of its input as they are (whatever their names), but the last, which returns
pieces in sequences.  Each stage's results for nulls, ties, repeated rows and odd texts are those of
its operator; rows without an id stay in the join; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import common, exact_dedup, mixing, ngram_join, packing, quality_classifier
from marketlake.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney classifier, fitted on the labelled rows, keeps."""
    return quality_classifier.kept_documents(docs, common.table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, for each text."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, for each group of documents linked by similarity; rows without an id stay."""
    groups = ngram_join.near_duplicates(docs, 5, 75)
    stay = groups.where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(stay, "doc_id", "left_semi").unionByName(docs.where(F.col("doc_id").isNull())).select(*common.columns(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_path(), 2048)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing to target weights", mix), ("best-fit packing", pack)]

#: The classifier and the join have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = common.materialize(docs, "pipeline")
    return docs
