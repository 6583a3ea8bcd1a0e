"""The corpus pipeline: quality, near duplicates, personal data, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last
return the columns of documents, further columns included. ``run`` writes each
result as Parquet and reads it again as the next stage's input.

Defined results: null and blank texts are scored as empty, are in no class of
near duplicates, have no personal data, add no words to the mix and, where the
mix takes them, get a row without a bin; null ids are kept like others; repeated
rows with words become one in the second stage; ties are broken as the operators
say; very long texts are worked on whole; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroquarry.llm import classifier, jaccard_join, mixing, packing, pii
from aeroquarry.llm._util import Scratch, table

#: Near duplicates: words of a shingle, and similarity in percent.
SHINGLE_WORDS, SIMILARITY_PCT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts; learnt from the labels outside the held-out fold."""
    model = classifier.train(docs, table(spark, sf_dir, "labels"), ~classifier.held_out(F.col("doc_id")))
    return classifier.score_column(docs, model).where(F.col("score") >= classifier.ACCEPT).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates; texts without words are in no class and all stay."""
    return jaccard_join.one_of_each_class(docs, SHINGLE_WORDS, SIMILARITY_PCT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return pii.mask_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes of a document."""
    return mixing.repeat_by_mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: its bin, and the bin's length and contents."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mixture),
    ("best-fit packing", packed),
]
#: Not expressible: the classifier and the packing are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
