"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, classifier, jaccard_join, media, mixing, packing, pii, quality_rules, suffix_dedup, url_filters
from ._util import table
from .oracles import oracle_sql  # noqa: F401

URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    outcomes = url_filters.labelled_outcomes(pages, table(spark, sf_dir, "labels"))
    return url_filters.url_filter(pages, outcomes, URL_RULES)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    links, messages = chat.chain(rows.unionByName(extra))
    formatted = chat.read_back(chat.format_paths(messages, chat.best_paths(links)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select(
        F.col("tree_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height")
    return media.media(table(spark, sf_dir, "documents")).select(*columns)


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    of_kind = lambda i: F.filter("spans", lambda s: s["base"] & (s["kind"] == i))
    counts = [F.size(of_kind(i)).cast("long").alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.spans_text(base), 256).alias("base_sha256"), pii.spans_text(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_quality_rules, op2_url_filters, op3_mixing, op4_chat_formatting, op5_best_fit_packing, op6_quality_classifier, op7_suffix_array_dedup, op8_media_columns, op9_ngram_jaccard_join, op10_pii)}
