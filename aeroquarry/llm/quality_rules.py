"""Operator 1: quality rules with host-level verdicts.

Every document is measured on its whole text and put to four rules: too few
words, repeated passages, symbols, repeated lines. The failures of each rule
are counted for each host (the ``source`` column), and each host's rate is
shrunk towards the mean of all hosts by that rule's own empirical beta prior. A
host whose shrunk rate passes the limit of any rule (``LIFT`` times the mean, but
at most half way from the mean to 1, and at least ``LEAST_LIMIT``) loses all its
documents. A document itself fails by the
first two rules only; the other two speak about hosts.

Defined results: a null or blank text has no words and fails the length rule;
rows without a host get no host verdict (kept unless they fail themselves);
very long texts are measured whole, with a few bytes a word; null ids and
repeated rows are judged one by one; an empty table gives an empty result;
further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import Scratch

SYMBOLS = "#*$%&|<>"
WINDOW = 5
LONG_WORDS = 200_000
FEATURES = "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
#: A host goes when a rule's shrunk rate passes LIFT times the rule's mean (half way to 1 at most), but never below LEAST_LIMIT.
LIFT, LEAST_LIMIT = 4.0, 0.25
#: Percent: repeated words and lines of all words, and symbols of all characters of words.
MAX_REPEAT, MAX_LINES, MAX_SYMBOLS = 20, 10, 10
RULES = ("short", "repeats", "symbols", "lines")
_BLANK_CHARS = " \t\n\x0b\f\r"


def repeated_words(words: list[bytes]) -> int:
    """Words inside any window of five that occurs twice or more in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    if n > LONG_WORDS:  # 20 bytes a word instead of tuples
        ids: dict[bytes, int] = {}
        codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int32, n)
        rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(codes, WINDOW))
        _, back, counts = np.unique(rows.view(f"V{4 * WINDOW}").ravel(), return_inverse=True, return_counts=True)
        twice = counts[back] > 1
    else:
        windows = list(zip(*(words[k:] for k in range(WINDOW)), strict=False))
        if len(set(windows)) == len(windows):
            return 0
        counts_of = Counter(windows)
        twice = np.fromiter((counts_of[w] > 1 for w in windows), bool, len(windows))
    edge = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def duplicate_lines(text: str) -> int:
    seen: set[str] = set()
    repeats = 0
    for line in text.split("\n"):
        if line in seen:
            repeats += 1
        elif line.strip(_BLANK_CHARS):
            seen.add(line)
    return repeats


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split on ASCII white space only
    return (
        len(words),
        len(text) - sum(map(text.count, _BLANK_CHARS)),
        sum(map(text.count, SYMBOLS)),
        duplicate_lines(text),
        repeated_words(words),
    )


def _measured(batches):
    for batch in batches:
        rows = [measure(t) for t in batch.column(2).to_pylist()]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in cols)],
            ["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
        )


def beta_prior(hosts: DataFrame, failed: str, total: str, default_strength: float = 20.0) -> tuple[float, float]:
    """Mean and strength of a beta prior by the method of moments, from per-host counts (one row comes back)."""
    rate = F.col(failed) / F.col(total)
    row = hosts.agg(
        F.sum(failed).alias("k"), F.sum(total).alias("n"), F.avg(rate).alias("m"),
        F.var_samp(rate).alias("v"), F.avg(1 / F.col(total)).alias("inv"),
    ).first()
    if not row["n"]:
        return 0.0, default_strength
    mean = row["k"] / row["n"]
    spread = row["m"] * (1 - row["m"])
    between = (row["v"] or 0.0) - spread * row["inv"]  # less what binomial noise explains
    strength = spread / between - 1 if between > 0 else 1e4
    return mean, min(max(strength, default_strength), 1e4)


def rule_columns(min_words: int) -> dict:
    """Whether a measured document fails each rule."""
    return {
        "short": F.col("n_words") < min_words,
        "repeats": F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT,
        "symbols": F.col("n_symbols") * 100 > F.col("word_chars") * MAX_SYMBOLS,
        "lines": F.col("n_dup_lines") * 100 > F.col("n_words") * MAX_LINES,
    }


def quality_rules(docs: DataFrame, host: str = "source", min_words: int = 10, lift: float = LIFT, least_limit: float = LEAST_LIMIT) -> DataFrame:
    """Per document: its measures, ``base_failed`` and ``kept`` after the host's verdict."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality-rules")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).alias("host"), F.col("text"))
    fails = rule_columns(min_words)
    measured = scratch.save(rows.mapInArrow(_measured, FEATURES).withColumn("base_failed", fails["short"] | fails["repeats"]), "measured")
    counts = [F.sum(fails[rule].cast("long")).alias(rule) for rule in RULES]
    hosts = scratch.save(measured.where(F.col("host").isNotNull()).groupBy("host").agg(F.count(F.lit(1)).alias("total"), *counts), "hosts")
    rejected = F.lit(False)
    for rule in RULES:
        mean, strength = beta_prior(hosts, rule, "total")
        rejected |= (F.col(rule) + mean * strength) / (F.col("total") + strength) > max(min(lift * mean, (1 + mean) / 2), least_limit)
    out = hosts.where(rejected).select(F.col("host").alias("__host"))
    return measured.join(out, F.col("host") == F.col("__host"), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("__host").isNull()).alias("kept"),
    )
