"""Operator 6: a quality classifier by compression.

Two zstandard dictionaries are built, one from the good and one from the bad
labelled texts, of the segments that are shared most, counted over all their
bytes. A whole text is cut into blocks; each block is compressed with either
dictionary, and the summed sizes give the normalised difference
``(bad - good) / length``, beside how far the text compresses at all. A logistic
fit turns these into a calibrated score, the probability of the good label.
Which of these features it uses (``FEATURE_SETS``) and how strong its ridge is
(``RIDGES``) is chosen by the log loss of cross-validation inside the learning
rows: each fold's features come from dictionaries built without it.

The fit reads at most ``sample`` labelled documents of each label, the first in
order of a hash of their id, and of a text longer than ``TEXT_BYTES`` the
dictionaries take evenly spaced pieces over its whole length; nothing else is
limited. Only label rows that ``allowed`` lets through are used. Texts stay on
the executors; the driver gets the dictionaries' material and a few numbers for
each learning text.

Defined results: null and blank texts get the score of an empty text, which is
the fitted one for no evidence; labels without a value or without an id are
ignored, and so are documents without an id in learning (they are scored);
without both kinds of labels every score is the share of good labels (0.5
without any); equal texts of a label count once in the fit; very long texts are
scored whole, block by block; repeated rows are scored one by one and equal
texts score alike; further columns are never read, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import Scratch, small_batches

BLOCK = 2048
DICT_BYTES = 112_640
#: Bytes of a segment of a dictionary, of the runs that are counted to pick it, and passes over the texts that fill one.
SEGMENT, RUN, PASSES = 64, 8, 4
#: Runs are counted by hash, in a table of fixed size.
CELL_BITS = 22
LEVEL = 3
ACCEPT = 0.3
N_FEATURES = 9
FOLDS = 5
#: Bytes that a learning text gives to the dictionaries at most, as so many pieces over its whole length.
TEXT_BYTES, PIECES = 1 << 18, 64
#: What the fit may use: the difference alone, with how far the text compresses, or all.
FEATURE_SETS = ((0,), (0, 1, 2, 3, 6), tuple(range(N_FEATURES)))
#: Strengths of the ridge, for one text of the rarer label.
RIDGES = (0.001, 0.003, 0.01, 0.03, 0.1)


@dataclass
class Model:
    good: bytes
    bad: bytes
    center: list[float]
    scale: list[float]
    weights: list[float]  # the intercept first

    def score(self, features: np.ndarray) -> np.ndarray:
        z = (features - self.center) / self.scale
        z = np.clip(z, -8, 8) @ np.array(self.weights[1:]) + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Sizer:
    """Compressed sizes of whole texts under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.by = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.by.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)

    def features(self, text: str | None) -> tuple[float, ...]:
        """The normalised difference, how far the text compresses alone and with either dictionary, and their curvature."""
        data = (text or "").encode("utf-8", "surrogatepass")
        if not data.strip():
            return (0.0,) * N_FEATURES
        good = bad = 0
        for at in range(0, len(data), BLOCK):
            block = data[at : at + BLOCK]
            good += len(self.by[0].compress(block))
            bad += len(self.by[1].compress(block))
        n = len(data)
        diff, best, alone = (bad - good) / n, math.log(min(good, bad) / n), math.log(len(self.plain.compress(data)) / n)
        size = math.log(n)
        return diff, diff * diff, best, best * best, alone, alone * alone, diff * best, size, size * alone


def _runs(raw: np.ndarray) -> np.ndarray:
    """Cells of all runs of ``RUN`` bytes in the table of counts."""
    n = max(0, len(raw) - RUN + 1)
    v = np.zeros(n, np.uint64)
    for i in range(RUN):
        v = (v << np.uint64(8)) | raw[i : i + n]
    return ((v * np.uint64(0x9E3779B185EBCA87)) >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def dictionary(texts: list[bytes], size: int = DICT_BYTES) -> bytes:
    """Raw content of at most ``size`` bytes: the whole texts where they fit, else their most shared segments.

    Runs of bytes are counted over the whole of every text, however many there are. The texts are then passed in
    equal stretches; each gives the segment whose runs are the most frequent among those that no segment holds yet.
    The segments taken first come last, where references to them are the shortest.
    """
    blobs = [t for t in texts if t.strip()]
    if not blobs:
        return b" " * 64
    whole = b"".join(blobs)
    if len(whole) <= size:
        return whole
    raw, counts = np.frombuffer(whole, np.uint8), np.zeros(1 << CELL_BITS, np.int64)
    for at in range(0, len(raw), 1 << 22):
        counts += np.bincount(_runs(raw[at : at + (1 << 22) + RUN - 1]), minlength=len(counts))
    most, span = size // SEGMENT, SEGMENT - RUN + 1
    stretches = max(1, most // PASSES)
    parts, before = [], -1
    while before < len(parts) < most:  # ends when full, or when a pass finds nothing more
        before = len(parts)
        for i in range(stretches):
            lo, hi = i * len(raw) // stretches, (i + 1) * len(raw) // stretches
            runs = _runs(raw[lo : hi + SEGMENT - 1])
            upto = np.append(0, np.cumsum(counts[runs]))
            gain = upto[span:] - upto[:-span]
            best = int(gain.argmax())
            if gain[best] > 0 and len(parts) < most:
                parts.append(whole[lo + best : lo + best + SEGMENT])
                counts[runs[best : best + span]] = 0
    return b"".join(reversed(parts))


def pieces(data: bytes) -> bytes:
    """All of a text up to ``TEXT_BYTES``; of a longer one equal pieces, evenly spaced from its start to its end."""
    if len(data) <= TEXT_BYTES:
        return data
    size = TEXT_BYTES // PIECES
    return b"".join(data[at : at + size] for at in (i * (len(data) - size) // (PIECES - 1) for i in range(PIECES)))


def _logistic(z: np.ndarray, y: np.ndarray, weight: np.ndarray, strength: float) -> np.ndarray:
    """Weights of a ridge-regularised logistic fit by Newton's method; the intercept comes first."""
    ridge = np.diag([1e-6] + [strength] * (z.shape[1] - 1))  # keeps separable labels finite
    beta = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + ridge, z.T @ (weight * (p - y)) + ridge @ beta)
        beta -= step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
    return beta


def choose(z: np.ndarray, y: np.ndarray, weight: np.ndarray, fold: np.ndarray, rare: int) -> tuple[tuple[int, ...], float]:
    """The feature set and the ridge of least log loss over the folds, each predicted by a fit on the others."""

    def loss(columns: tuple[int, ...], ridge: float) -> float:
        x, total = z[:, [0, *(c + 1 for c in columns)]], 0.0
        for f in np.unique(fold):
            rest, own = fold != f, fold == f
            if len(np.unique(y[rest])) < 2:
                return math.inf
            p = 1 / (1 + np.exp(-np.clip(x[own] @ _logistic(x[rest], y[rest], weight[rest] / weight[rest].sum(), ridge / rare), -30, 30)))
            total -= float((weight[own] * np.log(np.where(y[own] > 0, p, 1 - p))).sum())
        return total

    return min(((c, r) for c in FEATURE_SETS for r in RIDGES), key=lambda o: loss(*o))


def fit(x: np.ndarray, y: np.ndarray, fold: np.ndarray, good: bytes, bad: bytes, priors: tuple[int, int]) -> Model:
    """The calibrated model from cross-fitted features ``x`` and the final dictionaries."""
    n_good, n_bad = priors
    if not (y > 0).any() or not (y <= 0).any():
        share = (n_good + 1) / (n_good + n_bad + 2)
        return Model(b" " * 64, b" " * 64, [0.0] * N_FEATURES, [1.0] * N_FEATURES, [math.log(share / (1 - share)), *[0.0] * N_FEATURES])
    have = (int((y > 0).sum()), int((y <= 0).sum()))
    weight = np.where(y > 0, n_good / have[0], n_bad / have[1]) / (n_good + n_bad)
    center, scale = x.mean(0), x.std(0) + 1e-6
    z = np.column_stack([np.ones(len(x)), np.clip((x - center) / scale, -8, 8)])
    columns, ridge = choose(z, y, weight, fold, min(have))
    beta = np.zeros(N_FEATURES + 1)
    used = [0, *(c + 1 for c in columns)]
    beta[used] = _logistic(z[:, used], y, weight, ridge / min(have))
    return Model(good, bad, center.tolist(), scale.tolist(), beta.tolist())


def train(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, sample: int = 1500) -> Model:
    """Fit on at most ``sample`` documents of each label, drawn in hash order from all allowed labels."""
    scratch = Scratch(docs.sparkSession, "classifier")
    rows = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows.where(allowed) if allowed is not None else rows
    counts = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    order = [F.xxhash64(F.col("doc_id"), F.lit(23)), "doc_id"]
    ids = None
    for q in (1, 0):
        part = rows.where(F.col("quality") == q).select("doc_id", "quality").orderBy(*order).limit(sample)
        ids = part if ids is None else ids.unionByName(part)
    chosen = F.broadcast(ids.select(F.col("doc_id").alias("__id"), "quality").distinct())  # at most 2 * sample rows
    texts = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("__id")).where(F.col("text") != "")
    texts = texts.groupBy("quality", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.min("doc_id").alias("doc_id"))
    # In the order of ids, folds are dealt in turn; a few thousand rows, texts left behind.
    turn = Window.partitionBy("quality").orderBy("doc_id", "h")
    dealt = texts.select("quality", "h", "doc_id").withColumn("fold", (F.row_number().over(turn) - 1) % FOLDS).drop("doc_id")
    texts = scratch.save(texts.join(F.broadcast(dealt), ["quality", "h"]).select("quality", "fold", "h", "text"), "texts")
    # Every text in one order, so that the dictionaries come out the same on each run.
    given = sorted(tuple(r) for r in texts.mapInArrow(_pieces, "quality long, fold long, h long, data binary").collect())

    def dictionaries(but: int | None) -> tuple[bytes, bytes]:
        kept = [[bytes(d) for q, f, _, d in given if q == label and f != but] or [bytes(d) for q, _, _, d in given if q == label] for label in (1, 0)]
        return dictionary(kept[0]), dictionary(kept[1])

    seen = docs.sparkSession.sparkContext.broadcast([dictionaries(f) for f in range(FOLDS)])

    def features(batches):
        sizers = [Sizer(*pair) for pair in seen.value]
        for batch in batches:
            f = batch.column(1).to_pylist()
            x = [sizers[k].features(t) for k, t in zip(f, batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i).cast(pa.int64()) for i in range(3)] + [pa.array(x, pa.list_(pa.float64()))], ["quality", "fold", "h", "x"])

    found = sorted((tuple(r) for r in texts.mapInArrow(features, "quality long, fold long, h long, x array<double>").collect()), key=lambda r: r[:3])
    x = np.array([r[3] for r in found], float).reshape(-1, N_FEATURES)
    y, fold = np.array([float(r[0]) for r in found]), np.array([r[1] for r in found])
    good, bad = dictionaries(None)
    return fit(x, y, fold, good, bad, (counts.get(1, 0), counts.get(0, 0)))


def _pieces(batches):
    for batch in batches:
        data = [pieces(t.encode("utf-8", "surrogatepass")) for t in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(i).cast(pa.int64()) for i in range(3)] + [pa.array(data, pa.binary())], ["quality", "fold", "h", "data"])


def score_column(docs: DataFrame, model: Model) -> DataFrame:
    """(row, score): each row of ``docs`` whole, with its score. Only texts go to Python, and only numbers come back."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of bounded size

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizer = Sizer(shared.value.good, shared.value.bad)
        for batch in texts:
            x = np.array([sizer.features(t) for t in batch], float).reshape(-1, N_FEATURES)
            yield pd.Series(shared.value.score(x))

    return docs.select(F.struct("*").alias("row"), score(F.col("text")).alias("score"))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """The fold that is never learnt from: crc32 of the id's text is a multiple of ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == 0


def classify(docs: DataFrame, labels: DataFrame, sample: int = 1500) -> DataFrame:
    """doc_id, held_out, score and predicted (1: good) of every document."""
    model = train(docs, labels, ~held_out(F.col("doc_id")), sample)
    scored = score_column(docs.select("doc_id", "text"), model).select("row.doc_id", "score")
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted")
    )
