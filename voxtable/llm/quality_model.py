"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
BITS = 18
SAME_TWO, SAME_THREE = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)

#: Training rows at most, taken by hash of the id from all labelled rows that are not held out.
SAMPLE = 4_000


class _Words(dict):
    def __missing__(self, w: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[w] = h = zlib.crc32(w.encode("utf-8", "surrogatepass"))
        return h


def features(text: str | None, words: _Words, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and pairs of the whole text, and one count of repeats, with weights of unit length; empty text: none.

    A pair of the same word is one n-gram whatever the word, and so is any triple whose outer words are the
    same; so repetition is seen in words that no labelled text has.
    """
    tokens = TOKEN.findall(text or "")
    if not tokens:
        return np.zeros(0, np.int64), np.zeros(0)
    one = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    two = np.where(one[:-1] == one[1:], SAME_TWO, one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    three = np.full(int((one[:-2] == one[2:]).sum()), SAME_THREE)
    mixed = np.concatenate([one * np.uint64(0xFF51AFD7ED558CCD), two, three])
    at, n = np.unique(mixed >> np.uint64(64 - bits), return_counts=True)
    value = np.log1p(n)
    return at.astype(np.int64), value / np.sqrt(value @ value)


@dataclass
class Ftrl:
    """Logistic regression; each update touches only the coordinates of one example."""

    bits: int = BITS
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.0
    l2: float = 0.5
    z: np.ndarray = field(init=False)
    n: np.ndarray = field(init=False)

    def __post_init__(self):
        self.z, self.n = np.zeros((1 << self.bits) + 1), np.zeros((1 << self.bits) + 1)  # the last is the bias

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, value: np.ndarray, label: int, weight: float = 1.0) -> None:
        at, value = np.append(at, 1 << self.bits), np.append(value, 1.0)
        w = self.weights(at)
        g = weight * (_sigmoid(w @ value) - label) * value
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def held_out(id_col: str = "doc_id"):
    """Ids whose labels are never learnt; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, epochs: int = 3, bits: int = BITS) -> np.ndarray:
    """Weights, the last being the bias, learnt from at most `sample` labelled rows that are not held out.

    The rows are those of the smallest hashes of their ids; their ids, of a bounded number, are broadcast, and
    their features are made by executors.  An id of several rows counts with its least text and its larger
    label; labels other than 0 and 1 are passed over.  Without any row all weights are zero: every score is 0.5.
    """
    chosen = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(id_col)
        .agg(F.max(label_col).cast("int").alias("vx_label"))
        .orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col)
        .limit(sample)
    )
    rows = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).groupBy(id_col, "vx_label").agg(F.min(F.coalesce(text_col, F.lit(""))).alias("t"))
    rows = rows.select(F.xxhash64(F.col(id_col).cast("string")).alias("h"), "vx_label", "t")

    def made(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in it:
            found = [features(x.as_py(), words, bits) for x in batch.column(2)]
            arrays = [pa.array([a.astype("<i4").tobytes() for a, _ in found], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], names=["h", "y", "at", "value"])

    model = Ftrl(bits)
    got = sorted(map(tuple, rows.mapInArrow(made, "h long, y int, at binary, value binary").collect()))
    seen = [(np.frombuffer(a, "<i4"), np.frombuffer(v, "<f4"), y) for _, y, a, v in got]  # views, not copies
    for _ in range(epochs):
        for at, value, y in seen:
            model.learn(at, value, y)
    return model.weights(np.arange((1 << bits) + 1))


def scored(docs: DataFrame, weights: np.ndarray, text_col: str = "text", out: str = "score") -> DataFrame:
    """docs with the probability of label 1, a sparse dot product for each whole text, row by row."""
    names = [*docs.columns, out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{out}` double"
    place, bits = docs.columns.index(text_col), int(len(weights) - 1).bit_length() - 1
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))  # of a fixed size

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, w = _Words(), sent.value
        for batch in it:
            scores = []
            for x in batch.column(place):
                at, value = features(x.as_py(), words, bits)
                scores.append(_sigmoid(float(w[at] @ value + w[-1])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=names)

    return docs.mapInArrow(batches, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, score and predicted for every document, by a model learnt from labels.

    Null and empty texts have no features and get the bias's score.  Repeated rows get equal scores; null
    ids are held out; an empty table gives no rows.  Language, source and ids are never seen by the model.
    """
    weights = train(docs, labels, id_col, text_col)
    return scored(docs.select(F.col(id_col), F.col(text_col)), weights, text_col).select(
        id_col, held_out(id_col).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def op1_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
