"""Quality classifier (operator 4): hashed word n-grams, logistic regression, FTRL updates.

Words and marks (runs of letters, digits or underscore; runs of other
non-space characters) and their pairs are hashed into 2**BITS features. A text
is the vector of its feature counts over the square root of their number.
Training is follow-the-regularised-leader over a bounded sample of labelled
rows in one task; scoring is a sparse dot product with the learnt weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm._text import Remembered, batch_slices, slices
from tremor.session import small_batches

BITS = 18
#: The most labelled rows that a model learns from; those of the smallest hash of doc_id.
MAX_TRAIN_ROWS = 8000
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
_TOKENS = re.compile(r"\w+|[^\w\s]+").findall
_HASH = Remembered(lambda w: xxhash.xxh3_64_intdigest(w.encode()))
#: A word after itself is one pair whatever the word: most words are too rare to learn their own.
_AGAIN = np.uint64(0x5851F42D4C957F2D)


def features(text: str, bits: int = BITS) -> np.ndarray:
    """Feature numbers of a text's words and word pairs, with repeats."""
    words = _TOKENS(text)
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(_HASH.__getitem__, words), np.uint64, len(words))
    pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    pair[h[:-1] == h[1:]] = _AGAIN
    return (np.concatenate([h, pair]) >> np.uint64(64 - bits)).astype(np.int64)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = 5, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.0, l2: float = 1.0) -> np.ndarray:
    """FTRL-proximal (McMahan et al., 2013) over ``(features, values, label)``; the last weight is the bias.

    Without rows the weights are zero and every score is a half.
    """
    n = (1 << bits) + 1
    z, g2 = np.zeros(n), np.zeros(n)

    def weights(zi, gi):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(gi)) / alpha + l2))

    for _ in range(epochs):
        for idx, val, label in rows:
            idx, val = np.append(idx, n - 1), np.append(val, 1.0)
            zi, gi = z[idx], g2[idx]
            w = weights(zi, gi)
            p = 1 / (1 + np.exp(-np.clip(w @ val, -35, 35)))
            g = (p - label) * val
            sigma = (np.sqrt(gi + g * g) - np.sqrt(gi)) / alpha
            z[idx] = zi + g - sigma * w
            g2[idx] = gi + g * g
    return weights(z, g2)


def sparse(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    f = features(text, bits)
    idx, count = np.unique(f, return_counts=True)
    return idx, count / np.sqrt(max(len(f), 1))


def held_out(doc_id: str = "doc_id"):
    """Whether a row never trains: crc32 of doc_id as text, modulo FOLDS."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_TRAIN_ROWS, bits: int = BITS) -> np.ndarray:
    """Weights learnt from at most ``max_rows`` labelled rows that aren't held out.

    Labels that are null are left out; of several labels of one doc_id the
    largest holds; null texts count as empty. The sample is the rows of the
    smallest hash of doc_id among those labelled, so it is the same whatever
    the partitioning. It is bounded, so it is joined by broadcast, trained on
    in one task, and only the 2**bits weights come to the driver.
    """
    small_batches(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    known = known.select("doc_id", "y", F.xxhash64("doc_id").alias("o")).orderBy("o", "doc_id").limit(max_rows)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).join(F.broadcast(known), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("t").alias("t"), F.first("y").alias("y"), F.first("o").alias("o"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [sparse(t, bits) for t in part["t"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part["o"], pa.int64()), pa.array(part["y"], pa.int32()), pa.array([i.astype(np.int32) for i, _ in found], pa.list_(pa.int32())), pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32()))],
                ["o", "y", "idx", "val"],
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = []
        for b in batches:
            o, y, idx, val = (b.column(i) for i in range(4))
            got += [(o[i].as_py(), (idx[i].values.to_numpy(), val[i].values.to_numpy(), y[i].as_py())) for i in range(b.num_rows)]
        got.sort(key=lambda r: r[0])
        w = train([r[1] for r in got], bits)
        yield pa.RecordBatch.from_arrays([pa.array([w.astype(np.float64).tobytes()])], ["w"])

    sampled = rows.mapInArrow(featurise, "o long, y int, idx array<int>, val array<float>")
    return np.frombuffer(bytes(sampled.repartition(1).mapInArrow(learn, "w binary").first()[0]), np.float64)


def score(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text; one row per input row, repeats included.

    A null or empty text has no features, so its score is that of the bias.
    Other columns are ignored; a null doc_id is scored and not held out.
    """
    held = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float64))  # 2**bits numbers, whatever the data
    bits = int(np.log2(len(weights) - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = held.value
        for part in slices(batches):
            s = []
            for t in part["t"]:
                f = features(t, bits)
                s.append(1 / (1 + np.exp(-np.clip(w[f].sum() / np.sqrt(max(len(f), 1)) + w[-1], -35, 35))))
            yield pa.RecordBatch.from_arrays([pa.array(part["i"], pa.int64()), pa.array(part["h"], pa.bool_()), pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32())], ["doc_id", "held_out", "score", "predicted"])
        _HASH.clear()

    return docs.select(F.col("doc_id").cast("long").alias("i"), held_out().alias("h"), F.coalesce("text", F.lit("")).alias("t")).mapInArrow(run, SCHEMA)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """Fit on ``labels`` and score every row of ``docs``; an empty table gives an empty result."""
    return score(docs, fit(docs, labels, label))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, with their columns.

    Null and empty texts have the score of the bias, null doc_ids are scored
    like others, repeated rows stay as often; without labels every score is a
    half. An empty table gives an empty result. Rows go by slices of bounded
    rows and bytes.
    """
    weights = fit(docs, labels)
    held = docs.sparkSession.sparkContext.broadcast(weights)
    bits = int(np.log2(len(weights) - 1))
    at = docs.columns.index("text")
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # names with a dot can't be mapped

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = held.value
        for batch in batch_slices(batches, 512):
            keep = []
            for t in batch.column(at).to_pylist():
                f = features(t or "", bits)
                x = w[f].sum() / np.sqrt(max(len(f), 1)) + w[-1]
                keep.append(bool(1 / (1 + np.exp(-np.clip(x, -35, 35))) >= threshold))
            yield batch.filter(pa.array(keep, pa.bool_()))
        _HASH.clear()

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
