"""Toxicity scores by FTRL-proximal logistic regression over hashed n-grams.

Features are the distinct words, word pairs and one-word-skipping pairs of the whole text,
hashed. Every coordinate has its own learning rate, and L1 keeps coordinates at zero that
have not seen enough evidence, so the weights are few and can be sent to all executors.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import batches, documents

BITS = 22
#: Labelled rows used for training at most, by the smallest hash of their id, and distinct
#: features of these together (four bytes each in the learner), where texts are long.
TRAIN_ROWS = 32_768
TRAIN_FEATURES = 64 << 20
EPOCHS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.01
THRESHOLD = 0.7

_WORDS = re.compile(r"[^\W_]+")
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_SKIP = np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(64 - BITS)


def _hashed(text: str) -> np.ndarray:
    """Feature numbers of a text, with repeats."""
    words = _WORDS.findall(text.lower())
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    pairs = (hashed[:-1] * _PAIR + hashed[1:]) * _PAIR
    skips = (hashed[:-2] * _SKIP + hashed[2:]) * _SKIP
    return (np.concatenate([hashed, pairs, skips]) >> _SHIFT).astype(np.int64)


def features(text: str) -> np.ndarray:
    """Sorted distinct feature numbers of a text; none for an empty one."""
    return np.unique(_hashed(text))


def evidence(text: str, weights: np.ndarray) -> float:
    """Sum of the weights of the distinct features; only those with a weight are made distinct."""
    at = _hashed(text)
    return float(weights[np.unique(at[weights[at] != 0])].sum())


def train(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Sequential FTRL-proximal; the bias is not regularized."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = 0.0
    for _ in range(epochs):
        for at, label in rows:
            own_z, own_n = z[at], n[at]
            weight = _weights(own_z, own_n)
            bias = -bias_z * ALPHA / (BETA + math.sqrt(bias_n))
            error = _sigmoid(weight.sum() + bias) - label
            square = error * error
            step = (np.sqrt(own_n + square) - np.sqrt(own_n)) / ALPHA
            z[at] = own_z + error - step * weight
            n[at] = own_n + square
            bias_z += error - (math.sqrt(bias_n + square) - math.sqrt(bias_n)) / ALPHA * bias
            bias_n += square
    return _weights(z, n), -bias_z * ALPHA / (BETA + math.sqrt(bias_n))


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, x))))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: crc32 of the id's text is 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


_SAMPLE = pa.schema([("at", pa.string()), ("features", pa.binary()), ("toxic", pa.int32())])
_MODEL = pa.schema([("feature", pa.int64()), ("weight", pa.float64())])
_BIAS = -1


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS,
        train_features: int = TRAIN_FEATURES) -> dict[int, float]:
    """Non-zero weights by feature, with the bias under -1.

    The sample holds at most ``train_rows`` labelled rows, and of these, in the order of a hash
    of their ids, as many as have ``train_features`` features together, whatever the table's
    size. Only ``text`` is read as input. NULL labels and ids, and held-out ids, are left out; an
    id with contradicting labels counts as toxic. With nothing to learn from, every score is 0.5.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()
                           & ~held_out(F.col("doc_id").cast("long")))
    picked = (usable.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    # At most ``train_rows`` pairs of numbers, so they may be sent out.
    rows = (documents(docs).join(F.broadcast(picked), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")))

    def featured(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in stream:
                for doc_id, text, toxic in zip(*batch.columns):
                    yield (_order(doc_id.as_py()), features(text.as_py()).astype(np.int32).tobytes(),
                           int(toxic.as_py() > 0))

        return batches(found(), _SAMPLE, 256)

    def learn(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample, held = [], 0
        for batch in stream:
            for at, label in zip(batch.column(1), batch.column(2)):
                at = np.frombuffer(at.as_buffer(), np.int32)
                held += len(at)
                if held > train_features:
                    break
                sample.append((at, label.as_py()))
            if held > train_features:
                break
        for _ in stream:            # whatever lies beyond the bound
            pass
        if not sample:
            return
        weights, bias = train(sample)
        kept = np.flatnonzero(weights)
        yield from batches([(_BIAS, bias), *zip(kept.tolist(), weights[kept].tolist())], _MODEL)

    # Features are found where the texts are. One task learns, from the bounded sample; its
    # result is bounded by the feature space.
    learned = (rows.mapInArrow(featured, "at string, features binary, toxic int")
               .repartition(1).sortWithinPartitions("at")
               .mapInArrow(learn, "feature long, weight double"))
    return {row["feature"]: row["weight"] for row in learned.collect()}


def _order(doc_id: int) -> str:
    """Where a row stands in the sample, as text that sorts like the hash."""
    return f"{xxhash.xxh3_64_intdigest(str(doc_id)):016x}{doc_id}"


@functools.lru_cache(maxsize=2)
def _dense(packed: tuple[bytes, bytes]) -> np.ndarray:
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[np.frombuffer(packed[0], np.int64)] = np.frombuffer(packed[1], np.float64)
    return weights


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(docs: DataFrame, model: dict[int, float], carry: tuple[str, ...] = (),
          with_text: bool = False) -> DataFrame:
    """``doc_id`` and ``score`` of every row; ``carry`` names columns handed through unread.

    ``with_text`` gives the text back too, a NULL one as empty.
    """
    bias = model.get(_BIAS, 0.0)
    pairs = sorted((at, w) for at, w in model.items() if at != _BIAS)
    packed = (np.array([at for at, _ in pairs], np.int64).tobytes(),
              np.array([w for _, w in pairs], np.float64).tobytes())
    sent = docs.sparkSession.sparkContext.broadcast(packed)
    handed = (*(["text"] if with_text else []), *carry)

    def rate(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _dense(sent.value)
        for batch in stream:
            scores = [_sigmoid(evidence(text.as_py(), weights) + bias)
                      for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), *batch.columns[1 if with_text else 2:]],
                names=["doc_id", "score", *handed])

    kept = documents(docs, *carry)
    schema = kept.select("doc_id").schema.add("score", "double")
    for name in handed:
        schema = schema.add(kept.schema[name])
    return kept.mapInArrow(rate, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    NULL and empty texts score the bias alone. Repeated rows are scored one by one; extra
    columns are never inputs.
    """
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
