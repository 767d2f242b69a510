"""Toxic passages: the maximal scoring segments of a text's words.

* A word's score is its log-odds between toxic and clean training texts under
  an informative Dirichlet prior (its share of the whole corpus), taken as
  nothing where it is not significant, less a drift that makes clean text lose.
* A linear scan finds every maximal scoring segment of a text. Scores of the
  best segment of clean text follow an extreme-value law, so a segment of score
  S in n words has the expected number K n exp(-lambda S) by chance; those
  expected less than ``SIGNIFICANT`` times are toxic passages.
* A text's probability is a logistic function of those expectations, fitted on
  a bounded sample of labelled texts (``SAMPLE``). Counts cover all rows.

Words are hashed into ``BUCKETS`` counters, so the model has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexispan.llm.textbytes import letter_runs, letter_word_hashes, utf8_slices
from lexispan.llm.workers import lean
from lexispan.operators.keys import broadcast_if_small

BUCKETS = 1 << 18

# Strength of the prior in words, and the drift per word in nats.
PRIOR = 100_000.0
DRIFT = 0.1
# Log-odds of fewer standard deviations count as none.
DEVIATIONS = 4.0

SIGNIFICANT = 0.05

# Labelled texts that the logistic function is fitted on, at most.
SAMPLE = 20_000

ADDED = (
    "toxic_score double, toxic_strongest double, toxic_total double, "
    "toxic_passages array<struct<start:long,stop:long,score:double,expected:double>>"
)


@dataclass
class ToxicityModel:
    scores: np.ndarray  # per bucket
    rate: float  # lambda
    scale: float  # K
    weights: np.ndarray  # of the logistic function


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> ToxicityModel:
    """Learn from ``docs``; ``labels`` must hold training labels only. An id with several labels is toxic if any is."""
    labels = labels.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
    labels = labels.groupBy(F.col(id_column).alias("_id")).agg(F.max(F.col(label_column).cast("int")).alias("_toxic"))
    plain = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    labelled = plain.join(broadcast_if_small(labels), "_id", "left")
    counts = _counts(labelled)
    model = ToxicityModel(*_word_model(counts), np.zeros(3))
    sample = labelled.where("_toxic IS NOT NULL").orderBy(F.xxhash64("_id"), "_id", F.xxhash64("_text")).limit(SAMPLE)
    rows = score(sample, model, "_text").select("_toxic", "toxic_strongest", "toxic_total").toArrow()
    model.weights = _logistic(np.stack([rows["toxic_strongest"].to_numpy(), rows["toxic_total"].to_numpy()], axis=1), rows["_toxic"].to_numpy())
    return model


def score(docs: DataFrame, model: ToxicityModel, text_column: str = "text") -> DataFrame:
    """``docs`` with ``toxic_score`` (0 to 1) and ``toxic_passages`` of code points ``(start, stop, score, expected)``.

    ``toxic_strongest`` and ``toxic_total`` are the evidence it is made of: of
    the best passage, and of all significant ones together. A null text is
    empty and scores what the model gives to text without any passage. Columns
    of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = T.StructType.fromDDL(ADDED)
    packed = docs.drop(*[c for c in added.names if c != text_column]).select(F.struct("*").alias("_row"), F.col(text_column).alias("_text"))
    fields = [("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]
    names = [f[0] for f in fields]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for first, data, offsets in utf8_slices(batch["_text"]):
                runs = letter_runs(data, offsets)
                scores = own.scores[_buckets(runs)]
                evidence, passages = [], []
                for a, b, place in zip(runs["words"][:-1].tolist(), runs["words"][1:].tolist(), runs["places"].tolist()):
                    strongest, total, found = _passages(own, scores[a:b])
                    evidence.append((strongest, total))
                    passages.append([
                        dict(zip(names, (int(runs["begin"][a + i]) - place, int(runs["stop"][a + j - 1]) - place, value, expected)))
                        for i, j, value, expected in found
                    ])
                x = np.array(evidence)
                columns = [pa.array(_probability(own.weights, x)), pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(passages, pa.list_(pa.struct(fields)))]
                yield pa.RecordBatch.from_arrays([batch["_row"].slice(first, len(x)), *columns], names=["_row", *added.names])

    schema = T.StructType([packed.schema["_row"], *added.fields])
    return packed.mapInArrow(lean(scan), schema).select("_row.*", *added.names)


def _counts(labelled: DataFrame) -> np.ndarray:
    """``[3, BUCKETS]``: in how many clean, toxic and other texts each word occurs; the last row counts all."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(3 * BUCKETS, np.int64)
        for batch in batches:
            # Clean, toxic, or unlabelled: the last are counted for the prior only.
            kind = np.array([2 if x is None else min(max(x, 0), 1) for x in batch["_toxic"].to_pylist()], np.int64)
            for first, data, offsets in utf8_slices(batch["_text"]):
                runs = letter_runs(data, offsets)
                text = np.repeat(np.arange(len(offsets) - 1), np.diff(runs["words"]))
                # A word counts once per text: repeating it is no further evidence.
                once = np.unique(text * BUCKETS + _buckets(runs))
                counts += np.bincount(kind[first + once // BUCKETS] * BUCKETS + once % BUCKETS, minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["cell", "n"])

    sums = labelled.select("_text", "_toxic").mapInArrow(lean(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(3 * BUCKETS)
    counts[sums["cell"].to_numpy()] = sums["n"].to_numpy()
    counts = counts.reshape(3, BUCKETS)
    counts[2] += counts[0] + counts[1]
    return counts


def _buckets(runs: dict[str, np.ndarray]) -> np.ndarray:
    return (letter_word_hashes(runs) >> np.uint64(46)).astype(np.int64)


def _word_model(counts: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Scores per bucket, and the extreme-value law of clean text."""
    clean, toxic, every = counts
    prior = PRIOR * (every + 0.5) / (every.sum() + 0.5 * BUCKETS)
    odds = lambda y: np.log(y + prior) - np.log(y.sum() + PRIOR - y - prior)
    ratio = odds(toxic) - odds(clean)
    deviation = np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
    scores = np.where(np.abs(ratio) >= DEVIATIONS * deviation, ratio, 0.0) - DRIFT
    share = (clean + prior) / (clean + prior).sum()
    rate = _rate(scores, share)
    # K for sparse high scores: words that can begin a segment, and how far its score overshoots.
    positive = scores > 0
    overshoot = (share[positive] * np.exp(rate * scores[positive])).sum() if positive.any() else 1.0
    return scores.astype(np.float32), rate, float(min(1.0, max(overshoot, 1e-3)))


def _rate(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive solution of sum(share * exp(rate * scores)) = 1."""
    if not (scores > 0).any():
        return 1.0
    low, high = 1e-6, 1.0
    excess = lambda r: float((share * np.exp(np.minimum(r * scores, 500))).sum()) - 1
    if excess(low) >= 0:
        return low
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, stop, score)`` in linear time, left to right."""
    total = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    segments: list[tuple[int, int, float, float]] = []  # start, stop, sums before and after
    # smaller[i]: the nearest segment to the left whose sum before is less.
    smaller: list[int] = []
    for i in np.flatnonzero(scores > 0).tolist():
        start, stop, before, after = i, i + 1, float(total[i]), float(total[i + 1])
        while True:
            j = len(segments) - 1
            while j >= 0 and segments[j][2] >= before:
                j = smaller[j]
            if j < 0 or segments[j][3] >= after:
                break
            start, before = segments[j][0], segments[j][2]
            del segments[j:], smaller[j:]
        segments.append((start, stop, before, after))
        smaller.append(j)
    return [(start, stop, after - before) for start, stop, before, after in segments]


def _passages(model: ToxicityModel, scores: np.ndarray) -> tuple[float, float, list[tuple[int, int, float, float]]]:
    """The strongest segment's and all significant segments' evidence against chance, and these segments."""
    n = len(scores)
    strongest, total, passages = 0.0, 0.0, []
    for start, stop, value in maximal_segments(scores):
        evidence = model.rate * value - np.log(model.scale * max(n, 1))
        strongest = max(strongest, evidence)
        expected = float(np.exp(min(-evidence, 700.0)))
        if expected < SIGNIFICANT:
            total += evidence
            passages.append((start, stop, value, expected))
    return float(strongest), float(np.log1p(total)), passages


def _probability(weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights by Newton's method, with a little shrinkage; without labels everything is clean."""
    if not len(y) or y.min() == y.max():
        return np.array([20.0 if len(y) and y[0] else -20.0, 0.0, 0.0])
    x1 = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    weights = np.zeros(x1.shape[1])
    for _ in range(50):
        p = _probability(weights, x)
        slope = x1.T @ (y - p) - 1e-2 * weights
        bend = (x1 * (p * (1 - p))[:, None]).T @ x1 + 1e-2 * np.eye(x1.shape[1])
        step = np.linalg.solve(bend, slope)
        weights = weights + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return weights
