"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, documents at large the unlabelled ones: nothing is
taken to be clean because nobody marked it. With class prior ``p`` the risk of a score ``g`` is
p * E_pos[loss(g)] + max(0, E_unl[loss(-g)] - p * E_pos[loss(-g)]): the part of the unlabelled risk
that positives among the unlabelled account for is taken off, and the rest may not go below zero,
else its gradient is reversed. Three linear numpy classifiers, one on all features and one on each
half of them, are averaged.

Features are the words of a text and their beginnings of three to seven bytes, as sets. Those
that positives show much more often than the unlabelled are chosen from counts made by Spark.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import (
    adam,
    bounded_sample,
    held_out,
    sigmoid,
    text_batches,
    training_labels,
    whole_text,
)
from clicktide.session import materialize

#: Documented bounds of the training sample and of the model.
MAX_POSITIVE, MAX_UNLABELLED, MAX_FEATURES = 4000, 6000, 2048
#: A chosen feature is at least so many standard errors more frequent among positives, and its lift
#: (log ratio of the frequencies) has this share of log(1 / prior), the lift of a feature that
#: positives alone show, for the unlabelled hold positives too.
MIN_DEVIATIONS, MIN_LIFT_SHARE = 5.0, 0.8
BEGINNINGS = (3, 4, 5, 6, 7)  # bytes; below 9, so that no word begins like a mark
LONGEST_WORD = 64  # longer words give beginnings only
THRESHOLD = 0.5
STEPS, RATE, WEIGHT_DECAY = 250, 0.05, 1e-4
SAMPLE_PARTITIONS = 16  # of the bounded sample, which may come from any number of splits
_SEED = 7
_SPACED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> set[bytes]:
    """Distinct words in lower case, cut at blanks and ASCII punctuation, as UTF-8."""
    return set(text.lower().encode("utf-8").translate(_SPACED).split())


def features(text: str) -> set[bytes]:
    """Words, and beginnings of words marked by a first byte that tells their length."""
    words = words_of(text)
    found = {w for w in words if len(w) <= LONGEST_WORD}
    for n in BEGINNINGS:
        found.update([bytes([n]) + w[:n] for w in words if len(w) > n])
    return found


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    positive, unlabelled = Counter(), Counter()
    for batch in batches:
        for text, is_positive in zip(
            batch.column("_text").to_pylist(), batch.column("positive").to_pylist()
        ):
            (positive if is_positive else unlabelled).update(features(text))
    names = list(positive)  # a feature that no positive shows is never chosen
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.binary()),
            pa.array([positive[n] for n in names], pa.int64()),
            pa.array([unlabelled[n] for n in names], pa.int64()),
        ],
        ["feature", "n_positive", "n_unlabelled"],
    )
    rest = [n for n in unlabelled if n not in positive]
    for at in range(0, len(rest), 50_000):
        part = rest[at : at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.binary()),
                pa.array([0] * len(part), pa.int64()),
                pa.array([unlabelled[n] for n in part], pa.int64()),
            ],
            ["feature", "n_positive", "n_unlabelled"],
        )


class Model:
    """Weights of the averaged classifiers; ``weights`` maps a feature to its place."""

    def __init__(self, names: list[bytes], weights: np.ndarray, bias: np.ndarray) -> None:
        self.names, self.weights, self.bias = names, weights, bias
        self.place = {n: i for i, n in enumerate(names)}
        self.words = {n for n in names if n[0] not in BEGINNINGS}
        self.beginnings = {n: {x[1:] for x in names if x[0] == n} for n in BEGINNINGS}

    def places(self, text: str) -> list[int]:
        words = words_of(text)
        found = [self.place[w] for w in words & self.words]
        for n, known in self.beginnings.items():
            if known:
                begun = {w[:n] for w in words if len(w) > n}
                found += [self.place[bytes([n]) + b] for b in begun & known]
        return found

    def score(self, text: str) -> float:
        return float(sigmoid(self.weights[:, self.places(text)].sum(axis=1) + self.bias).mean())


def nn_pu_gradient(
    params: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float
) -> np.ndarray:
    """Gradient of the non-negative risk with logistic loss; the last parameter is the bias."""
    weights = params[:-1].astype(positive.dtype)
    g_pos, g_unl = positive @ weights + params[-1], unlabelled @ weights + params[-1]
    p_pos, p_unl = sigmoid(g_pos), sigmoid(g_unl)
    # d loss(g) = p - 1 and d loss(-g) = p for the logistic loss.
    as_positive = _mean_gradient(positive, p_pos - 1) * prior
    corrected = _mean_gradient(unlabelled, p_unl) - _mean_gradient(positive, p_pos) * prior
    negative_risk = np.logaddexp(0, g_unl).mean() - prior * np.logaddexp(0, g_pos).mean()
    gradient = as_positive + corrected if negative_risk >= 0 else -corrected
    gradient[:-1] += WEIGHT_DECAY * params[:-1]
    return gradient


def _mean_gradient(rows: np.ndarray, slope: np.ndarray) -> np.ndarray:
    slope = slope.astype(rows.dtype)
    return np.append(slope @ rows, slope.sum()).astype(float) / max(len(rows), 1)


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    params = np.zeros(positive.shape[1] + 1)
    params[-1] = np.log(prior / (1 - prior))
    for params in adam(params, lambda p: nn_pu_gradient(p, positive, unlabelled, prior), STEPS, RATE):
        pass
    return params


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from training folds only: labels of held-out rows are never read, and held-out
    documents are not among the unlabelled. Without a positive every score is the prior."""
    known = training_labels(labels, "toxic")
    row = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    prior = float(np.clip(((row[1] or 0) + 1) / (row[0] + 2), 1e-3, 0.5))
    chosen = bounded_sample(known.where("label = 1").select("doc_id"), MAX_POSITIVE, _SEED)
    at_large = bounded_sample(
        docs.where(~held_out()).select(F.col("doc_id").cast("bigint")), MAX_UNLABELLED, _SEED + 1
    )
    picked = (
        chosen.select("doc_id", F.lit(True).alias("positive"))
        .unionByName(at_large.select("doc_id", F.lit(False).alias("positive")))
        .distinct()
    )
    text_batches(docs.sparkSession)
    # At most MAX_POSITIVE + MAX_UNLABELLED ids: safe to broadcast.
    sample = materialize(
        docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("_text")).join(
            F.broadcast(picked), "doc_id"
        ).repartition(SAMPLE_PARTITIONS),
        "toxicity-sample",
    )
    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_pos, n_unl = sizes.get(True, 0), sizes.get(False, 0)
    names: list[bytes] = []
    if n_pos and n_unl:
        counts = (
            sample.select("_text", "positive")
            .mapInArrow(_count_features, "feature binary, n_positive bigint, n_unlabelled bigint")
            .groupBy("feature")
            .agg(F.sum("n_positive").alias("p"), F.sum("n_unlabelled").alias("u"))
        )
        p, u = F.col("p"), F.col("u")
        lift = F.log((p + 0.1) / n_pos) - F.log((u + 0.1) / n_unl)
        pooled = (p + u) / (n_pos + n_unl)
        spread = F.sqrt(pooled * (1 - pooled) * (1 / n_pos + 1 / n_unl))
        rows = (
            counts.where((p >= 2) & (pooled < 1) & (lift >= -MIN_LIFT_SHARE * np.log(prior)))
            .withColumn("deviations", (p / n_pos - u / n_unl) / spread)
            .where(F.col("deviations") >= MIN_DEVIATIONS)
            .orderBy(F.col("deviations").desc(), "feature")
            .limit(MAX_FEATURES)
            .collect()
        )
        names = [bytes(r["feature"]) for r in rows]
    if not names:
        return Model([], np.zeros((1, 0)), np.array([np.log(prior / (1 - prior))]))
    blank = Model(names, np.zeros((1, len(names))), np.zeros(1))
    matrix = {True: [], False: []}
    for is_positive, places in _feature_places(sample, blank):
        matrix[is_positive].append(places)
    weights, biases = [], []
    halves = [np.arange(len(names)) % 2 == k for k in (0, 1)] + [np.ones(len(names), bool)]
    for used in halves:
        columns = np.flatnonzero(used)
        positive, unlabelled = (_dense(matrix[k], len(names))[:, columns] for k in (True, False))
        params = train(positive, unlabelled, prior)
        full = np.zeros(len(names))
        full[columns] = params[:-1]
        weights.append(full)
        biases.append(params[-1])
    return Model(names, np.array(weights), np.array(biases))


def _feature_places(sample: DataFrame, model: Model) -> list[tuple[bool, list[int]]]:
    """Chosen features of each sampled document; bounded by the sample and ``MAX_FEATURES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [model.places(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("positive"), pa.array(places, pa.list_(pa.int32()))],
                ["positive", "places"],
            )

    found = sample.select("_text", "positive").mapInArrow(run, "positive boolean, places array<int>")
    return [(r["positive"], r["places"]) for r in found.toLocalIterator()]


def _dense(places: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(places), width), dtype=np.float32)
    for row, found in zip(out, places):
        row[found] = 1.0
    return out


def score(model: Model) -> Column:
    """Toxicity in 0..1 of the whole ``text``; null counts as empty."""

    @F.pandas_udf("double")
    def scores(texts):
        return texts.map(model.score).astype("float64")

    return scores(whole_text())


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null and empty texts get the score of a text without features; rows that repeat a doc_id, or
    have none, are scored like others (without an id they count as held out). Columns other than
    doc_id and text are ignored.
    """
    text_batches(docs.sparkSession)
    scored = docs.select(F.col("doc_id").cast("bigint"), score(fit(docs, labels)).alias("score"))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns of the others stay as they are."""
    text_batches(docs.sparkSession)
    return docs.where(score(fit(docs, labels)) < THRESHOLD)
