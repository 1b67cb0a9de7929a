"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's state depends on features of the line and of the lines before
and after it, and on the states beside it. Training starts with every line marked like its document;
then, in documents marked bad, lines that the model finds good beside worse ones are marked good,
and the model is trained anew. A document's quality is the mean of its lines' forward-backward
marginals, weighted by their lengths and calibrated on the training documents.

Features are counted with numpy over whole batches of lines, and forward-backward runs over many
documents at a time.
"""

from __future__ import annotations

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

#: Documented bounds of the training sample: documents of each label, and lines of a document;
#: longer documents do not train the model (all are scored).
MAX_DOCUMENTS, MAX_LINES = 1500, 1000
THRESHOLD = 0.3
STEPS, RATE, WEIGHT_DECAY, ROUNDS = 150, 0.05, 1e-3, 3
_SEED = 11
_BATCH_BYTES = 1 << 21

_CLASSES = ("lower", "upper", "digit", "blank", "stop", "symbol", "bang", "bar", "other")
_NAMES = (
    *[f"share_{c}" for c in _CLASSES],
    "repeats_word", "same_words", "log_words", "word_length", "long_words", "empty", "repeats_line",
)
WIDTH = len(_NAMES)


def _byte_classes() -> np.ndarray:
    classes = np.full(256, _CLASSES.index("other"), dtype=np.uint8)
    for b in range(128):
        c = chr(b)
        kind = (
            "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit()
            else "blank" if c.isspace() else "stop" if c in ".,;:?'\"-()" else "bang" if c == "!"
            else "bar" if c == "|" else "symbol"
        )
        classes[b] = _CLASSES.index(kind)
    return classes


_CLASS_OF = _byte_classes()


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, sizes in bytes, first line of each text and the end) of all lines of ``texts``.

    A text has one line more than line ends; an empty text has one empty line.
    """
    data = np.frombuffer("\n".join(texts).encode("utf-8") + b"\n", dtype=np.uint8)
    ends = np.flatnonzero(data == 10)
    begins = np.concatenate([[0], ends[:-1] + 1])
    sizes = ends - begins
    n = len(ends)
    lines_of = np.array([t.count("\n") + 1 for t in texts])
    first = np.concatenate([[0], np.cumsum(lines_of)])
    safe = np.maximum(sizes, 1)[:, None]
    out = np.zeros((n, WIDTH), dtype=np.float32)
    kind = _CLASS_OF[data]
    for c in range(len(_CLASSES)):
        # The line end itself is a blank; it is taken off.
        total = np.add.reduceat(kind == c, begins, dtype=np.int64)
        out[:, c] = total - (1 if _CLASSES[c] == "blank" else 0)
    out[:, : len(_CLASSES)] /= safe
    # Words: runs of bytes that are no blanks, told apart by a sum of mixed bytes and positions.
    word = kind != _CLASSES.index("blank")
    edge = np.diff(word.astype(np.int8), prepend=0)
    w_begin, w_end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(w_begin):
        line_of = np.searchsorted(ends, w_begin)
        code = _word_codes(data, w_begin, w_end)
        count = np.bincount(line_of, minlength=n)
        some = np.maximum(count, 1)
        again = np.zeros(len(code), dtype=bool)
        again[1:] = (code[1:] == code[:-1]) & (line_of[1:] == line_of[:-1])
        out[:, 9] = np.bincount(line_of, again, minlength=n) / some
        order = np.lexsort((code, line_of))
        same = np.zeros(len(code), dtype=bool)
        same[1:] = (np.diff(code[order]) == 0) & (np.diff(line_of[order]) == 0)
        out[:, 10] = np.bincount(line_of[order], same, minlength=n) / some
        length = w_end - w_begin
        out[:, 11] = np.log1p(count) / 5
        out[:, 12] = np.bincount(line_of, length, minlength=n) / some / 10
        out[:, 13] = np.bincount(line_of, length > 25, minlength=n) / some
        total = np.zeros(n, dtype=np.uint64)
        turn = np.arange(len(code), dtype=np.uint64) - np.repeat(
            np.cumsum(count) - count, count
        ).astype(np.uint64)
        np.add.at(total, line_of, code * (2 * turn + np.uint64(1)))
        doc_of = np.repeat(np.arange(len(texts)), lines_of)
        order = np.lexsort((np.arange(n), total, doc_of))
        twin = np.zeros(n, dtype=bool)
        twin[1:] = (np.diff(doc_of[order]) == 0) & (total[order][1:] == total[order][:-1])
        out[order, 15] = twin & (count[order] > 0)
    out[:, 14] = sizes == 0
    return out, sizes, first


def _word_codes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit code for each word, from its bytes and their places."""
    place = np.arange(len(data)) - np.repeat(
        np.concatenate([[0], begins]), np.diff(np.concatenate([[0], begins, [len(data)]]))
    )
    with np.errstate(over="ignore"):
        mixed = (data.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 1023]
        mixed ^= mixed >> np.uint64(29)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed, dtype=np.uint64)])
    return sums[ends] - sums[begins]


_POWERS = np.cumprod(np.full(1024, 0x9E3779B97F4A7C15, dtype=np.uint64), dtype=np.uint64)


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Own, previous and next line's features and a constant; zeros beyond the ends of a text."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.hstack([x, before, after, np.ones((len(x), 1), x.dtype)])


class Field:
    """Parameters: a weight per feature for the good state, and one per pair of states."""

    def __init__(self, width: int, params: np.ndarray | None = None) -> None:
        self.width = width
        self.params = np.zeros(width + 4) if params is None else params

    def marginals(self, x: np.ndarray, first: np.ndarray, pairs: bool = False):
        """Probability of the good state for each line; with ``pairs`` expected transitions too."""
        good = x @ self.params[: self.width].astype(x.dtype)
        return chain_marginals(good.astype(float), self.params[self.width :].reshape(2, 2), first, pairs)


def chain_marginals(good: np.ndarray, turn: np.ndarray, first: np.ndarray, pairs: bool = False):
    """Forward-backward over all chains side by side, longest first; bad has potential zero."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    start, length = first[:-1][order], length[order]
    steps = int(length[0]) if len(length) else 0
    # At step t the first active[t] chains, in that order, have a line.
    active = np.searchsorted(-length, -np.arange(steps), side="left")
    state = np.zeros((len(good), 2))
    state[:, 1] = good
    forward, backward = np.empty_like(state), np.zeros_like(state)
    for t in range(steps):
        at = start[: active[t]] + t
        if t == 0:
            forward[at] = state[at]
        else:
            p = forward[at - 1]
            forward[at] = state[at] + np.logaddexp(
                p[:, :1] + turn[0][None], p[:, 1:] + turn[1][None]
            )
    for t in range(steps - 2, -1, -1):
        at = start[: active[t + 1]] + t
        nxt = state[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(nxt[:, :1] + turn[:, 0], nxt[:, 1:] + turn[:, 1])
    both = forward + backward
    total = np.logaddexp(both[:, 0], both[:, 1])
    p_good = np.exp(both[:, 1] - total)
    if not pairs:
        return p_good
    inner = np.ones(len(good), dtype=bool)
    inner[first[1:] - 1] = False
    at = np.flatnonzero(inner)
    joint = forward[at][:, :, None] + turn[None] + (state + backward)[at + 1][:, None, :]
    expected = np.exp(joint - total[at][:, None, None]).sum(axis=0)
    return p_good, expected


def train_field(x: np.ndarray, first: np.ndarray, marked: np.ndarray, weight: np.ndarray) -> Field:
    """Maximum conditional likelihood of the marked states (1 good), weighted by document."""
    field = Field(x.shape[1])
    inner = np.ones(len(x), dtype=bool)
    inner[first[1:] - 1] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (marked[at].astype(int), marked[at + 1].astype(int)), 1)

    def gradient(params: np.ndarray) -> np.ndarray:
        good, expected = Field(field.width, params).marginals(x, first, pairs=True)
        slope = ((good - marked) * weight).astype(x.dtype) @ x
        turn = (expected - seen).ravel() / max(len(at), 1)
        return np.concatenate([slope.astype(float), turn]) + WEIGHT_DECAY * params

    for field.params in adam(field.params, gradient, STEPS, RATE):
        pass
    return field


class Model:
    def __init__(self, field: Field | None, slope: float, offset: float) -> None:
        self.field, self.slope, self.offset = field, slope, offset

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.field is None:
            return np.full(len(texts), sigmoid(np.array(self.offset)))
        out, part, size = [], [], 0
        for text in [*texts, None]:
            if part and (text is None or size + len(text) > _BATCH_BYTES):
                x, sizes, first = line_features(part)
                good = self.field.marginals(with_neighbours(x, first), first)
                out.append(document_logit(good, sizes, first))
                part, size = [], 0
            if text is not None:
                part.append(text)
                size += len(text)
        return sigmoid(self.slope * np.concatenate([*out, []]) + self.offset)


def document_logit(good: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Log-odds of the mean marginal of each document's lines, weighted by their lengths."""
    weight = sizes + 1.0
    mean = np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.log(mean / (1 - mean))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from labels of the training folds only. Where these hold one label or none, every
    score is the smoothed share of good documents among them."""
    known = training_labels(labels, "quality")
    row = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    n, n_good = row[0], row[1] or 0
    prior = float(np.log((n_good + 1) / (n - n_good + 1)))
    picked = bounded_sample(known.where("label = 0"), MAX_DOCUMENTS, _SEED).unionByName(
        bounded_sample(known.where("label = 1"), MAX_DOCUMENTS, _SEED)
    )
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            x, sizes, first = line_features(texts)
            parts = [slice(a, b) for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array([x[p].tobytes() for p in parts], pa.binary()),
                    pa.array([sizes[p].tolist() for p in parts], pa.list_(pa.int64())),
                ],
                ["doc_id", "label", "x", "sizes"],
            )

    # At most 2 * MAX_DOCUMENTS ids: safe to broadcast.
    joined = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("_text")).join(
        F.broadcast(picked), "doc_id"
    )
    short = F.size(F.split("_text", "\n")) <= MAX_LINES
    sample = materialize(
        joined.where(short).select("doc_id", "label", "_text").mapInArrow(
            run, "doc_id bigint, label int, x binary, sizes array<bigint>"
        ),
        "quality-sample",
    )
    rows = sorted(sample.toLocalIterator(), key=lambda r: (r["doc_id"], bytes(r["x"])))
    label = np.array([r["label"] for r in rows])
    if len(set(label.tolist())) < 2:
        return Model(None, 0.0, prior)
    sizes = np.concatenate([r["sizes"] for r in rows])
    first = np.concatenate([[0], np.cumsum([len(r["sizes"]) for r in rows])])
    x = np.concatenate([np.frombuffer(r["x"], np.float32).reshape(-1, WIDTH) for r in rows])
    x = with_neighbours(x, first)
    count = np.diff(first)
    of_line = np.repeat(np.arange(len(rows)), count)
    share = {k: 0.5 / max((label == k).sum(), 1) for k in (0, 1)}
    weight = np.where(label == 1, share[1], share[0])[of_line] / count[of_line]
    bad_document = label[of_line] == 0
    marked = 1.0 - bad_document
    for _ in range(ROUNDS):
        field = train_field(x, first, marked, weight)
        good = field.marginals(x, first)
        # In a bad document some line is bad: the worst, and all that are not clearly good.
        worst = np.minimum.reduceat(good, first[:-1])[of_line]
        marked = np.where(bad_document, (good > 0.5) & (good > worst + 0.2), 1.0).astype(float)
    logit = document_logit(field.marginals(x, first), sizes, first)
    slope, offset = _calibrate(logit, label, n_good, n)
    return Model(field, slope, offset)


def _calibrate(logit: np.ndarray, label: np.ndarray, n_good: int, n: int) -> tuple[float, float]:
    """Logistic map of the documents' log-odds; the sample is weighted back to the true shares."""
    true = {1: (n_good + 1) / (n + 2), 0: (n - n_good + 1) / (n + 2)}
    weight = np.where(label == 1, true[1] / (label == 1).sum(), true[0] / (label == 0).sum())
    params = np.array([1.0, 0.0])

    def gradient(p: np.ndarray) -> np.ndarray:
        slope = (sigmoid(p[0] * logit + p[1]) - label) * weight
        return np.array([(slope * logit).sum(), slope.sum()]) + 1e-4 * p

    for params in adam(params, gradient, 800, 0.05):
        pass
    return float(max(params[0], 0.0)), float(params[1])


def score(model: Model) -> Column:
    """Quality in 0..1 of the whole ``text``; null counts as empty."""

    @F.pandas_udf("double")
    def scores(texts):
        import pandas as pd

        return pd.Series(model.scores(texts.tolist()), dtype="float64")

    return scores(whole_text())


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null and empty texts count as one empty line; rows that repeat a doc_id, or have none, are
    scored like others (without an id they count as held out). Columns other than doc_id and text
    are ignored.
    """
    text_batches(docs.sparkSession)
    scored = docs.select(F.col("doc_id").cast("bigint"), score(fit(docs, labels)).alias("score"))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted bad; all columns of the others stay as they are."""
    text_batches(docs.sparkSession)
    return docs.where(score(fit(docs, labels)) >= THRESHOLD)
