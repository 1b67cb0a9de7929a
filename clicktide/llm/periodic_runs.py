"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of consecutive words whose smallest period ``q`` fits into it four times, in six
words at least, and that no neighbouring word extends. The words of many documents are joined by
separators that occur once. Rank doubling sorts all suffixes as deep as the longest block needs, so
every dyadic block (``size`` words from a multiple of ``size``) is an interval of the suffix array.

A run of period ``q`` holds, with its shift by ``q``, an aligned block of the ``size`` with
``2/3 size <= q < 4/3 size``. The window of shifts is less than one block wide, so the occurrences
of the block in it form one arithmetic progression; its first, second and last term come from
range-successor queries on a wavelet matrix over the suffix array. Up to two terms are candidate
periods. A longer progression means that the block itself has the progression's step as period;
then the starts and the ends of the two stretches with that step give the candidates, for a run
that breaks at neither would have the step as period. Common extensions to both sides verify each.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import text_batches, whole_text

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIN_WORDS, MIN_PERIODS = 6, 4
#: Words indexed together; a longer document is indexed on its own.
INDEX_WORDS = 1 << 18


class WaveletMatrix:
    """Order statistics over any interval of an array of non-negative integers."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels: list[tuple[int, np.ndarray]] = []
        for bit in range(max(int(values.max(initial=0)).bit_length(), 1) - 1, -1, -1):
            zero = (values >> bit & 1) == 0
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.levels.append((bit, before))
            values = np.concatenate([values[zero], values[~zero]])

    def count_below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values in ``[low, high)`` are smaller than ``bound``."""
        found, size = np.zeros(len(low), np.int64), high - low
        beyond = bound >> (self.levels[0][0] + 1) > 0
        for bit, before in self.levels:
            one = bound >> bit & 1 == 1
            a, b = before[low], before[high]
            found += np.where(one, b - a, 0)
            low = np.where(one, before[-1] + low - a, a)
            high = np.where(one, before[-1] + high - b, b)
        return np.where(beyond, size, found)

    def kth(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The ``k``-th smallest value in ``[low, high)``, counted from 0."""
        found = np.zeros(len(low), np.int64)
        for bit, before in self.levels:
            a, b = before[low], before[high]
            zeros = b - a
            one = k >= zeros
            found |= np.where(one, 1 << bit, 0)
            k = np.where(one, k - zeros, k)
            low = np.where(one, before[-1] + low - a, a)
            high = np.where(one, before[-1] + high - b, b)
        return found


class SuffixIntervals:
    """Suffixes sorted by rank doubling; ``ranks[k][p]`` is where the interval of the suffixes that
    share the ``2**k`` numbers from ``p`` begins, ``sizes[k][p]`` how many these are."""

    def __init__(self, text: np.ndarray, longest: int) -> None:
        n = len(text)
        self.order = np.argsort(text, kind="stable")
        ordered = text[self.order]
        begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[:n])
        rank = np.empty(n, np.int64)
        rank[self.order] = np.repeat(begins, np.diff(np.append(begins, n)))
        #: Distance to the next equal number, n if there is none.
        self.next = np.full(n, n, np.int64)
        again = ordered[1:] == ordered[:-1]
        self.next[self.order[:-1][again]] = (self.order[1:] - self.order[:-1])[again]
        self.ranks: list[np.ndarray] = []
        self.shared: list[np.ndarray] = []
        length = 1
        while True:
            size = np.bincount(rank, minlength=n)
            self.ranks.append(rank.astype(np.int32))
            self.shared.append(size.astype(np.int32))
            open_at = np.flatnonzero(size[rank[self.order]] > 1)
            if not len(open_at) or 2 * length > longest:
                return
            suffix = self.order[open_at]
            after = suffix + length
            second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
            key = rank[suffix] * (n + 1) + second
            by_key = np.argsort(key, kind="stable")
            suffix, key = suffix[by_key], key[by_key]
            self.order[open_at] = suffix
            fresh = np.concatenate([[True], key[1:] != key[:-1]])
            rank = rank.copy()
            rank[suffix] = np.maximum.accumulate(np.where(fresh, open_at, 0))
            length *= 2

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers from ``a`` on equal those from ``b`` on (a < b)."""
        return self._extend(a, b, forward=True)

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers before ``a`` equal those before ``b`` (a < b)."""
        return self._extend(a, b, forward=False)

    def _extend(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        n, top = len(self.order), len(self.ranks) - 1
        total = np.zeros(len(a), np.int64)
        for k in range(top, -1, -1):
            step, rank = 1 << k, self.ranks[k]
            at = np.arange(len(a))
            while len(at):
                if forward:
                    x, y = a[at] + total[at], b[at] + total[at]
                    at, x, y = (v[y < n] for v in (at, x, y))
                else:
                    x, y = a[at] - total[at] - step, b[at] - total[at] - step
                    at, x, y = (v[x >= 0] for v in (at, x, y))
                at = at[rank[x] == rank[y]]
                total[at] += step
                if k < top:
                    break
        return total


def find_runs(text: np.ndarray, longest: int) -> np.ndarray:
    """(start, length, period) rows of all runs of ``text``, in the order of start and period.

    ``longest`` bounds the length of a run, as separators do between documents."""
    if longest < MIN_WORDS:
        return np.zeros((0, 3), np.int64)
    suffixes = SuffixIntervals(text, longest * 3 // 8)
    starts, periods = [], []
    matrix = None
    for k, (rank, shared) in enumerate(zip(suffixes.ranks, suffixes.shared)):
        size = 1 << k
        least, most = (2 * size + 2) // 3, (4 * size - 1) // 3
        block = np.arange(0, len(text), size)
        low = rank[block].astype(np.int64)
        # A block meets itself only where it occurs twice and its first word comes again.
        block = block[(shared[low] > 1) & (suffixes.next[block] <= most)]
        if not len(block):
            continue
        matrix = matrix or WaveletMatrix(suffixes.order)
        low = rank[block].astype(np.int64)
        high = low + shared[low]
        first = matrix.count_below(low, high, block + least)
        beyond = matrix.count_below(low, high, block + most + 1)
        hit = np.flatnonzero(beyond > first)
        block, low, high, first, beyond = (v[hit] for v in (block, low, high, first, beyond))
        terms = beyond - first
        one = matrix.kth(low, high, first)
        last = matrix.kth(low, high, beyond - 1)
        few = terms <= 2
        starts += [block[few], block[terms == 2]]
        periods += [(one - block)[few], (last - block)[terms == 2]]
        block, low, high, first, one = (v[~few] for v in (block, low, high, first, one))
        if len(block):
            step = matrix.kth(low, high, first + 1) - one
            here = block - suffixes.common_before(block, block + step)
            there = one - suffixes.common_before(one, one + step)
            here_end = block + suffixes.common(block, block + step)
            there_end = one + suffixes.common(one, one + step)
            for shift in (there - here, there_end - here_end):
                fits = (shift >= least) & (shift <= most)
                starts.append(block[fits])
                periods.append(shift[fits])
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    period = np.concatenate(periods) if periods else start
    begin = start - suffixes.common_before(start, start + period)
    end = start + period + suffixes.common(start, start + period)
    length = end - begin
    found = np.stack([begin, length, period], axis=1)[
        length >= np.maximum(MIN_WORDS, MIN_PERIODS * period)
    ]
    # A multiple of a run's period extends exactly as far as the period itself.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[new]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def rewritten(words: list[str], doc_id: int | None) -> list[str]:
    """Words of a document; of one id in ten the tail is made to repeat, as the contract says."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _summary(words: list[str], runs: np.ndarray) -> tuple:
    """Values of one document's result row behind its doc_id."""
    if not len(runs):
        return 0, None, None, None, None, _sha(""), _sha(" ".join(words))
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, runs[:, 0] + runs[:, 2], 1)
    np.add.at(covered, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(covered[:-1]) == 0
    best = None
    for run in runs.tolist():
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
    collapsed = " ".join([w for w, k in zip(words, kept.tolist()) if k])
    return len(runs), *best, 1000 * best[1] // best[2], _sha(listed), _sha(collapsed)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def document_rows(documents: list[list[str]]) -> Iterator[tuple]:
    """Summaries of documents given as words, in order; texts are indexed in groups."""
    group: list[list[str]] = []
    total = 0
    for words in documents:
        if group and total + len(words) > INDEX_WORDS:
            yield from _group_rows(group)
            group, total = [], 0
        group.append(words)
        total += len(words)
    yield from _group_rows(group)


def _group_rows(group: list[list[str]]) -> Iterator[tuple]:
    if not group:
        return
    number = {word: i for i, word in enumerate(set().union(*group))}
    first = np.cumsum([0] + [len(words) + 1 for words in group])
    text = np.empty(first[-1], np.int64)
    for i, words in enumerate(group):
        text[first[i] : first[i + 1] - 1] = list(map(number.__getitem__, words))
        text[first[i + 1] - 1] = len(number) + i
    runs = find_runs(text, max(len(words) for words in group))
    bounds = np.searchsorted(runs[:, 0], first)
    for i, words in enumerate(group):
        yield _summary(words, runs[bounds[i] : bounds[i + 1]] - [first[i], 0, 0])


_SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
    "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
)
_KINDS = [pa.int64()] * 6 + [pa.string()] * 2


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: the number of runs, the run of the greatest exponent, digests.

    Null and empty texts have no words and no runs, so start, length, period and exponent are null.
    A row without a doc_id is taken as it stands, no word of it is rewritten; rows that repeat a
    doc_id are treated one by one. Of equal exponents the smallest start, then period wins. A text
    of any length is treated whole, in one task; other columns are ignored.
    """
    names = [field.split()[0] for field in _SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = batch.column("_text").to_pylist()
            rows = document_rows([rewritten(WORD.findall(t), i) for i, t in zip(ids, texts)])
            columns = list(zip(*[(i, *row) for i, row in zip(ids, rows)])) or [[]] * len(names)
            arrays = [pa.array(c, k) for c, k in zip(columns, _KINDS)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    text_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("_text"))
    return texts.mapInArrow(run, _SCHEMA)
