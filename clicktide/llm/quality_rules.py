"""Quality rules whose cutoffs are certified to reject few good documents of any stratum.

Seven statistics of a text, higher for worse texts, are compared with cutoffs. The labelled rows of
each stratum (a language) are split by a hash. One half proposes cutoffs: level ``t`` gives every
rule the least cutoff that at most ``t`` thousandths of its good documents exceed, so stricter
levels reject supersets; before them all stands the greatest cutoff of level 0 over the strata, which
small strata can have certified. The other half is held out to certify them: with ``k`` of ``n`` good
documents rejected, a level is safe when the exact binomial probability of ``k`` or fewer at a false
rejection of ``LIMIT`` is at most ``RISK``. Levels are tested in fixed order and testing ends at the
first that fails, which needs no correction; strata are corrected for by Bonferroni. So with
probability 1 - ``RISK`` no stratum loses more than ``LIMIT`` of its good documents. Among its safe
levels a stratum takes the one that parts the proposing half best; without one it rejects nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import lgamma, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import text_batches, whole_text
from clicktide.session import materialize

LIMIT, RISK = 0.05, 0.05
#: Good documents of the proposing half, in thousandths, that may lie beyond a rule's cutoff.
LEVELS = (0, 1, 2, 4, 8, 16, 32)
#: Words of texts whose windows are compared together; a longer text is compared on its own.
GROUP_WORDS = 1 << 18
WINDOW = 8
BLANKS = " \t\n\v\f\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]+")
_CAPITAL = re.compile(r"[A-Z]+")
_MARK = re.compile(r"[!?]+")

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_capitals", "n_marks",
)


def repeated_words(texts: list[list[str]]) -> list[int]:
    """Of each text, given as words, how many words lie in windows that it holds twice or more."""
    found: list[int] = []
    group: list[list[str]] = []
    total = 0
    for words in texts:
        if group and total + len(words) > GROUP_WORDS:
            found += _repeated(group)
            group, total = [], 0
        group.append(words)
        total += len(words)
    return found + _repeated(group)


def _repeated(group: list[list[str]]) -> list[int]:
    first = np.cumsum([0] + [len(words) for words in group])
    n = int(first[-1])
    if n < WINDOW:
        return [0] * len(group)
    number = {word: i for i, word in enumerate(set().union(*group))}
    text = np.fromiter((number[w] for words in group for w in words), np.int64, n)
    of_text = np.repeat(np.arange(len(group)), np.diff(first))
    # Windows of two, four and eight words are numbered by pairs; those of other texts differ.
    rank = of_text * len(number) + text
    size = 1
    while size < WINDOW:
        base = int(rank.max()) + 1
        if base >= 1 << 31:
            rank = np.unique(rank, return_inverse=True)[1]
            base = int(rank.max()) + 1
        rank = rank[:-size] * base + rank[size:]
        size *= 2
        if size < WINDOW:
            rank = np.unique(rank, return_inverse=True)[1]
    inside = np.flatnonzero(of_text[: n - WINDOW + 1] == of_text[WINDOW - 1 :])
    _, which, times = np.unique(rank[inside], return_inverse=True, return_counts=True)
    begin = inside[times[which] > 1]
    covered = np.zeros(n + 1, np.int64)
    np.add.at(covered, begin, 1)
    np.add.at(covered, begin + WINDOW, -1)
    marked = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    return (marked[first[1:]] - marked[first[:-1]]).tolist()


def _length(pattern: re.Pattern, text: str) -> int:
    return sum(map(len, pattern.findall(text)))


def text_counts(texts: list[str]) -> list[list[int]]:
    """The columns ``COUNTS`` of some texts."""
    words = [_WORD.findall(t) for t in texts]
    lines = [[x for x in t.split("\n") if x.strip(BLANKS)] for t in texts]
    return [
        [len(w) for w in words],
        [sum(map(len, w)) for w in words],
        [_length(_SYMBOL, t) for t in texts],
        [len(x) - len(set(x)) for x in lines],
        repeated_words(words),
        [len(x) for x in lines],
        [_length(_CAPITAL, t) for t in texts],
        [_length(_MARK, t) for t in texts],
    ]


def document_counts(docs: DataFrame, stratum: Column) -> DataFrame:
    """(doc_id, stratum, COUNTS) of every row of ``docs``; the whole text is counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = text_counts(batch.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("stratum"), *[pa.array(c, pa.int64()) for c in counts]],
                ["doc_id", "stratum", *COUNTS],
            )

    text_batches(docs.sparkSession)
    columns = docs.select(
        F.col("doc_id").cast("bigint"), stratum.cast("string").alias("stratum"), whole_text().alias("_text")
    )
    return columns.mapInArrow(
        run, "doc_id bigint, stratum string, " + ", ".join(f"{c} bigint" for c in COUNTS)
    )


def base_failed() -> Column:
    """The rules that hold whatever the labels say."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rule_values() -> Column:
    """Array of the rules' statistics in thousandths; higher is worse. Needs a word."""
    per = {
        "n_symbols": "n_words", "n_repeat_words": "n_words", "n_dup_lines": "n_lines",
        "n_capitals": "word_chars", "n_marks": "n_words", "word_chars": "n_words",
    }
    values = [F.expr(f"1000 * {top} div {bottom}") for top, bottom in per.items()]
    return F.array(*values, -values[-1])


def binomial_tail(n: int, k: int, p: float) -> float:
    """P(X <= k) of a binomial X; 1 when k is at the mean or above, where it is about a half."""
    if k >= n * p:
        return 1.0
    i = np.arange(k, dtype=float)
    # Logarithms of the terms from k downwards, each by its ratio to the one above.
    top = lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log(1 - p)
    ratio = np.log(k - i) - np.log(n - k + 1 + i) + log((1 - p) / p)
    return float(np.exp(top + np.concatenate([[0.0], np.cumsum(ratio)])).sum())


def certified_cutoffs(
    labelled: DataFrame, limit: float = LIMIT, risk: float = RISK, levels: tuple[int, ...] = LEVELS
) -> DataFrame:
    """(stratum, level, cutoffs) of the strata that may reject; ``labelled`` has the columns
    stratum, label, values (array of statistics) and proposing (boolean).

    Python sees a row per stratum and level; only the number of strata reaches the driver.
    """
    good = labelled.where("proposing AND label = 1")
    by_value = (
        good.select("stratum", F.posexplode("values").alias("rule", "value"))
        .groupBy("stratum", "rule", "value")
        .agg(F.count("*").alias("n"))
    )
    # A window of distinct thousandths of one rule in one stratum, whatever the number of rows.
    whole = F.sum("n").over(_window("stratum", "rule"))
    upto = F.sum("n").over(_window("stratum", "rule", order="value"))
    above = by_value.select("stratum", "rule", "value", whole.alias("n"), (whole - upto).alias("above"))
    by_rule = (
        above.select("*", F.explode(F.array(*map(F.lit, levels))).alias("level"))
        .where(F.col("above") * 1000 <= F.col("level") * F.col("n"))
        .groupBy("stratum", "level", "rule")
        .agg(F.min("value").alias("cutoff"))
    )
    loosest = by_rule.where("level = 0").groupBy("rule").agg(F.max("cutoff").alias("cutoff"))
    pooled = by_rule.where("level = 0").drop("cutoff").join(F.broadcast(loosest), "rule")
    cutoffs = (
        by_rule.unionByName(pooled.withColumn("level", F.lit(-1)))
        .groupBy("stratum", "level")
        .agg(F.array_sort(F.collect_list(F.struct("rule", "cutoff"))).alias("_rules"))
        .select("stratum", "level", F.col("_rules.cutoff").alias("cutoffs"))
    )
    rejected = rejects().cast("int")

    def count(which: str, what: Column = F.lit(1)) -> Column:
        return F.coalesce(F.sum(F.when(F.expr(which), what)), F.lit(0))

    tested = (
        labelled.join(cutoffs, "stratum")
        .groupBy("stratum", "level")
        .agg(
            count("NOT proposing AND label = 1").alias("n"),
            count("NOT proposing AND label = 1", rejected).alias("k"),
            (
                count("proposing AND label = 0", rejected) * count("proposing AND label = 1")
                - count("proposing AND label = 1", rejected) * count("proposing AND label = 0")
            ).alias("gain"),
        )
    )
    tested = materialize(tested, "tested")
    strata = tested.where("n > 0").select("stratum").distinct().count()

    @F.pandas_udf("double")
    def tail(n: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([binomial_tail(a, b, limit) for a, b in zip(n, k)], dtype="float64")

    safe = tested.withColumn("failed", tail("n", "k") > risk / max(strata, 1))
    first_failure = F.min(F.when(F.col("failed"), F.col("level"))).over(_window("stratum"))
    chosen = (
        safe.withColumn("_stop", F.coalesce(first_failure, F.lit(max(levels) + 1)))
        .where("level < _stop AND gain > 0")
        .groupBy("stratum")
        .agg(F.max_by("level", F.struct("gain", -F.col("level"))).alias("level"))
    )
    return cutoffs.join(chosen, ["stratum", "level"])


def _window(*keys: str, order: str | None = None):
    from pyspark.sql import Window

    w = Window.partitionBy(*keys)
    return w.orderBy(order).rowsBetween(Window.unboundedPreceding, 0) if order else w


def rejects() -> Column:
    """True where one of ``values`` lies beyond its cutoff."""
    return F.exists(F.arrays_zip("values", "cutoffs"), lambda x: x["values"] > x["cutoffs"])


def proposing() -> Column:
    """True for the half of the labelled rows that proposes cutoffs; the other half certifies."""
    return F.md5(F.col("doc_id").cast("string").cast("binary")) < F.lit("8")


def judge(docs: DataFrame, labels: DataFrame, stratum: Column | None = None) -> DataFrame:
    """(doc_id, the first five COUNTS, base_failed, kept) for every row of ``docs``.

    ``stratum`` is the language of a row by default; a null is a stratum of its own. Null and empty
    texts have no words and fail the base rules. Rows that repeat a doc_id, or have none, are
    judged like others; without an id they have no label. Contradicting or null labels do not
    count. Without labels, or with too few to certify anything, all that pass the base rules are
    kept. Other columns are ignored.
    """
    stratum = F.col("lang") if stratum is None else stratum
    counts = materialize(document_counts(docs, F.coalesce(stratum.cast("string"), F.lit(""))), "counts")
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.min("quality").alias("label"), F.max("quality").alias("_high"))
        .where("label = _high")
        .select("doc_id", "label")
    )
    labelled = materialize(
        counts.where(~base_failed())
        .join(known, "doc_id")
        .select("stratum", "label", rule_values().alias("values"), proposing().alias("proposing")),
        "labelled",
    )
    cutoffs = materialize(certified_cutoffs(labelled), "cutoffs").select("stratum", "cutoffs")
    values = F.when(~F.col("base_failed"), rule_values()).alias("values")
    judged = counts.withColumn("base_failed", base_failed()).select("*", values)
    rejected = F.coalesce(rejects(), F.lit(False))
    return judged.join(cutoffs, "stratum", "left").select(
        "doc_id", *COUNTS[:5], "base_failed", (~F.col("base_failed") & ~rejected).alias("kept")
    )
