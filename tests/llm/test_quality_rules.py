import random
from fractions import Fraction
from math import comb

import pytest
from compare import mismatch
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SF, make_docs, prose  # noqa: F401
from pyspark.sql import functions as F

from clicktide.llm import queries, quality_rules


def plain_counts(text):
    """The contract, step by step, and the three counts of the other rules."""
    words, word = [], ""
    for c in text + " ":
        if c in "\x20\x09\x0a\x0b\x0c\x0d":
            words += [word] if word else []
            word = ""
        else:
            word += c
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    repeated = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if any(c not in "\x20\x09\x0a\x0b\x0c\x0d" for c in x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(repeated),
        len(lines),
        sum("A" <= c <= "Z" for c in text),
        sum(c in "!?" for c in text),
    )


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB \t\n\x0b\x1c#!É|", max_size=90), max_size=4))
def test_counts_are_the_contract(texts):
    assert list(zip(*quality_rules.text_counts(texts))) == [plain_counts(t) for t in texts]


def test_repeated_windows_over_groups(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 120))) for _ in range(60)]
    expected = [plain_counts(t)[4] for t in texts]
    assert any(expected) and not all(expected)
    assert quality_rules.text_counts(texts)[4] == expected
    monkeypatch.setattr(quality_rules, "GROUP_WORDS", 40)
    assert quality_rules.text_counts(texts)[4] == expected


@pytest.mark.parametrize("n, k", [(1, 0), (59, 0), (200, 3), (3000, 120), (40, 2), (40, 30)])
def test_binomial_tail(n, k):
    p = Fraction(1, 20)
    exact = float(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))
    found = quality_rules.binomial_tail(n, k, 0.05)
    assert found == 1.0 if k >= n * 0.05 else abs(found - exact) <= 1e-10 * exact


def labelled(spark, rows):
    return spark.createDataFrame(rows, "stratum string, label int, values array<bigint>, proposing boolean")


def cutoffs(df):
    return {r.stratum: (r.level, list(r.cutoffs)) for r in quality_rules.certified_cutoffs(df).collect()}


def test_certified_levels(spark):
    rows = []
    for i in range(400):
        # Of "a" every rule is clean; the bad ones lie far beyond. "b" has too few rows to certify.
        rows.append(("a", 1, [i // 2 % 50, 7], i % 2 == 0))
        rows.append(("a", 0, [900, 7], i % 2 == 0))
    rows += [("b", 1, [i, 9], i % 2 == 0) for i in range(20)] + [("b", 0, [900, 9], True)] * 5
    # Of "c" the held-out half looks worse than the proposing half at every level.
    rows += [("c", 1, [1000 * (i % 2) + 5, 9], i % 2 == 0) for i in range(400)]
    rows += [("c", 0, [900, 9], i % 2 == 0) for i in range(400)]
    found = cutoffs(labelled(spark, rows))
    # Of levels that part the halves equally well the loosest is taken: the greatest of all strata.
    assert found["a"] == (-1, [49, 9])
    assert set(found) == {"a"}
    small = [r for r in rows if r[0] != "c"]
    assert set(cutoffs(labelled(spark, small))) == {"a"}


def test_false_rejection_is_bounded():
    """Over many draws a level whose true rate is beyond the limit passes with less than the risk."""
    rng = random.Random(7)
    n, draws = 400, 400
    passed = sum(
        quality_rules.binomial_tail(n, sum(rng.random() < 0.051 for _ in range(n)), 0.05) <= 0.05
        for _ in range(draws)
    )
    assert passed <= 0.09 * draws


def test_edge_cases(spark, make_docs):  # noqa: F811
    long = prose(3, 40_000)
    rows = [(1, None), (2, ""), (3, " \n"), (4, prose(4, 25)), (None, prose(5, 30)), (6, "x " * 40),
            (4, prose(4, 25)), (7, long), (8, "# " * 30 + prose(8, 30)), (9, prose(9, 19))]
    labels = spark.createDataFrame(
        [(4, 1), (4, 0), (8, None), (None, 1), (7, 1)], "doc_id bigint, quality int"
    )
    for clash in (False, True):
        docs = make_docs(rows, clash)
        for lab in (labels, labels.limit(0)):
            found = sorted((tuple(r) for r in quality_rules.judge(docs, lab).collect()), key=str)
            expected = []
            for i, text in rows:
                counts = plain_counts(text or "")[:5] if text != long else None
                counts = counts or tuple(c[0] for c in quality_rules.text_counts([long]))[:5]
                failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
                expected.append((i, *counts, failed, not failed))
            assert found == sorted(expected, key=str)
    assert quality_rules.judge(make_docs([]), labels).count() == 0


def test_equals_sql(spark, duck):
    name = "op13_quality_rules"
    assert mismatch(queries.QUERIES[name](spark, SF), duck, queries.ORACLES[name]) is None


def test_parts_good_from_bad(spark):
    sf = "/root/testdata/sf0.1"
    judged = queries.QUERIES["op13_quality_rules"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality IS NOT NULL")
    shares = dict(
        judged.where("NOT base_failed").join(labels, "doc_id")
        .groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    )
    assert shares[1] > 0.98
    assert shares[0] < 0.05
