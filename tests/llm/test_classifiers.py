import random
import zlib

import numpy as np
import pytest
from llm_data import make_docs, prose  # noqa: F401

from clicktide.llm import quality, queries, toxicity

SMALL = "/root/testdata/sf0.01"


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


@pytest.fixture()
def make_labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int, text string")


def held_out_rows(spark, name, column):
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = queries.QUERIES[name](spark, SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert all(r.held_out == (fold(r.doc_id) == 0) and 0 <= r.score <= 1 for r in rows)
    return [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels], rows


def test_quality_of_held_out_rows(spark):
    pairs, rows = held_out_rows(spark, "op8_quality", "quality")
    assert np.mean([p == y for p, y in pairs]) >= 0.95
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_toxicity_of_held_out_rows(spark):
    pairs, rows = held_out_rows(spark, "op10_toxicity", "toxic")
    assert np.mean([p == y for p, y in pairs]) >= 0.9
    assert np.mean([p for p, y in pairs if not y]) <= 0.05
    assert all(r.predicted == (r.score >= 0.5) for r in rows)


def corpus(make_docs, make_labels):
    """Good and toxic documents, bad ones of repeated words; labels of held-out rows are wrong."""
    rng, rows, labels = random.Random(1), [], []
    for i in range(300):
        words = prose(i, 60).split()
        toxic, bad = int(i % 5 == 1), int(i % 7 == 2)
        if toxic:
            words[rng.randrange(50)] = rng.choice(["Vile,", "vilest", "vileness"])
        text = " ".join(words)
        text = "\n".join([text, *["SPAM SPAM SPAM $$$ ### " * 6] * 3]) if bad else text + "\n" + prose(1000 + i, 40)
        rows.append((i, text))
        wrong = fold(i) == 0
        labels.append((i, (1 - bad) ^ wrong, toxic ^ wrong, "x"))
    return make_docs(rows, clash=True), make_labels(labels), rows


def test_held_out_labels_are_never_learned(make_docs, make_labels):
    docs, labels, rows = corpus(make_docs, make_labels)
    toxic = {r.doc_id: r.predicted for r in toxicity.classify(docs, labels).collect()}
    assert np.mean([toxic[i] == (i % 5 == 1) for i in toxic]) > 0.97
    good = {r.doc_id: r.predicted for r in quality.classify(docs, labels).collect()}
    assert np.mean([good[i] == (i % 7 != 2) for i in good]) > 0.97
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in toxic if not toxic[i]}
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in good if good[i]}


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(make_docs, make_labels, module):
    docs, labels, rows = corpus(make_docs, make_labels)
    odd = make_docs([(900, None), (901, ""), (None, prose(2, 30)), (902, "\n\n\n"), (902, "\n\n\n"),
                     (903, prose(4, 60_000)), (904, "x" * 300_000), (905, "é \x00 \t|!")], clash=True)
    noisy = labels.unionByName(make_labels([(0, 1, 0, "x"), (0, 0, 1, "x"), (None, 1, 1, None), (5, None, None, None), (7, 9, 9, "x")]))
    scored = module.classify(docs.unionByName(odd), noisy).collect()
    assert len(scored) == len(rows) + 8
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in scored)
    assert all(r.held_out for r in scored if r.doc_id is None)
    by_id = {r.doc_id: r.score for r in scored}
    assert by_id[900] == by_id[901]
    assert module.classify(make_docs([]), labels).count() == 0
    # Without labels, or with one kind only, every text has the same score.
    for few in (labels.limit(0), labels.where("quality = 1 AND toxic = 0")):
        flat = {r.score for r in module.classify(docs.limit(20), few).collect()}
        assert len(flat) == 1


def test_gradient_of_the_non_negative_risk():
    rng = np.random.default_rng(1)
    pos, unl = rng.integers(0, 2, (30, 5)).astype(float), rng.integers(0, 2, (50, 5)).astype(float)

    def risk(p, prior):
        g_pos, g_unl = pos @ p[:-1] + p[-1], unl @ p[:-1] + p[-1]
        loss = lambda z: np.logaddexp(0, -z).mean()
        return prior * loss(g_pos), loss(-g_unl) - prior * loss(-g_pos), toxicity.WEIGHT_DECAY / 2 * (p[:-1] ** 2).sum()

    for prior, sign in ((0.1, 1), (0.99, -1)):
        p = rng.normal(size=6) * (0.3 if sign > 0 else 3)
        p[-1] = -2 if sign > 0 else 3
        first, second, decay = risk(p, prior)
        if sign < 0 and second >= 0:
            pytest.skip("no negative risk here")
        got = toxicity.nn_pu_gradient(p, pos, unl, prior)
        for k in range(6):
            step = np.zeros(6)
            step[k] = 1e-6
            up, down = risk(p + step, prior), risk(p - step, prior)
            diff = [(a - b) / 2e-6 for a, b in zip(up, down)]
            want = diff[0] + diff[1] + diff[2] if second >= 0 else -diff[1] + diff[2]
            assert abs(got[k] - want) < 1e-5


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    good, turn = rng.normal(size=9), rng.normal(size=(2, 2))
    first = np.array([0, 4, 5, 9])
    got, pairs = quality.chain_marginals(good, turn, first, pairs=True)
    want_pairs = np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:]):
        total, marginal, edge = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for code in range(2 ** (b - a)):
            y = [code >> k & 1 for k in range(b - a)]
            w = np.exp(sum(g for g, s in zip(good[a:b], y) if s) + sum(turn[s, t] for s, t in zip(y, y[1:])))
            total += w
            marginal += w * np.array(y)
            for s, t in zip(y, y[1:]):
                edge[s, t] += w
        assert np.allclose(got[a:b], marginal / total)
        want_pairs += edge / total
    assert np.allclose(pairs, want_pairs)


def test_line_features_do_not_depend_on_the_batch():
    texts = ["", "a b b\nA!! |x|\n\na b b", prose(1, 200), "é é\n", "one"]
    together, sizes, first = quality.line_features(texts)
    for i, t in enumerate(texts):
        alone, own, _ = quality.line_features([t])
        assert np.allclose(alone, together[first[i] : first[i + 1]])
        assert own.tolist() == [len(line.encode()) for line in t.split("\n")]
    x, _, _ = quality.line_features([texts[1]])
    named = dict(zip(quality._NAMES, x.T))
    assert np.allclose(named["repeats_word"], [1 / 3, 0, 0, 1 / 3])
    assert named["repeats_line"].tolist() == [0, 0, 0, 1] and named["empty"].tolist() == [0, 0, 1, 0]
