from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicktide.llm import queries, whitening

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<float>, label int"


def plain_moments(rows):
    """n, sums and covariance of whole-step rows in fractions."""
    n, d = len(rows), len(rows[0])
    s = [sum(r[j] for r in rows) for j in range(d)]
    mean = [Fraction(x, n) for x in s]
    cov = [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in rows) / n for j in range(d)] for i in range(d)]
    return n, s, cov


def steps(vector):
    return [int(np.floor(64.0 * float(c))) + 1_000_000 for c in vector]


def symmetric(values, seed):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    q = q.astype(np.longdouble)
    for _ in range(3):  # orthonormal beyond double precision
        q = q @ (1.5 * np.eye(len(values), dtype=np.longdouble) - 0.5 * q.T @ q)
    return q @ np.diag(np.array(values, np.longdouble)) @ q.T, q


@pytest.mark.parametrize(
    "values",
    [
        [9, 7, 5, 3, 1],
        [1.0, 1.0 - 1e-9, 1.0 - 2e-9, 0.5, 0.5, 1e-3],  # a tight cluster and a pair of equals
        [4, 4, 4, 4],
        [1e12, 1.0, 1e-1, 0],
        [5, 5 - 1e-13, 1],
        [3],
        [0, 0, 0],
        list(np.linspace(1, 2, 60)) + [1.5 + 1e-8] * 4,
    ],
)
def test_eigenvectors_to_double_precision(values):
    values = sorted(values, reverse=True)
    v, q = symmetric(values, 3)
    found, x = (part.astype(float) for part in whitening.refined_eigenvectors(v))
    top = max(values[0], 1e-300)
    assert np.abs(found - np.array(values, float)).max() <= 4e-15 * top
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-14
    for i, value in enumerate(values):
        gap = min([abs(value - other) for j, other in enumerate(values) if j != i], default=1.0)
        if gap / top > 1e-14:  # a single direction: the vector itself, up to its sign
            cosine = abs(float(np.longdouble(1) * (q[:, i] @ x[:, i].astype(np.longdouble))))
            assert 1 - cosine < 1e-15 + (2e-19 * top / gap) ** 2 * 100


def test_refinement_beats_float32():
    v, q = symmetric(np.linspace(1, 3, 40)[::-1], 5)
    rough = np.linalg.eigh(v.astype(np.float32))[1][:, ::-1].astype(float)
    fine = whitening.refined_eigenvectors(v)[1].astype(float)
    exact = q.astype(float)

    def error(x):
        return np.abs(x * np.sign((x * exact).sum(axis=0)) - exact).max()

    assert error(rough) > 1e-7 and error(fine) < 1e-15


def test_exact_gram():
    rng = np.random.default_rng(1)
    for top in (3, 10**7, 2**40):
        d = rng.integers(-top, top + 1, (50, 4))
        assert (whitening.exact_gram(d) == d.T.astype(object) @ d.astype(object)).all()


def check(df, vectors, components=32):
    """All columns of a result against the contract, computed in fractions."""
    rows = [(i, steps(v)) for i, v in vectors]
    n, s, cov = plain_moments([x for _, x in rows])
    v = np.array([[float(c) for c in row] for row in cov])
    values, basis = np.linalg.eigh(v)
    values = values[::-1][:components]
    found = df.collect()
    assert len(found) == n * len(values)
    trace = float(sum(cov[i][i] for i in range(len(cov))))
    by_row = {}
    for r in found:
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained - values[r.component - 1] / trace) < 1e-9 * r.explained + 1e-12
        by_row.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    deviations = sorted((i, sum((n * a - b) ** 2 for a, b in zip(x, s))) for i, x in rows)
    assert sorted({k: 1 for k in deviations}) == sorted(by_row)
    vectors_found = np.array([[by_row[k][c][0] for c in range(1, len(values) + 1)] for k in deviations])
    x = np.array([[float(Fraction(a) - Fraction(b, n)) for a, b in zip(dict(rows)[i], s)] for i, _ in deviations])
    expected = x @ basis[:, ::-1][:, : len(values)] / np.sqrt(values)
    sign = np.sign((vectors_found * expected).sum(axis=0))
    assert np.abs(vectors_found * sign - expected).max() < 1e-5


def test_query_is_the_contract(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    vectors = [(r.vec_id, r.embedding) for r in table.collect()]
    df = queries.QUERIES["op12_embedding_whitening"](spark, SF)
    assert df.dtypes == [tuple(c.split()) for c in whitening._SCHEMA.split(", ")]
    check(df, vectors)
    parts = whitening.whiten(table.repartition(7)).orderBy("vec_id", "component").collect()
    assert parts == df.orderBy("vec_id", "component").collect() or all(
        abs(a.whitened - b.whitened) < 1e-12 and a.deviation == b.deviation
        for a, b in zip(parts, df.orderBy("vec_id", "component").collect())
    )


def test_edge_cases(spark):
    rng = np.random.default_rng(8)
    good = [(i, [float(np.float32(c)) for c in rng.normal(size=3)]) for i in range(40)]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, float("nan"), 0.0]),
           (54, [float("inf"), 0.0, 0.0]), (55, [1.0, 2.0]), (56, [3e38, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in good + bad], VECTORS)
    clash = df.select("*", *[F.lit(1).alias(c) for c in ("x", "i", "n", "width", "component")])
    for table in (df, clash):
        check(whitening.whiten(table), good)
    check(whitening.whiten(df, components=2), good, components=2)
    assert whitening.whiten(df.limit(0)).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(5)], VECTORS)
    assert whitening.whiten(same).count() == 0
    # A dimension that never changes and one that doubles another leave one direction.
    flat = spark.createDataFrame([(i, [1.0, i / 64, i / 32], 0) for i in range(9)], VECTORS)
    assert {r.component for r in whitening.whiten(flat).collect()} == {1}
    repeated = spark.createDataFrame([(i, v, 0) for i, v in good + good], VECTORS)
    assert whitening.whiten(repeated).where("n = 80").count() == 80 * 3
    unnamed = spark.createDataFrame([(None, v, 0) for _, v in good], VECTORS)
    assert whitening.whiten(unnamed).where("vec_id IS NULL").count() == 40 * 3


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(9)
    vectors = [(i, [float(c) for c in np.float32(rng.normal(size=2) * 2.0**33)]) for i in range(30)]
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], VECTORS)
    found = whitening.moments(whitening.steps_of(df))
    n, s, cov = plain_moments([steps(v) for _, v in vectors])
    assert (found.n, found.sums) == (n, s)
    assert all(Fraction(int(found.scatter[i, j]), n * n) == cov[i][j] for i in range(2) for j in range(2))
    exact = [sum((n * a - b) ** 2 for a, b in zip(steps(v), s)) for _, v in vectors]
    x = np.array([steps(v) for _, v in vectors], dtype=np.int64)
    assert found.deviations(x) == [e if e < 1 << 63 else None for e in exact]
