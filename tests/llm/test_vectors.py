import numpy as np
import pytest
from llm_data import SF

from clicktide.llm import topk, vector_graph

VECTORS = "vec_id bigint, embedding array<float>, label int, node bigint, cells string, v string"


@pytest.fixture()
def make_vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, None, 7, "x", "y") for i, v in rows], VECTORS)

    return make


def plain_top_k(rows, queries, k=5):
    whole = [(i, [int(np.floor(256.0 * float(np.float32(c)))) for c in v]) for i, v in rows]
    out = set()
    for q, qv in queries:
        qi = [int(np.floor(256.0 * float(np.float32(c)))) for c in qv]
        best = sorted((-sum(a * b for a, b in zip(qi, v)), i) for i, v in whole if i != q and len(v) == len(qv))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best[:k])}
    return out


def as_set(df):
    rows = [tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_top_k_equals_plain_version(make_vectors, monkeypatch, spread):
    for name, value in (("LEAF_ROWS", 8), ("SHARD_ROWS", 50), ("BLOCK_ROWS", 20), ("SEED_ROWS", 30)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(6, 8))
    rows = [(i, (middle[i % 6] + spread * rng.normal(size=8)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)]  # ties
    queries = [r for r in rows if r[0] % 5 == 0]
    got = topk.exact_top_k(make_vectors(rows).repartition(3), make_vectors(queries))
    assert as_set(got) == plain_top_k(rows, queries)


def test_top_k_odd_rows(make_vectors):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [0.5, -0.1]), (100, None), (150, [nan, 1.0]), (200, [inf, 1.0]),
            (250, [None, 1.0]), (300, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]),
            (350, []), (400, [3e38, -3e38])]
    usable = [(i, v) for i, v in rows if i is not None and v is not None and not (set(map(str, v)) & {"nan", "inf", "None"})]
    vectors = make_vectors(rows)
    # The two equal rows of id 7 are two candidates.
    want = [
        (q, r + 1, i, max(-(2**63), min(2**63 - 1, -s)))
        for q, qv in usable if q % 50 == 0
        for r, (s, i) in enumerate(
            sorted((-sum(int(np.floor(256.0 * float(np.float32(a)))) * int(np.floor(256.0 * float(np.float32(b)))) for a, b in zip(qv, v)), i)
                   for i, v in usable if i != q and len(v) == len(qv))[:5])
    ]
    rows_got = sorted(tuple(r) for r in topk.exact_top_k(vectors, vectors.where("vec_id % 50 = 0")).collect())
    assert rows_got == sorted(want)
    empty = make_vectors([])
    assert topk.exact_top_k(empty, empty).count() == 0
    assert topk.exact_top_k(vectors, empty).count() == 0


def plain_links(rows, threshold=0.9):
    """(vec_id, n_links, component_id, kept) by comparing all pairs."""
    ok = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v in rows]
    unit = [np.asarray(v, float) / np.linalg.norm(np.asarray(v, float)) if k else None for (_, v), k in zip(rows, ok)]
    n, root = len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * n
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if find(j) == find(i) and rows[j][0] is not None]
        component = min(ids, default=None)
        out.append((vec_id, links[i], component, vec_id == component))
    return sorted(out, key=str)


def groups(rng, n, dim, sizes, spread):
    rows = [rng.normal(size=dim) for _ in range(n)]
    for size in sizes:
        middle = rng.normal(size=dim)
        rows += [middle + spread * rng.normal(size=dim) for _ in range(size)]
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(rows)]


@pytest.mark.parametrize("shard_rows", [2048, 60])
def test_links_of_groups(make_vectors, monkeypatch, shard_rows):
    monkeypatch.setattr(vector_graph, "SHARD_ROWS", shard_rows)
    rng = np.random.default_rng(2)
    rows = groups(rng, 120, 24, [2] * 20 + [30, 90], 0.12)
    rows += [(500 + i, rows[3][1]) for i in range(40)]  # copies
    got = vector_graph.near_duplicates(make_vectors(rows)).collect()
    want = plain_links(rows)
    found, true = sum(r.n_links for r in got), sum(w[1] for w in want)
    assert 0.98 * true <= found <= true
    assert sum(r.kept for r in got) <= sum(w[3] for w in want) + 1
    by_id = {w[0]: w for w in want}
    assert all(r.n_links <= by_id[r.vec_id][1] and r.component_id >= by_id[r.vec_id][2] for r in got)


def test_links_of_odd_rows(make_vectors):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (8, [1.0, 0.0]), (7, [2.0, 0.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]),
            (11, [3e38, 1e38]), (12, [1e-40, 3e-41]), (8, [0.99, 0.01])]
    got = sorted((tuple(r) for r in vector_graph.near_duplicates(make_vectors(rows)).collect()), key=str)
    assert got == plain_links(rows)
    assert vector_graph.near_duplicates(make_vectors([])).count() == 0


def test_recall_of_a_shard_search():
    rng = np.random.default_rng(3)
    rows = groups(rng, 900, 32, [2] * 100 + [60], 0.1)
    unit = vector_graph._unit(np.array([v for _, v in rows]))
    lists = vector_graph.robust_prune(unit)
    table = np.full((len(unit), max(map(len, lists))), -1)
    for i, near in enumerate(lists):
        table[i, : len(near)] = near
    a, b = vector_graph.range_search(unit, table, np.arange(len(unit)), 0.9)
    true = (unit @ unit.T >= 0.9).sum() - len(unit)
    assert len(a) >= 0.98 * true and (np.einsum("ij,ij->i", unit[a], unit[b]) >= 0.9).all()


@pytest.mark.parametrize("name", ["op7_exact_top_k", "op9_embedding_near_dedup", "op4_tool_calls"])
def test_query_equals_sql(spark, duck, name):
    from compare import mismatch

    from clicktide.llm import queries

    assert mismatch(queries.QUERIES[name](spark, SF), duck, queries.ORACLES[name]) is None
