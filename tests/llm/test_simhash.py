import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SF, make_docs, prose  # noqa: F401

from clicktide.llm import queries, simhash
from clicktide.llm.components import connected_components


def plain_fingerprint(text):
    """The contract, word for word."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words, word = [], ""
    for c in lowered + " ":
        if c in "\x20\x09\x0a\x0b\x0c\x0d":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """{fp: smallest index reachable} by comparing every pair."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aB c\t\n\x0b\x1c É z", max_size=60))
def test_fingerprint_is_the_contract(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_long_text_and_even_split():
    text = prose(1, 70_000)  # more hashes than are taken at once
    assert simhash.fingerprint(text) == plain_fingerprint(text)
    assert simhash.fingerprint("") == simhash.fingerprint(" \n\t") == 0


def planted(rng, n, groups):
    """Fingerprints at random and in chains whose neighbours differ by one or two bits."""
    fps = [int(x) for x in rng.integers(0, 2**63, n, dtype=np.uint64)]
    for _ in range(groups):
        fp = int(rng.integers(0, 2**63, dtype=np.uint64))
        for _ in range(6):
            fps.append(fp)
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                fp ^= 1 << int(b)
    return list(dict.fromkeys(fps))


def test_links_equal_all_pairs_by_either_route(spark):
    fps = planted(np.random.default_rng(5), 400, 60)
    want = plain_components(fps)
    frame = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp bigint")
    for key_limit in (4096, 1):
        edges = simhash.fingerprint_links(frame, key_limit=key_limit)
        roots = dict(connected_components(edges).collect())
        own = [roots.get(simhash._signed(f), simhash._signed(f)) for f in fps]
        first = {}
        got = [first.setdefault(r, i) for i, r in enumerate(own)]
        assert got == want


def test_odd_rows(make_docs):
    rows = [
        (5, None), (6, ""), (7, " \n"), (8, "one"), (9, "ONE"), (None, "one"), (9, "ONE"),
        (2, prose(3, 200)), (1, prose(3, 200)), (None, prose(4, 50)), (3, prose(9, 30_000)),
    ]
    got = sorted(
        ((r.doc_id, r.component_id) for r in simhash.near_duplicates(make_docs(rows, clash=True)).collect()),
        key=str,
    )
    want = [(5, 5), (6, 5), (7, 5), (8, 8), (9, 8), (9, 8), (None, 8), (2, 1), (1, 1), (None, None), (3, 3)]
    assert got == sorted(want, key=str)
    assert simhash.near_duplicates(make_docs([])).count() == 0


def test_representatives_keep_columns_and_one_of_each(make_docs):
    same = prose(11, 120)
    rows = [(1, same), (2, same), (3, prose(12, 80)), (3, prose(12, 80)), (None, same), (4, None), (5, "")]
    docs = make_docs(rows, clash=True)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "3", "4", "None"])
    assert simhash.representatives(make_docs([])).count() == 0


def test_query_equals_plain_version(spark):
    from clicktide.llm.common import table

    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op1_simhash_near_dedup"](spark, SF).collect()}
    ids = sorted(texts)
    fps = [plain_fingerprint(texts[i]) for i in ids]
    roots = plain_components(fps)
    assert got == {i: (f"{fp:016x}", ids[root]) for i, fp, root in zip(ids, fps, roots)}


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(0, 300)]
    hub = [(1000, i) for i in range(1001, 1400)] + [(1000, 1000), (None, 1), (1001, 1000)]
    got = dict(connected_components(spark.createDataFrame(path + hub, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1400)}}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
