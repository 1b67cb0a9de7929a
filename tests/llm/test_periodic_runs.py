import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SF, make_docs  # noqa: F401

from clicktide.llm import periodic_runs, queries


def plain_runs(words):
    """Every stretch with each period, compared word for word; the smallest period of a stretch stays."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            begin = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - begin
            if length >= max(6, 4 * q):
                found.setdefault((begin, length), q)
            i += 1 if i == begin else 0
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    """The contract, step by step."""
    words, word = [], ""
    for c in (text or "") + " ":
        if c in "\x20\x09\x0a\x0b\x0c\x0d":
            words += [word] if word else []
            word = ""
        else:
            word += c
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


def nested(rng):
    """Words in repeats of repeats, with faults between them."""
    words = [rng.choice("ab") for _ in range(rng.randint(1, 4))]
    for _ in range(rng.randint(1, 3)):
        words = words * rng.randint(1, 6) + [rng.choice("abc") for _ in range(rng.randint(0, 2))]
    return words[:500]


def check_group(documents):
    number = {w: i for i, w in enumerate(sorted({w for d in documents for w in d}))}
    text, expected = [], []
    for i, words in enumerate(documents):
        expected += [(len(text) + s, n, q) for s, n, q in plain_runs(words)]
        text += [number[w] for w in words] + [len(number) + i]
    found = periodic_runs.find_runs(np.array(text, np.int64), max(map(len, documents)))
    assert [tuple(r) for r in found.tolist()] == expected


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), min_size=1, max_size=4))
def test_two_words(documents):
    check_group([list(d) for d in documents])


def test_repeats_of_repeats():
    rng = random.Random(5)
    for _ in range(250):
        check_group([nested(rng) for _ in range(rng.randint(1, 4))])


def test_wavelet_matrix():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 37, 50)
    matrix = periodic_runs.WaveletMatrix(values)
    low = rng.integers(0, 50, 400)
    high = np.minimum(low + rng.integers(1, 30, 400), 50)
    bound = rng.integers(0, 90, 400)
    below = [int((values[a:b] < x).sum()) for a, b, x in zip(low, high, bound)]
    assert matrix.count_below(low, high, bound).tolist() == below
    k = rng.integers(0, high - low)
    assert matrix.kth(low, high, k).tolist() == [sorted(values[a:b])[i] for a, b, i in zip(low, high, k)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_edge_cases(spark, make_docs):  # noqa: F811
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a", "a " * 5, "a " * 6, "a a\x0ba\ra\x0ca a", "x " * 7 + "y " * 9,
             "a\xa0b a\xa0b a\xa0b a\xa0b a\xa0b a\xa0b", "a b c " * 3 + "a b", "a b c " * 4]
    table = [(i, t) for i, t in enumerate(texts)] + [(None, "b " * 20), (7, "c d " * 9), (7, "c d " * 9)]
    table += [(100 + i, " ".join(nested(rng))) for i in range(150)]
    expected = sorted([plain_row(i, t) for i, t in table], key=str)
    for clash in (False, True):
        assert rows(periodic_runs.periodic_runs(make_docs(table, clash))) == expected
    empty = periodic_runs.periodic_runs(make_docs([]))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


def test_long_text(spark, make_docs):  # noqa: F811
    """One document larger than a group, periodic at several scales."""
    rng = random.Random(4)
    unit = [str(rng.randint(0, 10**6)) for _ in range(70_000)]
    words = unit * 5 + ["z"] * 50 + unit[:3] * 100
    (row,) = periodic_runs.document_rows([words])
    assert row[:5] == (3, 350_050, 300, 3, 100_000)
    starts = periodic_runs.find_runs(np.unique(words, return_inverse=True)[1], len(words)).tolist()
    assert starts == [[0, 350_000, 70_000], [350_000, 50, 1], [350_050, 300, 3]]


def test_query_is_the_contract(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = sorted([plain_row(r.doc_id, r.text) for r in docs], key=str)
    found = queries.QUERIES["op11_periodic_runs"](spark, SF)
    assert rows(found) == expected
    assert any(row[1] for row in expected)
