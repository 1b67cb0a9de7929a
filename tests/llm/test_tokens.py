import hashlib
import random
import zlib
from functools import lru_cache

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SF, make_docs, prose  # noqa: F401
from tokenizers import Tokenizer

from clicktide.llm import packing, pieces, queries

PIECES = queries.tokenizer_file("piece_bpe_32k.model")
BYTES = queries.tokenizer_file("byte_bpe_50k.json")
ALPHABET = "ab the  ▁é日😀ßing,.!<>0x41\x00　́ \n\t"


@lru_cache
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def same_as_library(text):
    ids, decoded = pieces.prefix_table(PIECES).encode_decode(text)
    want = library().encode(text, add_bos=True, add_eos=True)
    assert np.frombuffer(ids, "<u4").tolist() == want, text[:80]
    assert decoded == library().decode(want)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=50))
def test_encoding_of_odd_texts(text):
    same_as_library(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_encoding_of_any_text(text):
    same_as_library(text)


def test_encoding_of_joined_pieces_and_runs():
    rng = random.Random(2)
    known = [p for p in pieces.prefix_table(PIECES).id if "▁" not in p]
    for _ in range(3000):
        same_as_library("".join(rng.choice(known) for _ in range(rng.randint(1, 10))))
    for n in range(70):
        for end in ("", "a", "the", "\n", "日"):
            same_as_library(" " * n + end)
    same_as_library("a" * 5000 + "=" * 3000 + "the" * 2000)


def test_decoding_of_any_ids():
    rng, table = random.Random(3), pieces.prefix_table(PIECES)
    for _ in range(500):
        ids = [rng.randrange(32000) for _ in range(rng.randint(0, 8))]
        assert table.decode(ids) == library().decode(ids)


def test_sentencepiece_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.QUERIES["op5_sentencepiece"](spark, SF).collect():
        ids = library().encode(texts.pop(r.doc_id), add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library().decode(ids).encode()).hexdigest()
    assert not texts


def test_sentencepiece_odd_rows(make_docs):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b"), (4, prose(1, 20_000))]
    got = pieces.encode_decode(make_docs(rows, clash=True), PIECES).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in got) == sorted((str(i), t or "") for i, t in rows)
    assert pieces.encode_decode(make_docs([]), PIECES).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ALPHABET + "'sl\x1c\x85\xa0 ", max_size=50))
def test_units_equal_whole_texts(text):
    encoder = packing.unit_encoder(BYTES)
    want = encoder.tokenizer
    assert np.frombuffer(encoder.encode_all([text])[0], "<u4").tolist() == want.encode(text, add_special_tokens=False).ids


def test_a_word_is_encoded_once_whatever_follows_it(monkeypatch):
    encoder, asked = packing.UnitEncoder(BYTES), []
    encode = encoder._encode_joined
    monkeypatch.setattr(encoder, "_encode_joined", lambda units: asked.extend(units) or encode(units))
    text = "a qwertzu, qwertzu. qwertzu; qwertzu qwertzu12 x\n"
    for _ in range(2):
        ids = np.frombuffer(encoder.encode_all([text])[0], "<u4").tolist()
        assert ids == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert asked.count(b" qwertzu") == 1
    assert not [u for u in asked if b" qwertzu" in u and u != b" qwertzu"]


@pytest.mark.parametrize("cache", [0, 6, 500_000])
def test_units_of_odd_texts_in_any_cache(monkeypatch, cache):
    monkeypatch.setattr(packing, "UNIT_CACHE", cache)
    encoder = packing.UnitEncoder(BYTES)
    texts = ["", "it's 'tis don't, I'll'd x's1 s'9", "a<|endoftext|>b <|endoftext|> c", "é,é2 ü.x a,b,,c1d2 \t\n x",
             "\n", "  ", ",", " a\u2003b, c", "\U0001f600x,\U0001f600 1,000.5e3 __a_b__ A\r\nb"]
    rng = random.Random(3)
    texts += ["".join(rng.choices("ab'sl, 1.\n\té\u00a0€<|>", k=rng.randrange(40))) for _ in range(2_000)]
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for size in (len(texts), 300):
        found = [ids for i in range(0, len(texts), size) for ids in encoder.encode_all(texts[i : i + size])]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == want


def test_level_for_is_the_least_sum_of_squares():
    rng = random.Random(4)
    packer = packing.SumOfSquares(window=64, open_windows=10_000)
    for _ in range(400):
        size = rng.randint(1, 63)
        n = packer.count.copy()
        costs = {}
        for level in [0, *[k for k in range(1, 65 - size) if n[k]]]:
            m = n.copy()
            if level:
                m[level] -= 1
            if level + size < 64:
                m[level + size] += 1
            costs[level] = int((m**2).sum())
        best = min(costs.values())
        assert packer.level_for(size) == max(k for k, c in costs.items() if c == best)
        packer.add([0, 0, bytes(4 * size)])


def check_packing(rows, texts, window):
    """Every id in one piece, gapless sequences, no overfull window."""
    tokenizer = Tokenizer.from_file(BYTES)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == texts.keys()
    for doc_id, found in by_doc.items():
        ids = [*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, packing.END_ID]
        at = 0
        for r in sorted(found, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert zlib.crc32(part) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    fills = []
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
        fills.append(at)
    return fills


def test_packing_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r.asDict() for r in queries.QUERIES["op6_packing"](spark, SF).collect()]
    fills = check_packing(rows, texts, packing.WINDOW)
    assert sum(f < packing.WINDOW for f in fills) <= 1  # the table has one partition


@pytest.mark.parametrize("open_windows", [2, 1000])
def test_packing_odd_rows(make_docs, open_windows):
    texts = {1: None, 2: "", 3: "a", None: "no id", 4: prose(1, 3000), **{10 + i: prose(i, i) for i in range(90)}}
    docs = make_docs(list(texts.items()), clash=True).repartition(3)
    packed = packing.piece_digests(packing.pack(docs, BYTES, 64, open_windows))
    fills = check_packing([r.asDict() for r in packed.collect()], {k: t or "" for k, t in texts.items()}, 64)
    assert sum(f < 64 for f in fills) <= 3
    assert packing.pack(make_docs([]), BYTES).count() == 0
    twice = packing.pack(make_docs([(1, "a b")] * 2), BYTES).collect()
    assert [r.doc_id for r in twice] == [1, 1]
