import random

import numpy as np
from llm_data import SF, make_docs, prose  # noqa: F401

from clicktide.llm import chunks, queries


def step_by_step_cuts(data: bytes) -> list[int]:
    """Cuts by the rolling form of the gear hash and direct comparison of neighbours."""
    gear = [int(g) for g in chunks.gear_table()]
    h, hashes = 0, []
    for i, b in enumerate(data):
        h = (h << 1) + gear[b]
        if i >= chunks.GEAR_BYTES:
            h -= gear[data[i - chunks.GEAR_BYTES]] << chunks.GEAR_BYTES
        hashes.append(h % 2**32)
    reach, cuts, ties = chunks.REACH, [], []
    for i in range(reach, len(data) - reach):
        before, after = min(hashes[i - reach : i]), min(hashes[i + 1 : i + reach + 1])
        if hashes[i] <= after and hashes[i] <= before:
            (cuts if hashes[i] < before else ties).append(i + 1)
    out, last = [], 0
    for c in [*cuts, len(data)] if data else []:
        if c - last > chunks.LONGEST:
            first = next((t for t in ties if last < t < c), min(last + chunks.LONGEST, c))
            out += [*range(last + chunks.LONGEST, first, chunks.LONGEST), *range(first, c, chunks.LONGEST)]
        out.append(c)
        last = c
    moved = []
    for c in out:
        while c < len(data) and data[c] & 0xC0 == 0x80:
            c += 1
        moved.append(c)
    return sorted(set(moved))


def test_cuts_equal_the_rolling_hash():
    for text in ("", "a", "é" * 400, prose(1, 900), "xyz" * 500, "日本 text " * 90, "q" * 2000):
        data = text.encode()
        assert chunks.cut_points(data).tolist() == step_by_step_cuts(data), text[:20]


def test_cuts_do_not_depend_on_pieces(monkeypatch):
    data = (prose(2, 3000) + "é日" * 300).encode()
    whole = chunks.cut_points(data).tolist()
    monkeypatch.setattr(chunks, "_PIECE", 777)
    assert chunks.cut_points(data).tolist() == whole


def test_an_insertion_moves_few_chunks():
    text = prose(3, 2000)
    cut = lambda t: {t.encode()[i:j] for i, j in zip([0, *chunks.cut_points(t.encode())[:-1]], chunks.cut_points(t.encode()))}
    before, after = cut(text), cut(text[:5000] + "something new " + text[5000:])
    assert len(before - after) <= 4


def test_shared_passages_are_found_whole_and_removed_once(make_docs):
    passage = prose(50, 60)
    texts = {i: prose(100 + i, 150) for i in range(8)}
    for i in (2, 5, 6):
        texts[i] = texts[i] + "\n" + passage + "\n" + prose(200 + i, 90)
    docs = make_docs(list(texts.items()), clash=True)
    runs = chunks.repeated_runs(docs).collect()
    assert {r.doc_id for r in runs} == {2, 5, 6}
    assert {r.first_doc_id for r in runs} == {2}
    assert all(r.owned == (r.doc_id == 2) for r in runs)
    for r in runs:
        data = texts[r.doc_id].encode()[r.start : r.start + r.size].decode()
        assert data.strip() == passage
    cleaned = chunks.remove_repeats(docs)
    assert cleaned.columns == docs.columns
    got = {r.doc_id: r.text for r in cleaned.collect()}
    assert all(got[i] == texts[i] for i in (0, 1, 2, 3, 4, 7))
    for i in (5, 6):
        assert got[i].split() == texts[i].replace(passage, "").split()


def test_planted_passages_of_many_kinds(make_docs):
    """Passages of 51 words between other texts: short words, long words, a short period."""
    rng = random.Random(12)

    def words(n, low, high):
        return " ".join(
            "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(low, high))) for _ in range(n)
        )

    passages = [words(51, 2, 4) for _ in range(60)] + [words(51, 9, 14) for _ in range(20)]
    passages += [f"{words(1, 3, 3)} {words(1, 3, 3)} " * 39 + "end" for _ in range(20)]
    rows = []
    for i, passage in enumerate(passages):
        for copy in (0, 1):
            around = words(rng.randint(20, 60), 3, 8), words(rng.randint(20, 60), 3, 8)
            rows.append((2 * i + copy, f"{around[0]} {passage} {around[1]}", passage))
    docs = make_docs([r[:2] for r in rows])
    found = {}
    for r in chunks.repeated_runs(docs).collect():
        found.setdefault(r.doc_id, []).append(r)
    for i, text, passage in rows:
        (run,) = found[i]
        data = text.encode()[run.start : run.start + run.size].decode()
        if passage.endswith("end"):  # of a short period: some periods may stay at the edges
            assert data in f" {passage} " and len(data) > 0.75 * len(passage)
        else:
            assert data.strip() == passage
    got = {r.doc_id: r.text for r in chunks.remove_repeats(docs).collect()}
    for i, text, passage in rows:
        if i % 2 == 0:
            assert got[i] == text
        elif not passage.endswith("end"):
            assert got[i].split() == text.replace(passage, "").split()


def test_what_one_document_repeats_is_its_own(make_docs):
    refrain = prose(70, 80)
    own = "\n".join([prose(71, 40), refrain, prose(72, 40), refrain, prose(73, 40)])
    shared = prose(74, 80)
    first = "\n".join([shared, prose(75, 60), shared])
    later = "\n".join([prose(76, 60), shared, prose(77, 60), shared])
    docs = make_docs([(1, own), (2, first), (3, later), (4, "short words only")])
    runs = chunks.repeated_runs(docs).collect()
    assert {(r.doc_id, r.owned, r.first_doc_id) for r in runs} == {(2, True, 2), (3, False, 2)}
    got = {r.doc_id: r.text for r in chunks.remove_repeats(docs).collect()}
    assert got[1] == own and got[2] == first
    assert got[3].split() == later.replace(shared, "").split()


def test_short_common_phrases_stay(make_docs):
    phrase = prose(80, 25)
    docs = make_docs([(i, prose(81 + i, 60) + " " + phrase + " " + prose(91 + i, 60)) for i in range(4)])
    assert chunks.repeated_runs(docs).count() == 0
    # Text without blanks counts by its bytes.
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefgh") for _ in range(900))
    docs = make_docs([(i, prose(101 + i, 60) + " " + long + " " + prose(111 + i, 60)) for i in range(2)])
    assert [r.size for r in chunks.repeated_runs(docs).collect()] == [900, 900] or all(
        900 <= r.size <= 902 for r in chunks.repeated_runs(docs).collect()
    )


def test_odd_rows(make_docs):
    big = prose(9, 40_000)
    rows = [(1, None), (2, ""), (3, "short"), (4, "short"), (5, big), (6, big), (None, big), (6, big), (7, prose(8, 80)), (7, prose(7, 80))]
    docs = make_docs(rows, clash=True)
    runs = chunks.repeated_runs(docs).collect()
    assert {(r.doc_id, r.owned) for r in runs} == {(5, True), (6, False)}
    assert sum(r.size for r in runs if r.doc_id == 6) == len(big)
    got = sorted(((r.doc_id, r.text) for r in chunks.remove_repeats(docs).collect()), key=str)
    want = [(i, "" if i == 6 else t) for i, t in rows]
    assert got == sorted(want, key=str)
    assert chunks.repeated_runs(make_docs([])).count() == 0
    assert chunks.remove_repeats(make_docs([])).count() == 0


def plain_growth(own, other, at, mate, step):
    """Equal bytes from a place on in one direction, cut back to a blank or the text's end."""
    n = 0
    inside = (lambda n: at - n > 0 and mate - n > 0) if step < 0 else (lambda n: at + n < len(own) and mate + n < len(other))
    shift = (lambda n: -1 - n) if step < 0 else (lambda n: n)
    while n < chunks.CONTEXT and inside(n) and own[at + shift(n)] == other[mate + shift(n)]:
        n += 1
    while n and 0 <= at + shift(n) < len(own) and own[at + shift(n)] not in b" \t\n\x0b\x0c\r":
        n -= 1
    return n


def test_query_equals_plain_version(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    data = {i: t.encode() for i, t in texts.items()}
    where: dict[bytes, list] = {}
    for i in sorted(data):
        cuts = step_by_step_cuts(data[i])
        for a, b in zip([0, *cuts[:-1]], cuts):
            where.setdefault(data[i][a:b], []).append((i, a))
    chunk_at = {}
    for c, places in where.items():
        first, last = min(places)[0], max(places)[0]
        if first != last:
            for i, a in places:
                mate = last if i == first else first
                at = [b for d, b in places if d == mate]
                chunk_at[i, a] = len(c), first, (mate, min(at), max(at))
    want = set()
    for i in data:
        parts = []
        for (d, a), (size, first, mate) in sorted(chunk_at.items()):
            if d != i:
                continue
            owned = first == i
            here = (a, size, owned, first, mate)
            if parts and sum(parts[-1][-1][:2]) == a and parts[-1][-1][2] == owned:
                parts[-1].append(here)
            else:
                parts.append([here])
        for part in parts:
            start, end = part[0][0], part[-1][0] + part[-1][1]
            (left_doc, left, _), (right_doc, _, right) = part[0][4], part[-1][4]
            low = start - plain_growth(data[i], data[left_doc], start, left, -1)
            high = end + plain_growth(data[i], data[right_doc], end, right + part[-1][1], 1)
            begins = sum(
                data[i][k : k + 1].strip() != b"" and (k == 0 or data[i][k - 1 : k].strip() == b"")
                for k in range(low, high)
            )
            if begins >= chunks.MIN_WORDS or high - low >= chunks.MIN_BYTES:
                want.add((i, low, high - low, min(p[3] for p in part), len(part), part[0][2]))
    rows = queries.QUERIES["op3_substring_dedup"](spark, SF).collect()
    assert {(r.doc_id, r.start, r.size, r.first_doc_id, r.n_chunks, r.owned) for r in rows} == want
    assert len(rows) == len(want) > 10


def test_random_bytes_keep_chunk_sizes():
    data = random.Random(4).randbytes(200_000).replace(b"\x80", b"a")
    sizes = np.diff([0, *chunks.cut_points(data.decode("latin-1").encode())])
    assert sizes.max() <= chunks.LONGEST + 3 and sizes.min() > 0
    # Only what is left of a stretch beyond LONGEST may be shorter than the least hashes lie apart.
    short = np.flatnonzero(sizes[:-1] <= chunks.REACH - 3)
    assert (sizes[short - 1] >= chunks.LONGEST - 3).all() and len(short) < 0.02 * len(sizes)
