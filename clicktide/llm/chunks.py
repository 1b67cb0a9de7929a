"""Substring deduplication by content-defined chunking with a gear rolling hash.

A text's UTF-8 bytes are cut where the gear hash of the last ``GEAR_BYTES`` bytes is the smallest
within ``REACH`` bytes to either side, moved to the end of the character. So a cut depends on nearby
bytes only: text put in front of a passage shifts its cuts with it, and two documents that share a
passage cut it alike but for its edges. A stretch without such a cut, as in text of a short period, is
cut every ``LONGEST`` bytes from its first least hash on, a place that its own content sets.

Chunks are counted over the whole corpus by 64 bits of their digest, and those met more than once are
compared by 96 bits of it. A chunk repeats if two documents hold it; what only one document repeats is
its own. The document of a chunk's first place, by (doc_id, start), owns it. Neighbouring repeated
chunks of a document form a run, owned and others apart. A run is a seed: it is extended to both
sides, by whole words, as far as the bytes agree with another document's around the same chunk (the
owner's, for an owned run the last holder's). Runs of ``MIN_WORDS`` words or ``MIN_BYTES`` bytes are
repeats. Where the other document shares that chunk only, an edge keeps the chunk's bound, and in text
of a short period it may fall some periods short; so the least number of words lies somewhat below the
fifty that a passage worth finding has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktide.llm.common import text_batches, whole_rows, whole_text
from clicktide.operators.ordered import join_per_key
from clicktide.session import materialize

GEAR_BYTES = 8
REACH = 24
LONGEST = 128
MIN_WORDS, MIN_BYTES = 40, 512
#: Bytes on either side of a run that are compared; the chunk next to it is no longer.
CONTEXT = LONGEST + 4
_BLANKS = b" \t\n\x0b\x0c\r"
_PIECE = 1 << 20  # bytes of a long text that are hashed at once


def gear_table() -> np.ndarray:
    """A 32-bit number for every byte, from XXH32 of its decimal digits."""
    return np.array([xxhash.xxh32_intdigest(str(b)) for b in range(256)], dtype=np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte the sum of the last ``GEAR_BYTES`` bytes' gear numbers, shifted left by their distance.

    The usual step hash = (hash << 1) + gear[byte], cut to ``GEAR_BYTES``, by doubling the span.
    """
    h = gear_table()[data]
    span = 1
    while span < GEAR_BYTES:
        wider = h.copy()
        wider[span:] += h[:-span] << np.uint32(span)
        h, span = wider, 2 * span
    return h


def _span_minimum(h: np.ndarray, n: int) -> np.ndarray:
    """m[i] = min(h[i : i + n]) for all i with a full span."""
    m, span = h, 1
    while 2 * span <= n:
        m, span = np.minimum(m[:-span], m[span:]), 2 * span
    rest = n - span
    return np.minimum(m[:-rest], m[rest:]) if rest else m


def cut_points(data: bytes) -> np.ndarray:
    """End offsets of the chunks of ``data``, the last one being its length; none if empty."""
    size = len(data)
    if not size:
        return np.empty(0, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)
    found, tied, margin = [], [], GEAR_BYTES + REACH
    for begin in range(0, size, _PIECE):
        # Each piece sees enough bytes around it to cut as the whole text would.
        low, high = max(0, begin - margin), min(size, begin + _PIECE + margin)
        h = gear_hashes(raw[low:high])
        if len(h) <= 2 * REACH:
            continue
        spans = _span_minimum(h, REACH)
        middle, before = h[REACH:-REACH], spans[: len(h) - 2 * REACH]
        # Smaller than all before it and than or equal to all after it: at most one per span.
        least = middle <= spans[REACH + 1 :][: len(middle)]
        for places, rule in ((found, middle < before), (tied, middle == before)):
            at = np.flatnonzero(least & rule) + REACH + low + 1
            places.append(at[(at > begin) & (at <= begin + _PIECE)])
    cuts = np.unique(np.concatenate([*found, [size]])).astype(np.int64)
    before = np.concatenate([[0], cuts[:-1]])
    long = cuts - before > LONGEST
    if long.any():
        ties = np.concatenate([*tied, [size]])
        b, c = before[long], cuts[long]
        first = ties[np.searchsorted(ties, b, side="right")]
        first = np.where(first < c, first, np.minimum(b + LONGEST, c))
        extra = [np.arange(f, e, LONGEST) for f, e in zip(first, c)]
        # A tie may lie far behind the cut before it.
        extra += [np.arange(x + LONGEST, f, LONGEST) for x, f in zip(b, first)]
        cuts = np.unique(np.concatenate([cuts, *extra]))
    while (inside := (raw[np.minimum(cuts, size - 1)] & 0xC0 == 0x80) & (cuts < size)).any():
        cuts = cuts + inside  # on to the end of the character
    return np.unique(cuts)


def _words_before(data: bytes, places: np.ndarray) -> np.ndarray:
    """How many words begin before each place; words are parted by ASCII blanks."""
    raw = np.frombuffer(data, dtype=np.uint8)
    blank = (raw == 0x20) | (raw - 9 < 5)
    begins = ~blank
    begins[1:] &= blank[:-1]
    return np.concatenate([[0], np.cumsum(begins)])[places]


def _chunk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_128_digest
    for batch in batches:
        owner, starts, ends, digests, words = [], [], [], [], []
        for row, text in enumerate(batch.column("_text").to_pylist()):
            data = text.encode("utf-8")
            stop = cut_points(data)
            if len(stop):
                begin = np.concatenate([[0], stop[:-1]])
                owner.append(np.full(len(stop), row))
                words.append(_words_before(data, stop) - _words_before(data, begin))
                starts.append(begin)
                ends.append(stop)
                pairs = zip(begin.tolist(), stop.tolist())
                digests.append(b"".join([digest(data[i:j]) for i, j in pairs]))
        if not owner:
            continue
        halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
        begin, stop = np.concatenate(starts), np.concatenate(ends)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(np.concatenate(owner))),
                pa.array(begin.astype(np.int32)),
                pa.array((stop - begin).astype(np.int32)),
                pa.array(np.ascontiguousarray(halves[:, 0])),
                pa.array(halves[:, 1].astype(np.int32)),
                pa.array(np.concatenate(words).astype(np.int32)),
            ],
            ["doc_id", "start", "size", "h1", "h2", "words"],
        )


def text_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, start, size, h1, h2, words) of every chunk; offsets count UTF-8 bytes, ``words`` the
    words that begin in the chunk."""
    text_batches(docs.sparkSession)
    texts = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint"), whole_text().alias("_text")
    )
    return texts.mapInArrow(
        _chunk_batches, "doc_id bigint, start int, size int, h1 bigint, h2 int, words int"
    )


def _seeds(docs: DataFrame) -> DataFrame:
    """Runs of repeated chunks: (doc_id, start, size, words, owned, n_chunks, first_doc_id), and the
    place in another document of their first chunk (``left``) and last chunk's end (``right``)."""
    chunks = materialize(text_chunks(docs), "chunks")
    met = chunks.groupBy("h1").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("h1")
    # Written first: then both sides are shuffled for the join, and a hot chunk can be split.
    again = chunks.join(materialize(met, "repeated"), "h1")
    again = materialize(again.distinct(), "met-chunks")
    place, back = F.struct("doc_id", "start"), F.struct("doc_id", (-F.col("start")).alias("back"))
    # Of the first and of the last document that holds a chunk, its first and its last place there.
    owners = (
        again.groupBy("h1", "h2")
        .agg(
            F.min(place).alias("_first"), F.min(back).alias("_first_back"),
            F.max(place).alias("_last"), F.max(back).alias("_last_back"),
        )
        .where("_first.doc_id <> _last.doc_id")
    )
    owned = F.col("doc_id") == F.col("_first.doc_id")
    rows = join_per_key(again, owners, ["h1", "h2"], "inner").select(
        "doc_id", "start", "size", "words", F.col("_first.doc_id").alias("_owner"), owned.alias("owned"),
        F.when(owned, F.col("_last.doc_id")).otherwise(F.col("_first.doc_id")).alias("_mate"),
        F.when(owned, -F.col("_last_back.back")).otherwise(F.col("_first.start")).alias("_mate_begin"),
        F.when(owned, F.col("_last.start")).otherwise(-F.col("_first_back.back")).alias("_mate_end"),
    )
    # One document's chunks lie together, as its text did in one row.
    doc = Window.partitionBy("doc_id").orderBy("start", "size")
    gap = F.col("start") != F.lag(F.col("start") + F.col("size")).over(doc)
    turns = F.coalesce(gap | (F.col("owned") != F.lag("owned").over(doc)), F.lit(True))
    left = F.struct(F.col("_mate").alias("doc_id"), F.col("_mate_begin").alias("start"))
    right = F.struct(F.col("_mate").alias("doc_id"), (F.col("_mate_end") + F.col("size")).alias("start"))
    return (
        rows.withColumn("_part", F.sum(turns.cast("int")).over(doc))
        .groupBy("doc_id", "_part")
        .agg(
            F.min("start").alias("start"),
            F.sum("size").cast("int").alias("size"),
            F.sum("words").cast("int").alias("words"),
            F.min("_owner").alias("first_doc_id"),
            F.count(F.lit(1)).cast("int").alias("n_chunks"),
            F.first("owned").alias("owned"),
            F.min_by(left, "start").alias("left"),
            F.max_by(right, "start").alias("right"),
        )
        .drop("_part")
    )


def _contexts(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """(doc_id, at, ends, bytes): what lies before every place that a seed begins at, and around every
    place that one ends at (a byte before it and what follows), in its own document and in the
    other. Texts are shuffled once, to meet their places."""
    end = F.col("start") + F.col("size")
    places = F.array(
        F.struct("doc_id", F.col("start").alias("at"), F.lit(False).alias("ends")),
        F.struct("doc_id", end.alias("at"), F.lit(True).alias("ends")),
        F.struct("left.doc_id", F.col("left.start").alias("at"), F.lit(False).alias("ends")),
        F.struct("right.doc_id", F.col("right.start").alias("at"), F.lit(True).alias("ends")),
    )
    wanted = (
        seeds.select(F.inline(places))
        .distinct()
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("at", "ends")).alias("_places"))  # some per chunk of the document
    )
    texts = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint"), whole_text().alias("_text")
    )
    met = texts.join(materialize(wanted, "places").hint("merge"), "doc_id")

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.binary())
        for batch in batches:
            out: list[list] = [[], [], [], []]
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "_text", "_places")))
            for doc_id, text, places in rows:
                data = text.encode("utf-8")
                for place in places:
                    at, ends = place["at"], place["ends"]
                    # One byte more at either end, to see whether a word goes on there.
                    near = data[max(0, at - 1) : at + CONTEXT + 1] if ends else data[max(0, at - CONTEXT - 1) : at]
                    for column, value in zip(out, (doc_id, at, ends, near)):
                        column.append(value)
            arrays = [pa.array(c, k) for c, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "at", "ends", "bytes"])

    found = met.mapInArrow(around, "doc_id bigint, at int, ends boolean, bytes binary")
    # Rows that repeat a doc_id with different texts name no bytes for sure.
    return (
        found.groupBy("doc_id", "at", "ends")
        .agg(F.min("bytes").alias("bytes"), F.max("bytes").alias("_most"))
        .where("bytes = _most")
        .drop("_most")
    )


def _grown_left(own: bytes, other: bytes) -> int:
    """Bytes by which a run grows to the left, to the beginning of a word or of the text."""
    most = min(len(own), len(other), CONTEXT)
    n = 0
    while n < most and own[-1 - n] == other[-1 - n]:
        n += 1
    while n and n < len(own) and own[-1 - n] not in _BLANKS:
        n -= 1
    return n


def _grown_right(own: bytes, other: bytes) -> int:
    """Bytes by which a run grows to the right, to the end of a word or of the text. The first byte of
    either side is the run's last."""
    most = min(len(own), len(other), CONTEXT + 1)
    n = 1
    while n < most and own[n] == other[n]:
        n += 1
    while n > 1 and n < len(own) and own[n] not in _BLANKS:
        n -= 1
    return n - 1


def _growth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("_own_left", "_other_left", "_own_right", "_other_right")
    for batch in batches:
        columns: list[list[int]] = [[], [], []]
        for near in zip(*(batch.column(c).to_pylist() for c in names)):
            own_left, other_left, own_right, other_right = (side or b"" for side in near)
            left = _grown_left(own_left, other_left) if own_left else 0
            right = _grown_right(own_right, other_right) if own_right and other_right else 0
            ahead, behind = own_left[len(own_left) - left :], own_right[1 : right + 1]
            words = len(ahead.split()) + len(behind.split())
            if behind and behind[0] not in _BLANKS and own_right[0] not in _BLANKS:
                words -= 1  # the run's last word goes on
            for column, value in zip(columns, (left, right, words)):
                column.append(value)
        kept = [c for c in batch.schema.names if not c.startswith("_")]
        arrays = [batch.column(c) for c in kept] + [pa.array(c, pa.int32()) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, [*kept, "grown_left", "grown_right", "grown_words"])


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(doc_id, start, size, first_doc_id, n_chunks, owned) of every passage that repeats across documents.

    ``first_doc_id`` is the smallest doc_id that owns one of its chunks; ``owned`` passages stand in
    the document that holds their chunks first. Rows without a doc_id, and null or empty texts, have no
    passages. Rows that repeat a doc_id count as one document: alike, they change nothing; if
    their texts differ, chunks of both count for it, and edges are not extended.
    """
    seeds = materialize(_seeds(docs), "seeds")
    around = materialize(_contexts(docs, seeds), "contexts")

    def side(doc: str, at: str, ends: bool, name: str) -> DataFrame:
        found = around.where(F.col("ends") == ends)
        return found.select(F.col("doc_id").alias(doc), F.col("at").alias(at), F.col("bytes").alias(name))

    met = seeds.withColumns(
        {
            "_end": F.col("start") + F.col("size"),
            "_ld": F.col("left.doc_id"), "_ls": F.col("left.start"),
            "_rd": F.col("right.doc_id"), "_rs": F.col("right.start"),
        }
    ).drop("left", "right")
    for doc, at, ends, name in (
        ("doc_id", "start", False, "_own_left"),
        ("doc_id", "_end", True, "_own_right"),
        # Another document's place may be asked for by very many runs.
        ("_ld", "_ls", False, "_other_left"),
        ("_rd", "_rs", True, "_other_right"),
    ):
        met = join_per_key(met, side(doc, at, ends, name), [doc, at], "left")
    columns = ["doc_id", "start", "size", "words", "first_doc_id", "n_chunks", "owned"]
    sides = ["_own_left", "_other_left", "_own_right", "_other_right"]
    kinds = dict(seeds.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns) + ", grown_left int, grown_right int, grown_words int"
    grown = met.select(*columns, *sides).mapInArrow(_growth, schema)
    size = F.col("size") + F.col("grown_left") + F.col("grown_right")
    return grown.where(
        (F.col("words") + F.col("grown_words") >= min_words) | (size >= min_bytes)
    ).select(
        "doc_id", (F.col("start") - F.col("grown_left")).alias("start"), size.alias("size"),
        "first_doc_id", "n_chunks", "owned",
    )


def _without_spans(texts, spans):
    for text, cut in zip(texts, spans):
        if text is None or cut is None or not len(cut):
            yield text
            continue
        data, kept, at = text.encode("utf-8"), [], 0
        for begin, size in sorted((s["start"], s["size"]) for s in cut):
            kept.append(data[at:begin])
            at = max(at, begin + size)
        kept.append(data[at:])
        yield b"".join(kept).decode("utf-8")


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``docs`` with every repeat removed from ``text`` but in the document that holds it first.

    All rows and columns stay; a text that is one large repeat becomes empty. Null texts stay
    null, and rows without a doc_id stay as they are. If rows repeat a doc_id, the spans found
    under it are removed from each of them only if the rows are alike, else from none of them.
    """
    spans = (
        repeated_runs(docs, min_words, min_bytes)
        .where(~F.col("owned"))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("start", "size")).alias("_spans"))
    )
    ambiguous = (
        docs.groupBy("doc_id")
        .agg(F.min(F.xxhash64("text")).alias("_low"), F.max(F.xxhash64("text")).alias("_high"))
        .where("_low <> _high")
        .select("doc_id")
    )
    spans = materialize(spans.join(ambiguous, "doc_id", "left_anti"), "spans")
    # The spans grow with the corpus, so the join is a merge at every size.
    marked = whole_rows(docs).join(spans.hint("merge"), "doc_id", "left")

    @F.pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd

        return pd.Series(list(_without_spans(texts, spans)), dtype=object)

    text = F.col("_row.text")
    changed = F.when(F.col("_spans").isNotNull(), cut(text, "_spans")).otherwise(text)
    return marked.withColumn("_row", F.col("_row").withField("text", changed)).select("_row.*")
