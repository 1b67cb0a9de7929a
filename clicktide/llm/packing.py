"""Packing token sequences into windows by the online sum-of-squares rule.

Each task packs the documents of its partition as they come, with no shuffle. A level array counts
the partially filled windows by their fill. A document goes to the fill level (or to a new window)
for which the sum of the squared counts grows least; of equal levels to the fullest. Full windows
are cut off long documents first. When a partition ends, or holds ``OPEN_WINDOWS`` partial windows,
the emptiest ones are cut up to fill the fullest ones, so that at most one window of a partition
is left partially filled.
"""

from __future__ import annotations

import json
import re
import string
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import single_threaded, text_batches, whole_text

WINDOW = 2048
OPEN_WINDOWS = 4096
END_ID = 1
#: Units that are remembered at most; the older half goes when the newer one is full.
UNIT_CACHE = 500_000
#: Units that are encoded as one string and cut apart again.
JOINED = 256
_BLANK_BYTES = b" \n\t\r"
#: Kinds of bytes: blanks, ASCII letters, other printable ASCII characters.
_KIND = {
    kind: np.isin(np.arange(256), np.frombuffer(members, dtype=np.uint8))
    for kind, members in (
        ("blank", _BLANK_BYTES),
        ("letter", string.ascii_letters.encode()),
        ("other", (string.digits + string.punctuation).encode()),
    )
}
#: Blanks that the tokenizer or Python know besides those; texts with one are encoded in one go.
_RARE_BLANK = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -     　]")


class UnitEncoder:
    """Token ids as bytes. A byte-level tokenizer never joins a character to a blank after it, nor, where
    it splits by its pattern, an ASCII letter to any other ASCII character after it. So texts are cut
    there into units, the distinct units of a batch are encoded, and recent ones are remembered."""

    def __init__(self, tokenizer: str) -> None:
        single_threaded()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        split = json.loads(self.tokenizer.to_str())["pre_tokenizer"] or {}
        self.cuts_letters = split.get("type") == "ByteLevel" and split.get("use_regex", True)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        # A token of a byte-level vocabulary is written with one letter per byte.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)

    def _encode(self, units: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([u.decode() for u in units], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _encode_joined(self, units: list[bytes]) -> list[bytes]:
        """Ids of units that end without a blank. Side by side, after a line end where they do not
        begin with a blank, they are cut where a unit's first byte begins a token and its last one
        ends one, as they must; else they are encoded one by one."""
        out: list[bytes] = []
        groups = [units[i : i + JOINED] for i in range(0, len(units), JOINED)]
        parts = [[u if u[0] in _BLANK_BYTES else b"\n" + u for u in g] for g in groups]
        joined = self.tokenizer.encode_batch_fast([b"".join(p).decode() for p in parts], add_special_tokens=False)
        for group, part, found in zip(groups, parts, joined):
            ids = np.array(found.ids, dtype="<u4")
            token_ends = np.append(0, np.cumsum(self.token_bytes[ids]))
            unit_ends = np.cumsum([len(p) for p in part])
            unit_starts = unit_ends - [len(u) for u in group]
            first, last = np.searchsorted(token_ends, unit_starts), np.searchsorted(token_ends, unit_ends)
            sides = np.minimum(np.append(first, last), len(ids))
            if (token_ends[sides] != np.append(unit_starts, unit_ends)).any() or token_ends[-1] != unit_ends[-1]:
                out += self._encode(group)
                continue
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip((4 * first).tolist(), (4 * last).tolist())]
        return out

    def _encode_units(self, units: list[bytes], alone: set[bytes]) -> list[bytes]:
        """Ids of distinct units; those ``alone`` are whole texts that must not be joined."""
        found = list(map(self.recent.get, units))
        unseen = [i for i, ids in enumerate(found) if ids is None]
        for i in unseen:
            found[i] = self.older.get(units[i])
        missing = [i for i in unseen if found[i] is None]
        joinable = [i for i in missing if units[i][-1] not in _BLANK_BYTES and units[i] not in alone]
        single = sorted(set(missing).difference(joinable))
        for places, encode in ((joinable, self._encode_joined), (single, self._encode)):
            for i, ids in zip(places, encode([units[i] for i in places])):
                found[i] = ids
        if len(self.recent) + len(unseen) > UNIT_CACHE // 2:
            self.recent, self.older = {}, self.recent
        self.recent.update([(units[i], found[i]) for i in unseen[: UNIT_CACHE // 2] if len(units[i]) < 64])
        return found

    def encode_all(self, texts: list[str]) -> list[bytes]:
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        starts = self._unit_starts(data)
        alone = set()
        for text, r, end in zip(texts, raw, ends.tolist()):
            begin = end - len(r)
            if _RARE_BLANK.search(text) or any(a in text for a in self.added):
                starts[begin:end] = False
                alone.add(r)
            if r:
                starts[begin] = True
        cuts = np.append(np.flatnonzero(starts), len(data))
        buffers = [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)]
        units = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, buffers).dictionary_encode()
        found = self._encode_units(units.dictionary.to_pylist(), alone)

        # The ids of all units side by side, in the order of the texts.
        sizes = np.array([len(ids) // 4 for ids in found], dtype=np.int64)
        codes = units.indices.to_numpy()
        lengths = sizes[codes]
        id_ends = np.append(0, np.cumsum(lengths))
        source = np.repeat((np.cumsum(sizes) - sizes)[codes] - id_ends[:-1], lengths)
        source += np.arange(id_ends[-1])
        ids = np.frombuffer(b"".join(found), dtype="<u4")[source].tobytes()
        text_ends = (4 * id_ends[np.searchsorted(cuts, ends)]).tolist()
        return [ids[a:b] for a, b in zip([0, *text_ends], text_ends)]

    def _unit_starts(self, data: np.ndarray) -> np.ndarray:
        """Whether a unit starts at a byte; the first byte of a text is not looked at."""
        blank, letter, other = (_KIND[k][data] for k in ("blank", "letter", "other"))
        starts = np.zeros(len(data), dtype=bool)
        starts[1:] = blank[1:] & ~blank[:-1]
        if self.cuts_letters:
            starts[1:] |= other[1:] & letter[:-1]
        return starts


@lru_cache(maxsize=2)
def unit_encoder(tokenizer: str) -> UnitEncoder:
    return UnitEncoder(tokenizer)


class SumOfSquares:
    """Open windows of one partition. A piece is [document, start, ids as bytes]."""

    def __init__(self, window: int = WINDOW, open_windows: int = OPEN_WINDOWS) -> None:
        self.window, self.open_windows = window, open_windows
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.at: list[list[list]] = [[] for _ in range(window)]
        self.closed: list[list] = []

    def level_for(self, size: int) -> int:
        """Fill level of the window to use, 0 for a new one."""
        n = self.count
        levels = np.flatnonzero(n[1 : self.window - size + 1]) + 1
        after = np.where(levels + size == self.window, 0, 2 * n[levels + size] + 1)
        growth = np.append(after - 2 * n[levels] + 1, 2 * n[size] + 1)
        levels = np.append(levels, 0)
        return int(levels[growth == growth.min()].max())

    def add(self, piece: list) -> None:
        document, start, ids = piece
        full = self.window * 4
        whole = len(ids) // full
        for at in range(0, whole * full, full):
            self.closed.append([[document, start + at // 4, ids[at : at + full]]])
        start, ids = start + whole * self.window, ids[whole * full :]
        if not ids:
            return
        size = len(ids) // 4
        level = self.level_for(size)
        pieces = self.at[level].pop() if level else []
        pieces.append([document, start, ids])
        if level:
            self.count[level] -= 1
        if level + size == self.window:
            self.closed.append(pieces)
            return
        self.at[level + size].append(pieces)
        self.count[level + size] += 1
        if self.count.sum() > self.open_windows:
            self.consolidate()

    def consolidate(self) -> None:
        """Fill the fullest windows from the emptiest; at most one stays open."""
        windows = [(fill, pieces) for fill, held in enumerate(self.at) for pieces in held]
        self.count[:] = 0
        self.at = [[] for _ in range(self.window)]
        low, high = 0, len(windows) - 1
        fills = [fill for fill, _ in windows]
        while low < high:
            gap = self.window - fills[high]
            source, target = windows[low][1], windows[high][1]
            document, start, ids = source[-1]
            take = min(gap, len(ids) // 4)
            cut = len(ids) - 4 * take
            target.append([document, start + cut // 4, ids[cut:]])
            if cut:
                source[-1] = [document, start, ids[:cut]]
            else:
                source.pop()
            fills[low] -= take
            fills[high] += take
            if fills[high] == self.window:
                self.closed.append(target)
                high -= 1
            if not fills[low]:
                low += 1
        if low == high:
            self.at[fills[low]].append(windows[low][1])
            self.count[fills[low]] = 1

    def take_closed(self) -> list[list]:
        closed, self.closed = self.closed, []
        return closed

    def finish(self) -> list[list]:
        self.consolidate()
        return self.take_closed() + [pieces for held in self.at for pieces in held]


_SCHEMA = (
    "doc_id bigint, start bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def pack(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, open_windows: int = OPEN_WINDOWS
) -> DataFrame:
    """(doc_id, start, ids, doc_tokens, sequence_id, offset) of every piece of every document.

    A document's ids are the tokenizer's and ``END_ID``; each of them lies in exactly one piece.
    ``ids`` is binary (little-endian unsigned 32-bit). ``start`` counts the document's ids before
    the piece, ``offset`` the ids before it in its sequence, without gaps. A null or empty text has
    the end id only; rows that repeat a doc_id, or have none, are packed like others. A sequence
    is to be padded to ``window``, unless its fill is a power of two. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = unit_encoder(tokenizer), SumOfSquares(window, open_windows)
        sequence = TaskContext.get().partitionId() << 40
        end = np.array([END_ID], dtype="<u4").tobytes()

        def rows(windows: list[list]) -> pa.RecordBatch:
            nonlocal sequence
            columns: list[list] = [[] for _ in range(6)]
            for pieces in windows:
                offset = 0
                for (doc_id, total), start, ids in pieces:
                    for column, value in zip(columns, (doc_id, start, ids, total, sequence, offset)):
                        column.append(value)
                    offset += len(ids) // 4
                sequence += 1
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _SCHEMA.split(", ")])

        for batch in batches:
            encoded = encoder.encode_all(batch.column("_text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                packer.add([(doc_id, len(ids) // 4 + 1), 0, ids + end])
            yield rows(packer.take_closed())
        yield rows(packer.finish())

    text_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("_text"))
    return texts.mapInArrow(run, _SCHEMA)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select(
        "doc_id",
        "start",
        (F.length("ids") / 4).cast("bigint").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
