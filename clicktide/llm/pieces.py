"""SentencePiece encoding and decoding by a merge-type prefix table.

For byte-pair models with scores, every prefix of a text has one encoding, and so one last token.
An automaton over all pieces gives the pieces that end at each position; one of them is the
prefix's last token: the piece that is compatible with the last token of the prefix before it. Two
tokens are compatible if merging by score could not have joined anything across their border.
The ids are then read off the table backwards. The work grows with the text's length only, also
where there are no blanks.

No piece holds a blank after another character, and line ends are no piece, so texts are taken in
units that end before each of them. Frequent units are remembered per Python worker, up to
``UNIT_CACHE`` of them.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import text_batches, whole_text

UNIT_CACHE = 300_000
_BLANK = "▁"
_UNIT = re.compile(" *[^ \n]+|\n| +")
_NEVER = float("inf")


class PrefixTable:
    """Tables of one model, built once per Python worker."""

    def __init__(self, model: str) -> None:
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.piece: list[str | bytes | None] = []  # bytes for byte pieces, None for control ids
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id: dict[int, int] = {}
        for i in range(sp.get_piece_size()):
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(text[3:5], 16)] = i
                self.piece.append(bytes([int(text[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.piece.append(" ⁇ " if sp.is_unknown(i) else None)
            else:
                self.piece.append(text)
                self.id[text] = i
                self.rank[text] = -sp.get_score(i)
        if any(_BLANK in p.lstrip(_BLANK) for p in self.id) or any("\n" in p for p in self.id):
            raise ValueError("a piece goes on over a blank or a line end")
        # Runs of blanks have the worst score of all and are merged last, from the left.
        self.runs = {len(p): i for p, i in self.id.items() if set(p) == {_BLANK}}
        self.longest_run = max(self.runs)
        self._compatible: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        self.left: dict[int, list[tuple[str, float]]] = {}
        self.right: dict[int, list[tuple[str, float]]] = {}
        splits = {}
        for text in sorted(self.id, key=len):
            if len(text) > 1 and set(text) == {_BLANK}:
                continue
            split = self._last_merge(text)
            if split is None:
                continue  # merging by score never gives this piece
            splits[text] = split
            token = self.id[text]
            self.left[token] = self._spine(text, splits, 0)
            self.right[token] = self._spine(text, splits, 1)
            self.automaton.add_word(text, (token, len(text)))
        self.automaton.make_automaton()
        self.cache: dict[str, tuple[bytes, str]] = {}

    def _last_merge(self, text: str) -> tuple[str, ...] | None:
        """The two parts that ``text`` is merged from at last; () for one character."""
        parts, last = list(text), ()
        while len(parts) > 1:
            pairs = [(self.rank.get(a + b, _NEVER), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, k = min(pairs)
            if rank == _NEVER:
                return None
            last = (parts[k], parts[k + 1])
            parts[k : k + 2] = ["".join(last)]
        return last

    def _spine(self, text: str, splits: dict, side: int) -> list[tuple[str, float]]:
        """The edge symbols of a token from its first to the whole, each with the rank that ends it."""
        spine, until = [], _NEVER
        while True:
            spine.append((text, until))
            until = self.rank[text]
            if not splits.get(text):
                return spine[::-1]
            text = splits[text][side]

    def compatible(self, a: int, b: int) -> bool:
        """Whether token b can follow token a: no merge across their border comes in time."""
        key = a << 20 | b
        known = self._compatible.get(key)
        if known is None:
            if len(self._compatible) > 2_000_000:
                self._compatible.clear()
            known = self._compatible[key] = self._border_holds(self.right[a], self.left[b])
        return known

    def _border_holds(self, right: list, left: list) -> bool:
        i = j = 0
        while True:
            (u, u_ends), (v, v_ends) = right[i], left[j]
            rank = self.rank.get(u + v)
            # Of equal ranks the leftmost merge comes first: u's own, then the border's, then v's.
            if rank is not None and rank < u_ends and rank <= v_ends:
                return False
            if u_ends == v_ends == _NEVER:
                return True
            if u_ends <= v_ends:
                i += 1
            else:
                j += 1

    def _known(self, text: str) -> list[int]:
        """Ids of a text whose characters are all pieces, with a blank at most in front."""
        last: list[tuple[int, int] | None] = [None] * (len(text) + 1)
        compatible, cache = self.compatible, self._compatible
        for end, match in self.automaton.iter(text):
            end += 1
            if last[end] is None:
                begin = end - match[1]
                if begin:
                    before = last[begin]
                    if before is None:
                        continue
                    fits = cache.get(before[0] << 20 | match[0])
                    if fits is None:
                        fits = compatible(before[0], match[0])
                    if not fits:
                        continue
                last[end] = match
        ids, at = [], len(text)
        while at:
            token, size = last[at]
            ids.append(token)
            at -= size
        ids.reverse()
        return ids

    def _blanks(self, n: int) -> list[int]:
        """Ids of a run of blanks: of equal scores the leftmost pair is merged first, so the run
        is eaten up from the left, by the longest piece that its rest allows."""
        whole, rest = divmod(n, self.longest_run)
        ids = [self.runs[self.longest_run]] * whole
        while rest:
            size = max(k for k in self.runs if k <= rest)
            ids.append(self.runs[size])
            rest -= size
        return ids

    def unit_ids(self, unit: str) -> list[int]:
        """Ids of blanks followed by other characters (either may be missing)."""
        word = unit.lstrip(_BLANK)
        blanks, ids, part = len(unit) - len(word), [], _BLANK if len(word) < len(unit) else ""
        for c in word:
            if c in self.id:
                part += c
                continue
            ids += self._known(part) if part else []
            part = ""
            ids += [self.byte_id[b] for b in c.encode("utf-8")]
        ids += self._known(part) if part else []
        if blanks > 1:
            # The last blank may belong to the word; all blanks left over form runs.
            alone = ids[0] == self.runs[1]
            ids = self._blanks(blanks if alone else blanks - 1) + (ids[1:] if alone else ids)
        return ids

    def _unit(self, unit: str) -> tuple[bytes, str]:
        ids = self.unit_ids(unit)
        made = struct.pack(f"<{len(ids)}I", *ids), self.surface(ids)
        if len(self.cache) < UNIT_CACHE and len(unit) < 64:
            self.cache[unit] = made
        return made

    def surface(self, ids: list[int]) -> str:
        """Text of ids, blanks included; control ids have none."""
        out, pending = [], b""
        for i in ids:
            p = self.piece[i]
            if isinstance(p, bytes):
                pending += p
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending = b""
            if p is not None:
                out.append(p)
        out.append(pending.decode("utf-8", "replace"))
        return "".join(out).replace(_BLANK, " ")

    def encode_decode(self, text: str) -> tuple[bytes, str]:
        """(ids as little-endian unsigned 32-bit integers with begin and end, their text)."""
        units: list[tuple[bytes, str]] = []
        if text:
            get, make = self.cache.get, self._unit
            for unit in _UNIT.findall(" " + text.replace(_BLANK, " ")):
                unit = unit.replace(" ", _BLANK)
                units.append(get(unit) or make(unit))
        ids = [struct.pack("<I", self.bos), *[u[0] for u in units], struct.pack("<I", self.eos)]
        # The first blank was put in front by the encoder.
        return b"".join(ids), "".join([u[1] for u in units])[1:]

    def decode(self, ids: list[int]) -> str:
        """Text of any ids; one blank in front of the first piece is the encoder's own."""
        text = self.surface(ids)
        first = next((self.piece[i] for i in ids if self.piece[i] is not None), "")
        return text[1:] if isinstance(first, str) and first.startswith(_BLANK) else text


@lru_cache(maxsize=2)
def prefix_table(model: str) -> PrefixTable:
    return PrefixTable(model)


def encode_decode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, decoded) of every row of ``docs`` under the model file at ``model``.

    ``ids`` is binary: little-endian unsigned 32-bit integers with begin and end id. A null text
    counts as empty and has those two ids only. Rows are neither merged nor dropped; other columns
    are ignored. ``model`` must exist on every machine, like the library that reads it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(model)
        for batch in batches:
            made = [table.encode_decode(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([m[0] for m in made], pa.binary()),
                    pa.array([m[1] for m in made], pa.string()),
                ],
                ["doc_id", "ids", "decoded"],
            )

    text_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("_text"))
    return texts.mapInArrow(run, "doc_id bigint, ids binary, decoded string")
