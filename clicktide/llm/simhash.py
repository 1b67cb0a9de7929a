"""Near-duplicates by SimHash fingerprints, paired with the help of pivot distance tables.

Fingerprints are 64 bits over word shingles. Equal fingerprints are collapsed first. Distinct ones
meet in nine key families: two fingerprints that differ in at most two bits agree on one of three
blocks of bits, and, of the other two blocks together, on one of three parts; a family's key is
such a block with such a part (about 35 bits). Among the fingerprints of a key, a table of their
Hamming distances to reference fingerprints (the pivots) decides: by the triangle inequality two
fingerprints within ``r`` bits have distances to any pivot that differ by at most ``r``. Rows are
sorted by the first pivot's distance, a sweep looks only at rows within ``r`` of it, a pair whose
largest coordinate difference exceeds ``r`` is discarded, and survivors are verified bit by bit.

A key with more than ``KEY_LIMIT`` fingerprints is not swept. Its fingerprints go another exact
way, linear in their number: each names itself and its 64 one-bit neighbours; two fingerprints
name a common value exactly if they differ in at most two bits, and no value has over 65 names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import text_batches, whole_rows, whole_text
from clicktide.llm.components import connected_components
from clicktide.operators.ordered import join_per_key
from clicktide.session import materialize

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
#: Number of reference fingerprints; reference j is the XXH64 of j in decimal digits.
PIVOTS = 16
#: Distinct fingerprints of one key that are swept; larger keys take the neighbour route.
KEY_LIMIT = 4096
_HASHES_AT_ONCE = 1 << 16
_BLOCKS = ((0, 21), (21, 21), (42, 22))


def fingerprint(text: str) -> int:
    """SimHash of a text as an unsigned integer.

    A-Z is lowered; words are separated by ASCII blanks; every shingle counts, repeats included.
    With fewer words than a shingle has, the whole sequence is the only one; without words the
    fingerprint is zero. A bit is set if it is set in more than half of the hashes.
    """
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    begin = np.zeros(len(words), dtype=np.int64)
    np.cumsum(size[:-1] + 1, out=begin[1:])
    end = begin + size
    if len(words) < SHINGLE_WORDS:
        starts, stops = [0], [len(line)]
    else:
        starts = begin[: len(words) - SHINGLE_WORDS + 1].tolist()
        stops = end[SHINGLE_WORDS - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), _HASHES_AT_ONCE):
        part = zip(starts[at : at + _HASHES_AT_ONCE], stops[at : at + _HASHES_AT_ONCE])
        hashes = np.array([digest(line[i:j], SEED) for i, j in part], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > len(starts)).tolist()))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [fingerprint(t) for t in batch.column("_text").to_pylist()]
        signed = np.array(values, dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(signed)], ["doc_id", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; fp holds the 64 bits as a signed bigint."""
    text_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("_text"))
    return texts.mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


def pivot_references() -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(str(j), SEED) for j in range(PIVOTS)], dtype=np.uint64)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _bits(low: int, width: int):
    return F.shiftrightunsigned("fp", low).bitwiseAND((1 << width) - 1)


def _key_families():
    """The nine keys of a fingerprint, each with its family's number in the top bits."""
    keys = []
    for b, (low, width) in enumerate(_BLOCKS):
        (low1, width1), (low2, width2) = [x for i, x in enumerate(_BLOCKS) if i != b]
        rest = F.shiftleft(_bits(low2, width2), width1).bitwiseOR(_bits(low1, width1))
        rest_width = width1 + width2
        cuts = [0, rest_width // 3, 2 * rest_width // 3, rest_width]
        for p in range(3):
            part_width = cuts[p + 1] - cuts[p]
            part = F.shiftrightunsigned(rest, cuts[p]).bitwiseAND((1 << part_width) - 1)
            own = F.shiftleft(_bits(low, width), part_width).bitwiseOR(part)
            keys.append(own + F.lit((3 * b + p) << 48))
    return F.array(*keys)


class _Stars:
    """Disjoint sets over row numbers; gives one edge from each row to the first of its set."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        """Merge the sets of i[k] and j[k] for all k."""
        while len(i):
            a, b = self._find(i), self._find(j)
            apart = a != b
            i, j = i[apart], j[apart]
            np.minimum.at(self.root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])

    def _find(self, i: np.ndarray) -> np.ndarray:
        r = self.root[i]
        while True:
            up = self.root[r]
            if np.array_equal(up, r):
                self.root[i] = r
                return r
            r = up


def sweep(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges that connect all rows of equal key whose fingerprints are within ``max_bits``.

    Rows come sorted by key and then by their distance to the first pivot.
    """
    table = np.bitwise_count(fp[:, None] ^ pivot_references()[None, :]).astype(np.int8)
    lead = table[:, 0]
    sets = _Stars(len(fp))
    active, shift = np.arange(len(fp)), 1
    while True:
        active = active[active + shift < len(fp)]
        other = active + shift
        near = (key[active] == key[other]) & (lead[other] - lead[active] <= max_bits)
        active, other = active[near], other[near]
        if not len(active):
            break
        spread = np.abs(table[active] - table[other]).max(axis=1)
        i, j = active[spread <= max_bits], other[spread <= max_bits]
        true = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
        sets.join(i[true], j[true])
        shift += 1
    every = np.arange(len(fp))
    root = sets._find(every)
    return fp[root != every], fp[root[root != every]]


def _sweeper(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)

        def edges(k, f):
            a, b = sweep(k, f, max_bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
            )

        for batch in batches:
            key = np.concatenate([key, batch.column("key").to_numpy()])
            new = batch.column("fp").to_numpy().astype(np.int64).view(np.uint64)
            fp = np.concatenate([fp, new])
            # The last key may go on in the next batch.
            done = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if done:
                yield edges(key[:done], fp[:done])
                key, fp = key[done:], fp[done:]
        if len(key):
            yield edges(key, fp)

    return run


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS, key_limit: int = KEY_LIMIT):
    """Edges (a, b) that connect exactly the fingerprints reachable by links of <= 2 bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the key families are complete for at most two differing bits")
    first = F.lit(_signed(int(pivot_references()[0])))
    keyed = distinct.select("fp", F.explode(_key_families()).alias("key"))
    hot = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > key_limit)
    hot = materialize(hot.select("key"), "hot-keys")
    swept = (
        keyed.join(hot, "key", "left_anti")
        .withColumn("lead", F.bit_count(F.col("fp").bitwiseXOR(first)))
        .repartition("key")
        .sortWithinPartitions("key", "lead")
        .select("key", "fp")
        .mapInArrow(_sweeper(max_bits), "a bigint, b bigint")
    )
    # The neighbour route: values named by two or more fingerprints of overfull keys.
    flips = [F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)]
    named = (
        keyed.join(hot, "key", "left_semi")
        .select("fp")
        .distinct()
        .select("fp", F.explode(F.array("fp", *flips)).alias("name"))
    )
    stars = (
        named.groupBy("name")
        .agg(F.collect_list("fp").alias("fps"))  # at most 65 fingerprints have a name in common
        .where(F.size("fps") > 1)
        .select(F.array_min("fps").alias("b"), F.explode("fps").alias("a"))
        .where("a != b")
    )
    if max_bits < 2:
        stars = stars.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return swept.unionByName(stars.select("a", "b"))


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, key_limit: int = KEY_LIMIT):
    """(doc_id, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id that can be reached by links of at most ``max_bits``
    differing bits. Null and empty texts have fingerprint zero and are linked like any other;
    repeated rows stay repeated; a null doc_id keeps its row, and its component has the smallest
    id that is not null (null if there is none). Other columns of ``docs`` are ignored.
    """
    rows = materialize(fingerprints(docs), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = connected_components(fingerprint_links(distinct.select("fp"), max_bits, key_limit))
    labelled = distinct.join(
        roots.withColumnRenamed("node", "fp"), "fp", "left"
    ).withColumn("root", F.coalesce("root", "fp"))
    smallest = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = labelled.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return join_per_key(rows, by_fp, ["fp"], "inner").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """``docs`` without the near-duplicates of a document with a smaller doc_id.

    One document of each group stays, the one with the smallest doc_id, with all its columns. Rows
    that repeat a kept doc_id stay too if they differ from it, and once if they are alike. Rows
    without a doc_id stay, for nothing names them.
    """
    per_id = (
        near_duplicates(docs)
        .groupBy("doc_id")
        .agg(
            F.max(F.col("doc_id") == F.col("component_id")).alias("leads"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("doc_id IS NOT NULL AND (NOT leads OR n > 1)")
        .select("doc_id", F.col("leads").alias("_leads"))
    )
    # Written first, so that Spark knows its size and broadcasts it only if it is small.
    marked = whole_rows(docs).join(materialize(per_id, "decisions"), "doc_id", "left")
    once = marked.where("_leads IS NULL").select("_row.*")
    repeated = marked.where("_leads").select("_row.*").dropDuplicates()
    return once.unionByName(repeated)
