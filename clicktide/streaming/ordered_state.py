"""Keyed state that sees a stream's rows in the order of time, however they fall into batches.

A row waits in state until the watermark has passed it; an event-time timer then takes the waiting
rows in order through a step, which carries a state of each key from row to row. Keys share a number of
buckets, so that Python works on tables of rows, not on single rows or keys. Rows wait in pieces that
are sorted by time; a timer reads only the pieces that are due, and holds only those whose times
overlap. Keyed state with timers needs the RocksDB state store (see ``run.rocksdb_state``).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: ``step(rows, starts, states)``: rows in order, key after key; the first row of each key; the states of
#: these keys, None at first. It gives the keys' next states and the columns added to the rows.
Step = Callable[[pa.Table, np.ndarray, list], tuple[list, list[pa.Array]]]

#: Keys are spread over so many groups of state.
BUCKETS = 512
#: Rows that are sorted by time together, and rows of one piece of them.
SORTED_ROWS, PIECE_ROWS = 200_000, 10_000


class InTimeOrder(StatefulProcessor):
    def __init__(
        self, keys: Sequence[str], waiting: T.StructType, out: T.StructType, order: Sequence[str], step: Step,
        idle_ms: int | None,
    ) -> None:
        self.keys, self.names, self.schema = list(keys), waiting.names, to_arrow_schema(waiting)
        self.out, self.order, self.step, self.idle_ms = out, list(order), step, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "low_ms bigint, number bigint", "rows binary")
        self.state = handle.getValueState("state", "held binary")
        self.clock = handle.getValueState(
            "clock", "wake_ms bigint, next bigint, lows array<bigint>, numbers array<bigint>"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wake, number, pieces = self._pieces()
        held, size = [], 0
        for batch in rows:
            held.append(pa.Table.from_pandas(batch[self.names], self.schema, preserve_index=False))
            size += len(batch)
            if size >= SORTED_ROWS:
                number = self._put(pa.concat_tables(held), number, pieces)
                held, size = [], 0
        if size:
            number = self._put(pa.concat_tables(held), number, pieces)
        if pieces:
            lowest = min(pieces)[0]
            self._set_clock(wake, lowest if wake is None else min(wake, lowest), number, pieces)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        wake, number, pieces = self._pieces()
        pieces.sort()
        due = [p for p in pieces if p[0] <= now]
        later = pieces[len(due) :]
        states = pickle.loads(self.state.get()[0]) if self.state.exists() else {}
        held, size, enough = [], 0, SORTED_ROWS
        for at, piece in enumerate(due):
            table = _unpack(self.waiting.getValue(piece)[0])
            self.waiting.removeKey(piece)
            held.append(table)
            size += table.num_rows
            last = at + 1 == len(due)
            if last or size >= enough:
                table = pa.concat_tables(held)
                passed = pc.less(table["ms"], now + 1 if last else due[at + 1][0])
                yield from self._take(table.filter(passed), states)
                held = [table.filter(pc.invert(passed))]
                size = held[0].num_rows
                enough = max(SORTED_ROWS, 2 * size)
        if size:
            number = self._put(held[0], number, later)
        if self.idle_ms is not None:
            # What comes now is later than the watermark: an idle key's state would not matter to it.
            states = {k: s for k, s in states.items() if s[0] + self.idle_ms > now}
        if states:
            self.state.update((pickle.dumps(states, pickle.HIGHEST_PROTOCOL),))
        else:
            self.state.clear()
        if later:
            self._set_clock(wake, min(later)[0], number, later)
        elif states and self.idle_ms is not None:
            self._set_clock(wake, max(s[0] for s in states.values()) + self.idle_ms, number, later)
        else:
            self.clock.clear()

    def _take(self, rows: pa.Table, states: dict) -> Iterator[pd.DataFrame]:
        """Rows with what the step adds; ``states`` holds (last ms, state) by key."""
        if not rows.num_rows:
            return
        by = [(c, "ascending") for c in dict.fromkeys([*self.keys, *self.order])]
        # Nulls first, as in Spark's own ascending order.
        rows = rows.take(pc.sort_indices(rows, by, null_placement="at_start")).combine_chunks()
        starts = _starts(rows, self.keys)
        keys = list(zip(*[rows[k].take(starts).to_pylist() for k in self.keys]))
        found = [states.get(k) for k in keys]
        next_states, added = self.step(rows, starts, [None if f is None else f[1] for f in found])
        ends = np.append(starts[1:], rows.num_rows) - 1
        states.update(zip(keys, zip(rows["ms"].to_numpy()[ends].tolist(), next_states)))
        made = pa.table([*rows.columns, *added], names=self.out.names)
        for at in range(0, made.num_rows, PIECE_ROWS):
            yield made.slice(at, PIECE_ROWS).to_pandas(types_mapper=pd.ArrowDtype)

    def _put(self, rows: pa.Table, number: int, pieces: list) -> int:
        """Keep rows in sorted pieces, which are added to ``pieces``; the next free number."""
        rows = rows.take(pc.sort_indices(rows["ms"])).combine_chunks()
        for at in range(0, rows.num_rows, PIECE_ROWS):
            piece = rows.slice(at, PIECE_ROWS)
            place = (piece["ms"][0].as_py(), number)
            self.waiting.updateValue(place, (_pack(piece),))
            pieces.append(place)
            number += 1
        return number

    def _pieces(self) -> tuple[int | None, int, list[tuple[int, int]]]:
        """When the timer is due, the next piece's number, and the pieces' places."""
        if not self.clock.exists():
            return None, 0, []
        wake, number, lows, numbers = self.clock.get()
        return wake, number, list(zip(lows, numbers))

    def _set_clock(self, before: int | None, at: int, number: int, pieces: list) -> None:
        if before != at:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(at)
        self.clock.update((at, number, [p[0] for p in pieces], [p[1] for p in pieces]))

    def close(self) -> None:
        pass


def _pack(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(packed)).read_all()


def _starts(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Places of the first row of each key; null is a key like others."""
    new = np.zeros(rows.num_rows, dtype=bool)
    new[0] = True
    for k in keys:
        codes = rows[k].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def in_time_order(
    rows: DataFrame,
    keys: Sequence[str],
    time: str,
    columns: Sequence[str],
    order: Sequence[str],
    added: T.StructType,
    step: Step,
    idle_ms: int | None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``keys``, ``ms`` (of ``time``), ``columns`` and what ``step`` adds, for append mode.

    ``rows`` has a watermark on ``time``. Rows at one time are taken by ``order``. A key's state is
    dropped when it has been idle for ``idle_ms`` and its bucket is next at work, never if that is None.
    A bucket's waiting rows meet in one task, which holds those of overlapping pieces only; the states
    of its keys are read and written together, so ``buckets`` should grow with the number of keys
    that are active at a time (some thousand keys a bucket are fine).
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("__bucket")
    timed = rows.select(bucket, *keys, time, F.unix_millis(time).alias("ms"), *columns)
    waiting = T.StructType([timed.schema[c] for c in [*keys, "ms", *columns]])
    out = T.StructType([*waiting.fields, *added.fields])
    processor = InTimeOrder(keys, waiting, out, order, step, idle_ms)
    return timed.groupBy("__bucket").transformWithStateInPandas(processor, out, "Append", "EventTime")
