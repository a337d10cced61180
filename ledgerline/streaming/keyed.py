"""Keyed state over streams: the rows of each key in order, whatever their number, one bounded part at a time.

Spark hands a key's rows of a batch over in frames of no particular order. One frame is sorted and judged at
once. More than one are sorted into runs that go to the state store in small parts (RocksDB: on disk, and
let go with the batch), and are merged from there, so that memory holds a part of each run and never a whole key.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterable, Iterator, MutableMapping, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Rows of a run and of a stored part. Memory holds a run, or a part of each run: 2,000 rows for each 200,000 of a key.
RUN, PART = 200_000, 2_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"

#: (state, rows in order) -> (state, rows to give back)
Step = Callable[[tuple, pd.DataFrame], tuple[tuple, pd.DataFrame]]


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


def in_order(frames: Iterable[pd.DataFrame], seq: str, store: MutableMapping[tuple[int, int], bytes], run: int = RUN, part: int = PART) -> Iterator[pd.DataFrame]:
    """The rows of ``frames`` by ``seq``, in parts; ``store`` takes what waits, by run and part, and is empty at the end.

    Rows of equal ``seq`` come in any order among themselves.
    """
    frames = iter(frames)
    first, second = next(frames, None), next(frames, None)
    if second is None:
        if first is not None:
            yield first.sort_values(seq, kind="stable")
        return
    sizes: list[int] = []

    def stored(rows: list[pd.DataFrame]) -> None:
        whole = pd.concat(rows).sort_values(seq, kind="stable")
        for k, at in enumerate(range(0, len(whole), part)):
            store[len(sizes), k] = _packed(whole.iloc[at : at + part])
        sizes.append(-(-len(whole) // part))

    held, count = [], 0
    for frame in chain((first, second), frames):
        held.append(frame)
        count += len(frame)
        if count >= run:
            stored(held)
            held, count = [], 0
    if held:
        stored(held)
    ahead = [0] * len(sizes)
    now: dict[int, pd.DataFrame] = {}
    while True:
        for r, size in enumerate(sizes):
            if r not in now and ahead[r] < size:
                now[r] = _unpacked(store.pop((r, ahead[r])))
                ahead[r] += 1
        if not now:
            return
        # Up to the least last row of the runs that have more parts, all runs are complete.
        ends = [rows[seq].iloc[-1] for r, rows in now.items() if ahead[r] < sizes[r]]
        last = min(ends) if ends else None
        ready = []
        for r in list(now):
            rows = now[r]
            n = len(rows) if last is None else int(np.searchsorted(rows[seq].to_numpy(), rows[seq].dtype.type(last) if not isinstance(last, pd.Timestamp) else last.to_datetime64(), side="right"))
            ready.append(rows.iloc[:n])
            now[r] = rows.iloc[n:]
            if not len(now[r]):
                del now[r]
        yield pd.concat(ready).sort_values(seq, kind="stable")


class _Store(MutableMapping):
    """A map state of Spark as a mapping from (run, part) to bytes."""

    def __init__(self, state):
        self.state = state

    def __getitem__(self, key):
        return bytes(self.state.getValue(key)[0])

    def __setitem__(self, key, value):
        self.state.updateValue(key, (value,))

    def __delitem__(self, key):
        self.state.removeKey(key)

    def __iter__(self):
        return self.state.keys()

    def __len__(self):
        return sum(1 for _ in self.state.keys())


class InOrder(StatefulProcessor):
    """Applies a step to the rows of each key in order; the state between batches is one value."""

    def __init__(self, key: str, seq: str, step: Step, state: str, initial: tuple):
        self.key, self.seq, self.step, self.schema, self.initial = key, seq, step, state, initial

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("value", self.schema)
        self.waiting = handle.getMapState("waiting", "run int, part int", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = tuple(self.value.get()) if self.value.exists() else self.initial
        for part in in_order(rows, self.seq, _Store(self.waiting)):
            state, out = self.step(state, part)
            out.insert(0, self.key, key[0])
            if len(out):
                yield out
        self.value.update(state)

    def close(self) -> None:
        pass


def stepped(stream: DataFrame, key: str, seq: str, columns: Sequence[str], step: Step, state: str, initial: tuple, out: str) -> DataFrame:
    """``step`` over each key's rows by ``seq``. ``out``: the columns that it gives back besides the key. Rows without a key or
    a place in the order are left out: they cannot be placed. Within a batch rows are put in order; batches follow one another as they come."""
    spark = stream.sparkSession
    if "RocksDB" not in spark.conf.get(_PROVIDER, ""):
        spark.conf.set(_PROVIDER, ROCKSDB)
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(key, seq, *columns).dropna(subset=[key, seq])
    return rows.groupBy(key).transformWithStateInPandas(InOrder(key, seq, step, state, initial), f"{key} {kind}, {out}", "Append", "None")
