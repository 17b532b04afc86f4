"""Custom per-key state on streams.

Statistics whose state is an aggregation buffer (sums, moments, histogram
counts, registers) run as native streaming aggregations.  Bounded top-k and
bottom-j lists do not: they use ``transformWithState`` with a
``StatefulProcessor``, the user-defined update function, with state kept in the
RocksDB state store and checkpointed with the query.  Keys reach the processor as
typed rows, so large ids beside NULLs stay what they are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from mergestat.operators.kalman import run_starts

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# The driver-side worker that prepares a state operator gets no shipped files, so
# processors of this module travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
#: Rows that a task of the pre-reduction holds before it passes them on.
HELD_ROWS = 500_000


def use_rocksdb(spark) -> None:
    """``transformWithState`` keeps several column families per operator,
    which only the RocksDB provider supports.  Queries already checkpointed
    keep the provider recorded in their checkpoint."""
    if "RocksDB" not in (spark.conf.get(PROVIDER_KEY, "") or ""):
        spark.conf.set(PROVIDER_KEY, ROCKSDB)


def stateful(df: DataFrame, keys: Sequence[str], processor: StatefulProcessor,
             output_schema: T.StructType | str, mode: str = "Update", initial: DataFrame | None = None,
             time_mode: str = "None") -> DataFrame:
    """Run a per-key state function over a (streaming) DataFrame.

    ``initial``, one row a key, goes to the function's ``handleInitialState`` before
    the first rows, so a batch result goes on as a stream.  Functions with timers or
    expiry need ``time_mode`` "ProcessingTime".
    """
    use_rocksdb(df.sparkSession)
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=output_schema, outputMode=mode, timeMode=time_mode,
        initialState=None if initial is None else initial.groupBy(*keys))


def local_extremes(keys: Sequence[str], value: str, k: int, j: int):
    """Stateless pre-reduction for ``mapInArrow``: a task keeps the k largest and
    j smallest values of every key over all its batches and sends them on once,
    so a hot key ships at most k + j rows per task to the state operator."""
    keys = list(keys)

    def cut(t: pa.Table) -> pa.Table:
        t = t.sort_by([*[(c, "ascending") for c in keys], (value, "ascending")]).combine_chunks()
        if not t.num_rows:
            return t
        start = np.flatnonzero(run_starts([t.column(c).chunk(0) for c in keys], None))
        size = np.diff(np.append(start, t.num_rows))
        rank = np.arange(t.num_rows) - np.repeat(start, size)
        return t.filter(pa.array((rank < j) | (np.repeat(size, size) - rank <= k)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            v = b.column(value)
            usable = pc.and_(pc.is_valid(v), pc.invert(pc.is_nan(v))) if pa.types.is_floating(v.type) else pc.is_valid(v)
            t = pa.Table.from_batches([b]).filter(pc.fill_null(usable, False))
            held = cut(t if held is None else pa.concat_tables([held, t]))
            if held.num_rows > HELD_ROWS:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()
    return run


class ExtremesProcessor(StatefulProcessor):
    """Running k largest / j smallest values of one key (multiset)."""

    def __init__(self, keys: Sequence[str], value: str, k: int = 4, j: int = 3, kind: T.DataType = T.DoubleType()):
        self.keys, self.value, self.k, self.j, self.kind = list(keys), value, k, j, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("largest", T.ArrayType(self.kind)),
                               T.StructField("smallest", T.ArrayType(self.kind))])
        self.state = handle.getValueState("extremes", schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        big, small = map(list, self.state.get()) if self.state.exists() else ([], [])
        for r in rows:                          # few: at most k + j of each task
            big = sorted([*big, r[self.value]], reverse=True)[:self.k]
            small = sorted([*small, r[self.value]])[:self.j]
        self.state.update((big, small))
        for side, values in (("largest", big), ("smallest", small)):
            for rank, v in enumerate(values, 1):
                yield Row(**dict(zip(self.keys, key)), side=side, rank=rank, **{self.value: v})

    def close(self) -> None:
        pass


def extremes_schema(key_fields: Sequence[T.StructField], value: str, kind: T.DataType = T.DoubleType()) -> T.StructType:
    return T.StructType([*key_fields, T.StructField("side", T.StringType()),
                         T.StructField("rank", T.LongType()), T.StructField(value, kind)])


MOMENTS = T.StructType([T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType()), T.StructField("m2", T.DoubleType())])


class MomentsProcessor(StatefulProcessor):
    """Running count, mean and population variance of one key.

    Starts from a state (key..., n, mean, m2) where one is given.  State is never
    dropped (W4) unless asked for: with ``ttl_ms`` the store forgets a state that was not
    updated for so long, and with ``idle_ms`` a timer ends a key that got no rows for so
    long, whose last state then comes out once more with ``ended`` true.
    """

    def __init__(self, keys: Sequence[str], value: str, ttl_ms: int | None = None, idle_ms: int | None = None):
        self.keys, self.value, self.ttl, self.idle = list(keys), value, ttl_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("moments", MOMENTS, self.ttl) if self.ttl else handle.getValueState("moments", MOMENTS)

    def _row(self, key, ended: bool) -> Row:
        n, mean, m2 = self.state.get()
        return Row(**dict(zip(self.keys, key)), n=n, mean=mean if n else None, variance=m2 / n if n else None, ended=ended)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        n = initialState["n"] or 0
        self.state.update((n, initialState["mean"] if n else 0.0, initialState["m2"] if n else 0.0))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n, mean, m2 = self.state.get() if self.state.exists() else (0, 0.0, 0.0)
        for r in rows:
            v = r[self.value]
            if v is not None:
                n += 1
                d = v - mean
                mean += d / n
                m2 += d * (v - mean)
        self.state.update((n, float(mean), float(m2)))
        if self.idle:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle)
        yield self._row(key, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.state.exists():
            yield self._row(key, True)
            self.state.clear()

    def close(self) -> None:
        pass


def moments_schema(key_fields: Sequence[T.StructField]) -> T.StructType:
    return T.StructType([*key_fields, T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType()),
                         T.StructField("variance", T.DoubleType()), T.StructField("ended", T.BooleanType())])


class CountsProcessor(StatefulProcessor):
    """Running counts of one key's slots, a map state: only the slots that a batch
    touches are read and written.  Starts from rows (key..., slots: array of (slot, count))."""

    def __init__(self, keys: Sequence[str], slot: str):
        self.keys, self.slot = list(keys), slot

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", T.StructType([T.StructField("slot", T.IntegerType())]),
                                         T.StructType([T.StructField("count", T.LongType())]))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for s in initialState["slots"]:
            self.counts.updateValue((int(s["slot"]),), (int(s["count"]),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new: dict[int, int] = {}
        for r in rows:
            if r[self.slot] is not None:
                new[r[self.slot]] = new.get(r[self.slot], 0) + 1
        for slot, n in sorted(new.items()):
            n += self.counts.getValue((slot,))[0] if self.counts.containsKey((slot,)) else 0
            self.counts.updateValue((slot,), (n,))
            yield Row(**dict(zip(self.keys, key)), slot=slot, count=n)

    def close(self) -> None:
        pass
