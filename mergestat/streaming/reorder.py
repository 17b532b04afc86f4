"""Late and out-of-order observations, put in order by event time.

A reorder buffer stands before any operator that needs its rows in time order.
Rows wait in state until the watermark (largest event time seen, less the allowed
``delay``) has passed them; then all rows below it are released together.  So
what a trigger releases is later than all that was released before, whatever files
the rows came in.  A row that arrives below the watermark cannot be put in its
place any more: it comes out at once, marked ``late``, for a side table.

The buffer is state of ``transformWithState``, cut into time buckets: per key, salt and
bucket the waiting rows, sorted by the order columns, as one Arrow block.  A trigger
rewrites only the buckets that got rows or are released.  Event-time timers release
rows of keys that a trigger brings nothing for.  Release depends on the watermark alone,
which is the same for all tasks, so a key may be spread over ``salts`` groups and
a hot key is not the work of one task; what is released is sorted downstream, by
the operator's own partitioning.

Rows without a time are late.  Nothing expires: rows after the last watermark wait
until later events move it on (or a heartbeat row, with a time and no value, does).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from mergestat.streaming.stateful import use_rocksdb

cloudpickle.register_pickle_by_value(sys.modules[__name__])
SALTS, BUCKETS = 8, 4
BLOCK = T.StructType([T.StructField("rows", T.BinaryType())])
BUCKET = T.StructType([T.StructField("bucket", T.LongType())])


class Reorderer(StatefulProcessor):
    """Holds a group's rows until the watermark has passed them.

    ``schema`` is that of a row; its column ``us`` (event time in microseconds)
    and then ``order`` sort the rows of a bucket.
    """

    def __init__(self, schema: T.StructType, us: str, order: Sequence[str], bucket_us: int):
        self.names, self.arrow = schema.names, to_arrow_schema(schema)
        self.us = schema.names.index(us)
        self.order = [schema.names.index(c) for c in order]
        self.bucket = bucket_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", BUCKET, BLOCK)

    def _place(self, row: tuple):
        return row[self.us], [(row[i] is not None, row[i] if row[i] is not None else 0) for i in self.order]

    def _held(self, bucket: int) -> list[tuple]:
        table = pa.ipc.open_stream(self.waiting.getValue((bucket,))[0]).read_all()
        return list(zip(*(c.to_pylist() for c in table.columns)))

    def _hold(self, bucket: int, rows: list[tuple]) -> None:
        sink = pa.BufferOutputStream()
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), self.arrow)], schema=self.arrow)
        with pa.ipc.new_stream(sink, self.arrow) as w:
            w.write_batch(batch)
        self.waiting.updateValue((bucket,), (sink.getvalue().to_pybytes(),))

    def _row(self, values: tuple, late: bool) -> Row:
        return Row(**dict(zip(self.names, values)), late=late)

    def _release(self, below: int) -> Iterator[Row]:
        """Rows before ``below`` in order; a timer for the first of the others."""
        for b in sorted(k[0] for k in self.waiting.keys()):
            rows = self._held(b)
            ready = [r for r in rows if r[self.us] < below]
            for r in ready:
                yield self._row(r, False)
            if len(ready) < len(rows):
                if ready:
                    self._hold(b, rows[len(ready):])
                self.handle.registerTimer(rows[len(ready)][self.us] // 1000 + 1)
                return
            self.waiting.removeKey((b,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        new: dict[int, list[tuple]] = {}
        for row in rows:
            row = tuple(row[n] for n in self.names)
            if row[self.us] is None or row[self.us] < watermark:
                yield self._row(row, True)
            else:
                new.setdefault(row[self.us] // self.bucket, []).append(row)
        for b, part in new.items():
            if self.waiting.containsKey((b,)):
                part = self._held(b) + part
            self._hold(b, sorted(part, key=self._place))
        yield from self._release(watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._release(timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass


def _micros(delay: str, spark) -> int:
    return int(spark.sql(f"SELECT CAST(INTERVAL {delay} AS INTERVAL DAY TO SECOND) AS d").first()["d"].total_seconds() * 1e6)


def reordered(stream: DataFrame, keys: Sequence[str], order: Sequence[str], delay: str, salts: int = SALTS) -> DataFrame:
    """``stream`` with ``late``: rows in time order from trigger to trigger, and late rows marked.

    ``order`` begins with the event-time column; ``delay`` is an interval such as
    "2 days".  Released rows come out once the watermark has passed them.
    """
    use_rocksdb(stream.sparkSession)
    bucket = max(1, _micros(delay, stream.sparkSession) // BUCKETS)
    instants = [f.name for f in stream.schema.fields if isinstance(f.dataType, T.TimestampType)]
    marked = stream.withColumn("_event", F.col(order[0]).cast("timestamp")).withWatermark("_event", delay)
    # a time that Spark does not take for the watermarked one: the processor judges lateness itself
    held = marked.withColumn("_us", F.unix_micros(F.col("_event") + F.expr("INTERVAL 0 SECONDS"))).select(
        *[F.unix_micros(c).alias(c) if c in instants else F.col(c) for c in stream.columns], "_us",
        F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int").alias("_salt"))
    out = held.groupBy(*keys, "_salt").transformWithState(
        statefulProcessor=Reorderer(held.schema, "_us", order[1:], bucket),
        outputStructType=T.StructType([*held.schema.fields, T.StructField("late", T.BooleanType())]),
        outputMode="Append", timeMode="EventTime")
    return out.select(*[F.timestamp_micros(c).alias(c) if c in instants else F.col(c) for c in stream.columns], "late")


def split_writer(on_time, late_path: str):
    """A ``foreachBatch`` function: released rows go to ``on_time`` (another such
    function), late ones to ``late_path/batch_id=<n>``."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df = batch_df.persist()
        try:
            batch_df.where("late").drop("late").write.mode("overwrite").parquet(f"{late_path}/batch_id={batch_id}")
            ready = batch_df.where("not late").drop("late")
            if not ready.isEmpty():                                # most triggers release nothing
                on_time(ready, batch_id)
        finally:
            batch_df.unpersist()
    return write
