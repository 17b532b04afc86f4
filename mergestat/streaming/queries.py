"""Streaming forms of the statistics (W1, W3, W4 with A2, A8, B6, H2, T3, K4).

Every function takes a streaming DataFrame and returns a streaming
DataFrame; start it with ``sinks.run``.  Aggregation-buffer statistics are
the batch functions themselves — Spark turns ``groupBy().agg()`` on a stream
into a stateful aggregation with partial aggregation before the state store,
and the finish step is a projection.  Keys untouched by a batch keep their
state (W3) and state is never dropped (W4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergestat.functions.hashing import alpha
from mergestat.functions.kalman_math import KalmanParams
from mergestat.functions.moments import higher_of
from mergestat.operators import distinct, exact, histogram, kalman, moments
from mergestat.operators.histogram import Bins
from mergestat.sources.tables import key_names
from mergestat.streaming.sinks import batch_folders
from mergestat.streaming.stateful import (CountsProcessor, ExtremesProcessor, MomentsProcessor, extremes_schema,
                                          local_extremes, moments_schema, stateful)


def stream_sum(stream: DataFrame, keys, value) -> DataFrame:
    return moments.running_sum(stream, keys, value)


def stream_variance(stream: DataFrame, keys, value) -> DataFrame:
    return moments.running_variance(stream, keys, value)


def stream_variances(stream: DataFrame, keys, value) -> DataFrame:
    """Both variances (A5 and A8) in one running state."""
    return moments.running_variances(stream, keys, value)


def stream_histogram_median(stream: DataFrame, keys, value, bins: Bins) -> DataFrame:
    return histogram.running_histogram_median(stream, keys, value, bins)


def stream_hll(stream: DataFrame, keys, value, m: int = 64, method: str = "md5") -> DataFrame:
    """Register arrays in one stateful aggregation; the estimate and its
    parts are projections of the array."""
    ks = key_names(keys)
    reg = distinct.hll_registers_wide(stream, keys, value, m, method)
    r = F.col("registers")
    z = F.aggregate(r, F.lit(0.0), lambda acc, x: acc + F.pow(F.lit(2.0), -x))
    return reg.select(
        *ks, "n",
        F.size(F.filter(r, lambda x: x == 0)).cast("bigint").alias("empty_registers"),
        (F.lit(alpha(m) * m * m) / z).alias("raw_estimate"),
        distinct.estimate_from_array(r, m, method).alias("estimate"))


def stream_hll_registers(stream: DataFrame, keys, value, m: int = 4096, method: str = "xxhash64") -> DataFrame:
    """H2 for any m: state per key and register; what the sink holds goes to
    ``distinct.hll_estimate``."""
    return distinct.hll_registers(stream, keys, value, m, method)


def stream_extremes(stream: DataFrame, keys, value: str, k: int = 4, j: int = 3) -> DataFrame:
    """Running k largest / j smallest per key (update mode).  Numbers keep
    their own type in state and output."""
    ks = key_names(keys)
    fields = [T.StructField(c, stream.schema[c].dataType, True) for c in ks]
    kind = stream.schema[value].dataType
    kind = kind if isinstance(kind, T.NumericType) else T.DoubleType()
    slim = stream.select(*ks, F.col(value).cast(kind).alias(value))
    reduced = slim.mapInArrow(local_extremes(ks, value, k, j), slim.schema)
    return stateful(reduced, ks, ExtremesProcessor(ks, value, k, j, kind),
                    extremes_schema(fields, value, kind), "Update")


def kalman_segmented_writer(keys, z: str, order: Sequence[str], out_path: str,
                            state_path: str, passthrough: Sequence[str] = (),
                            params: KalmanParams = KalmanParams(),
                            num_partitions: int | None = None):
    """K4 on a stream without one task per key: a ``foreachBatch`` function.

    Each micro-batch runs the segmented batch scan (``operators.kalman``),
    so a key holding most of a trigger's rows is cut over many partitions.
    It resumes the keys it touches from the states after the batch before it
    (``initial``), writes its trace to ``out_path/batch_id=<n>`` and the states of all
    keys, quiet ones as they were, to ``state_path/batch_id=<n>`` (S4).  A
    replayed batch overwrites both, so the output is exactly once.  Batches must
    come in time order; ``reorder.reordered`` puts them so.
    """
    ks = key_names(keys)

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        earlier = [n for n in batch_folders(spark, state_path) if n < batch_id]
        states = spark.read.parquet(f"{state_path}/batch_id={earlier[-1]}") if earlier else None
        batch_df = batch_df.persist()
        try:
            init = None
            if states is not None:
                touched = batch_df.select(*[F.col(c).alias(f"_t_{c}") for c in ks]).distinct()
                init = states.join(touched, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in ks], "left_semi")
            trace = kalman.kalman_trace(batch_df, ks, z, order, params, num_partitions,
                                        passthrough=list(passthrough), initial=init)
            out = f"{out_path}/batch_id={batch_id}"
            trace.write.mode("overwrite").parquet(out)
        finally:
            batch_df.unpersist()
        now = kalman.final_from_trace(spark.read.parquet(out), ks)
        if states is not None:
            moved = now.select(*[F.col(c).alias(f"_t_{c}") for c in ks])
            now = now.unionByName(states.join(moved, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in ks], "left_anti"))
        now.write.mode("overwrite").parquet(f"{state_path}/batch_id={batch_id}")
    return write


def batch_sum_writer(keys, value: str, out_path: str):
    """A1 on a stream: the sum per key *within* each micro-batch (not
    running), a ``foreachBatch`` function writing ``out_path/batch_id=<n>``.
    The aggregation is partial map-side like any batch ``groupBy``."""
    ks = key_names(keys)

    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.groupBy(*ks).agg(F.count(value).alias("n"), F.sum(value).alias("sum")) \
            .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
    return write


def stream_exact_sum(stream: DataFrame, keys, value) -> DataFrame:
    """A2 on a stream, independent of order: lane sums per key and exponent;
    ``exact.exact_totals`` rounds what the sink holds."""
    return exact.sum_states(stream, keys, value)


def stream_higher_moments(stream: DataFrame, keys, value) -> DataFrame:
    """A10 on a stream: running states up to the fourth moment."""
    ks = key_names(keys)
    v = F.col(value) if isinstance(value, str) else value
    return stream.groupBy(*ks).agg(higher_of(v).alias("_s")).select(*ks, "_s.*")


def stream_variance_from(stream: DataFrame, keys, value, initial: DataFrame | None = None, ttl_ms: int | None = None,
                         idle_ms: int | None = None) -> DataFrame:
    """A8 by a state function that goes on from ``initial`` states (key..., n, mean, m2),
    such as ``moments.moment_partials`` of the past; expiry is off unless asked for."""
    ks = key_names(keys)
    fields = [T.StructField(c, stream.schema[c].dataType, True) for c in ks]
    slim = stream.select(*ks, F.col(value).cast("double").alias(value))
    start = None if initial is None else initial.select(*ks, "n", "mean", "m2")
    return stateful(slim, ks, MomentsProcessor(ks, value, ttl_ms, idle_ms), moments_schema(fields), "Update", start,
                    "ProcessingTime" if ttl_ms or idle_ms else "None")


def stream_histogram_from(stream: DataFrame, keys, value, bins: Bins, initial: DataFrame | None = None) -> DataFrame:
    """B2 by a state function with a map state that goes on from ``initial`` counts
    (key..., slot, count), such as ``histogram.histogram_long`` of the past."""
    ks = key_names(keys)
    fields = [T.StructField(c, stream.schema[c].dataType, True) for c in ks]
    slots = stream.select(*ks, bins.slot(F.col(value)).alias("slot"))
    out = T.StructType([*fields, T.StructField("slot", T.IntegerType()), T.StructField("count", T.LongType())])
    start = None if initial is None else initial.groupBy(*ks).agg(F.collect_list(F.struct(
        F.col("slot").cast("int").alias("slot"), F.col("count").cast("bigint").alias("count"))).alias("slots"))
    return stateful(slots, ks, CountsProcessor(ks, "slot"), out, "Update", start)


def stream_sketch(stream: DataFrame, keys, value, lg_k: int = 12) -> DataFrame:
    """H6 on a stream: the running union as a library sketch, which is the state itself."""
    return stream.groupBy(*key_names(keys)).agg(
        F.hll_sketch_agg(F.col(value).cast("string"), lg_k).alias("sketch"), F.count(value).alias("n"))
