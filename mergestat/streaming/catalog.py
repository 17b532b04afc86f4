"""Streaming entries of the query catalogue.

Order-insensitive statistics stream a folder of batch files written in one job,
several files per trigger, with ``availableNow``.  Per-batch snapshots and Kalman streams
read the table's own files through a batch log, one week a trigger.  Results come
back from the sink or, for states of all keys after every batch, from the query's
checkpoint, so the same SQL as for the batch queries applies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergestat.plans.catalog import EVENT_BINS, HLL_M, J_SMALLEST, K_LARGEST
from mergestat.plans.compare import rounded
from mergestat.plans.oracle import (WEEKLY, history_extremes_sql, history_histogram_sql, history_hll_sql,
                                    history_sum_sql, history_variance_sql, hll_registers_history_sql, kalman_weekly_sql,
                                    running_distinct_sql)
from mergestat.session import scratch_path
from mergestat.sources.tables import table
from mergestat.streaming import queries as sq
from mergestat.operators import distinct, exact, histogram, moments
from mergestat.operators.moments import shapes
from mergestat.streaming import batch_log, reorder, states
from mergestat.streaming.sinks import latest_per_key, run, snapshot_writer, state_partitions
from mergestat.streaming.sources import batch_plan, read_batches, write_batch_files


def _events_stream(spark: SparkSession, sf: str, name: str):
    """Write events as day-ordered batch files; return (stream, folder)."""
    ev = table(spark, sf, "events").withColumn("batch", F.to_date("ts"))
    folder = scratch_path(spark, f"{name}-input")
    files, at_once = batch_plan(ev.count(), spark.sparkContext.defaultParallelism)
    write_batch_files(ev, "batch", folder, order=["ts", "event_id"], num_files=files)
    stream = read_batches(spark, folder, ev.schema, at_once)
    return stream.withColumnRenamed("event_type", "label"), folder


def _run_final(spark: SparkSession, sf: str, name: str, build, keys,
               mode: str = "update") -> DataFrame:
    stream, _ = _events_stream(spark, sf, name)
    out = scratch_path(spark, f"{name}-out")
    run(build(stream), scratch_path(spark, f"{name}-ckpt"), out, mode, partitions=state_partitions(spark))
    return latest_per_key(spark, out, keys)


def q_stream_sum(spark, sf):
    return rounded(_run_final(spark, sf, "stream_sum",
                              lambda s: sq.stream_sum(s, "label", "value"), ["label"]))


def q_stream_variance(spark, sf):
    return rounded(_run_final(spark, sf, "stream_variance",
                              lambda s: sq.stream_variance(s, "label", "value"), ["label"]))


def q_stream_histogram_median(spark, sf):
    df = _run_final(spark, sf, "stream_histogram",
                    lambda s: sq.stream_histogram_median(s, "label", "value", EVENT_BINS),
                    ["label"])
    return rounded(df.select("label", "n", "mean", F.array_join("counts", ",").alias("counts"),
                             "median_estimate"))


def q_stream_hll(spark, sf):
    df = _run_final(spark, sf, "stream_hll", lambda s: sq.stream_hll(s, "label", "user_id", HLL_M),
                    ["label"])
    return rounded(df.withColumn("estimate_rounded", F.round("estimate").cast("bigint")))


def q_stream_extremes(spark, sf):
    df = _run_final(spark, sf, "stream_extremes",
                    lambda s: sq.stream_extremes(s, "label", "value", K_LARGEST, J_SMALLEST),
                    ["label"])
    return rounded(df)


def _week():
    return F.to_date(F.date_trunc("week", "ts"))


def _weekly(spark: SparkSession, sf: str, name: str, build, mode: str, writer=None, out: str | None = None):
    """Events one calendar week a trigger; returns (sink, checkpoint, weeks by batch_id)."""
    ev = table(spark, sf, "events")
    out, ckpt = out or scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    log = batch_log.write_log(ev, _week(), "ts")
    stream = batch_log.read_log(spark, log, ev.schema, "ts").withColumnRenamed("event_type", "label")
    # a writer's own shuffles keep the session's partitions
    parts = state_partitions(spark) if writer is None else None
    return out, ckpt, _drained(spark, build(stream), ckpt, out, mode, writer, log, parts)


def _drained(spark: SparkSession, df: DataFrame, ckpt: str, out: str, mode: str, writer, log: str,
             partitions: int | None = None) -> DataFrame:
    """Run a query on a batch log until the log is through; (batch_id, batch) of its triggers."""
    q = run(df, ckpt, out, mode, processing_time="0 seconds", writer=writer, partitions=partitions)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return F.broadcast(batch_log.batches_of(spark, log, ckpt))        # a row a trigger


def _kalman_stream(spark: SparkSession, sf: str, name: str, partitions: int | None):
    """Trace, states of all keys, and weeks by batch_id."""
    out, state = scratch_path(spark, f"{name}-trace"), scratch_path(spark, f"{name}-state")
    writer = sq.kalman_segmented_writer("label", "value", ["ts", "event_id"], out, state,
                                        passthrough=["event_id"], num_partitions=partitions)
    weeks = _weekly(spark, sf, name, lambda s: s, "append", writer, out)[2]
    return spark.read.parquet(out), spark.read.parquet(state), weeks


def q_stream_kalman(spark, sf):
    """K4 on a stream, one trigger per week."""
    return rounded(_kalman_stream(spark, sf, "stream_kalman", None)[0].drop("batch_id"))


def q_stream_kalman_segmented(spark, sf):
    """The same with each week's keys cut over more partitions than there are keys."""
    return rounded(_kalman_stream(spark, sf, "stream_kalman_seg", 16)[0].drop("batch_id"))


def q_stream_kalman_snapshots(spark, sf):
    """The filter state of every key after every weekly batch."""
    _, state, weeks = _kalman_stream(spark, sf, "stream_kalman_snap", None)
    return rounded(state.join(weeks, "batch_id").drop("batch_id"))


# Fixed parameters of the shuffled streams: allowed lateness, most hours that a row
# comes behind its time, and every which row comes days too late.
DELAY, SHUFFLED_HOURS, LATE_EVERY, LATE_DAYS = "2 days", 40, 97, 9
ARRIVAL_DAYS = 5


def shuffled_events(spark: SparkSession, sf: str, late: bool) -> DataFrame:
    """Events with the time at which they arrive: up to 40 hours after their own,
    as the id decides, and with ``late`` one in 97 nine days after it."""
    ev = table(spark, sf, "events").withColumnRenamed("event_type", "label")
    hours = F.expr(f"make_dt_interval(0, CAST(event_id * 7919 % {SHUFFLED_HOURS + 1} AS INT))")
    arrival = F.col("ts") + hours
    if late:
        arrival = F.when(F.col("event_id") % LATE_EVERY == 0, F.col("ts") + F.expr(f"INTERVAL {LATE_DAYS} DAYS")).otherwise(arrival)
    ev = ev.select("event_id", "ts", "label", "value", arrival.alias("arrival"))
    # a row without key and value, far behind all others, moves the watermark past them
    end = ev.agg(F.max("arrival").alias("m")).select(
        F.lit(None).cast("long").alias("event_id"), (F.col("m") + F.expr("INTERVAL 30 DAYS")).alias("ts"),
        F.lit(None).cast("string").alias("label"), F.lit(None).cast("double").alias("value"),
        (F.col("m") + F.expr("INTERVAL 30 DAYS")).alias("arrival"))
    return ev.union(end)


def _shuffled(spark: SparkSession, sf: str, name: str, late: bool):
    """Reordered events through a Kalman stream: its trace, and the late rows' folder."""
    folder = scratch_path(spark, f"{name}-input")
    write_batch_files(shuffled_events(spark, sf, late), "arrival", folder)
    ev = spark.read.parquet(folder)
    start = ev.agg(F.min("arrival")).first()[0]
    log = batch_log.write_log(ev, F.floor(F.datediff("arrival", F.lit(start)) / ARRIVAL_DAYS).cast("int"), "arrival")
    stream = batch_log.read_log(spark, log, ev.schema, "arrival").drop("arrival")
    out, state, side = (scratch_path(spark, f"{name}-{kind}") for kind in ("trace", "state", "late"))
    kalman = sq.kalman_segmented_writer("label", "value", ["ts", "event_id"], out, state, passthrough=["event_id"])
    _drained(spark, reorder.reordered(stream, ["label"], ["ts", "event_id"], DELAY), scratch_path(spark, f"{name}-ckpt"), out,
             "append", reorder.split_writer(kalman, side), log)
    return spark.read.parquet(out).drop("batch_id"), spark.read.parquet(side)


def q_stream_kalman_reordered(spark, sf):
    """K4: rows that come shuffled within the allowed delay give the trace of the ordered table."""
    return rounded(_shuffled(spark, sf, "kalman_reordered", late=False)[0])


def q_stream_late_counts(spark, sf):
    """Rows filtered in time order, and rows that came too late, of every key."""
    trace, late = _shuffled(spark, sf, "late_counts", late=True)
    both = trace.select("label", F.lit(0).alias("late")).unionAll(late.select("label", F.lit(1).alias("late")))
    return both.groupBy("label").agg(F.count_if(F.col("late") == 0).alias("n_in_order"), F.count_if(F.col("late") == 1).alias("n_late"))


def q_stream_batch_sum(spark, sf):
    """A1 on a stream: per-key count and sum within each weekly batch."""
    out = scratch_path(spark, "stream_batch_sum-out")
    weeks = _weekly(spark, sf, "stream_batch_sum", lambda s: s, "append", sq.batch_sum_writer("label", "value", out), out)[2]
    return rounded(spark.read.parquet(out).join(weeks, "batch_id").drop("batch_id"))


#: Weeks that are a batch result before the stream goes on from them.
PAST_WEEKS = 2


def _continued(spark: SparkSession, sf: str, name: str, state, build, keys) -> tuple[DataFrame, DataFrame]:
    """A batch result of the first weeks, and what a stream that goes on from it last wrote per key."""
    ev = table(spark, sf, "events")
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    log = batch_log.write_log(ev, _week(), "ts")
    weeks = batch_log.batch_values(spark, log)
    past = state(ev.withColumnRenamed("event_type", "label").where(_week() <= F.lit(weeks[PAST_WEEKS - 1])))
    stream = batch_log.read_log(spark, log, ev.schema, "ts", skip=PAST_WEEKS).withColumnRenamed("event_type", "label")
    _drained(spark, build(stream, past), ckpt, out, "update", None, log)
    return past, latest_per_key(spark, out, keys)


def q_stream_variance_continued(spark, sf):
    """Variances of two weeks in batch, gone on with as a stream, are those of the whole."""
    _, now = _continued(spark, sf, "variance_continued",
                        lambda past: moments.moment_partials(past, "label", "value", F.lit(0)).drop("batch"),
                        lambda s, past: sq.stream_variance_from(s, "label", "value", past), ["label"])
    return rounded(now.select("label", "n", "mean", "variance", F.sqrt("variance").alias("stddev")))


def q_stream_histogram_continued(spark, sf):
    """Bin counts of two weeks in batch, gone on with as a stream with a map state."""
    past, now = _continued(spark, sf, "histogram_continued",
                           lambda past: histogram.histogram_long(past, "label", "value", EVENT_BINS),
                           lambda s, past: sq.stream_histogram_from(s, "label", "value", EVENT_BINS, past), ["label", "slot"])
    # a slot that the stream did not touch stands as the batch left it
    quiet = past.join(now.select(F.col("label").alias("_l"), F.col("slot").alias("_s")),
                      F.col("label").eqNullSafe(F.col("_l")) & (F.col("slot") == F.col("_s")), "left_anti")
    return now.select("label", "slot", "count").union(quiet.select("label", "slot", "count"))


def q_stream_sketch_snapshots(spark, sf):
    """H6: the running sketch of every key after every week against the exact count."""
    held = _snapshots(spark, sf, "sketch_snapshots", lambda s: sq.stream_sketch(s, "label", "user_id"))
    ev = table(spark, sf, "events").withColumnRenamed("event_type", "label").withColumn("batch", _week())
    first = ev.where(F.col("user_id").isNotNull()).groupBy("label", "user_id").agg(F.min("batch").alias("first"))
    exact = held.select("label", "batch").join(first.withColumnRenamed("label", "_l"), F.col("label").eqNullSafe(F.col("_l"))) \
        .groupBy("label", "batch").agg(F.count_if(F.col("first") <= F.col("batch")).alias("exact"))
    both = held.join(exact, ["label", "batch"])
    e = F.hll_sketch_estimate("sketch")
    return both.select("label", "batch", "n", "exact", (F.abs(e - F.col("exact")) <= F.greatest(
        F.lit(distinct.SIGMAS * 1.04 / 64) * F.col("exact"), F.lit(1.0))).alias("sketch_in_bounds"))


def q_stream_exact_sum(spark, sf):
    """A2 on a stream, independent of order: compared to the last bit."""
    lanes = _run_final(spark, sf, "stream_exact_sum", lambda s: sq.stream_exact_sum(s, "label", "value"), ["label", "exponent"])
    return exact.exact_totals(lanes, ["label"])


def q_stream_higher_moments(spark, sf):
    """A10 on a stream."""
    held = _run_final(spark, sf, "stream_higher", lambda s: sq.stream_higher_moments(s, "label", "value"), ["label"])
    return rounded(shapes(held, "label"))


def _snapshots(spark, sf, name, build) -> DataFrame:
    """The state of every key after every weekly batch, from a complete-mode query."""
    out, _, weeks = _weekly(spark, sf, name, build, "complete")
    return spark.read.parquet(out).join(weeks, "batch_id").drop("batch_id")


def q_stream_state_snapshots(spark, sf):
    """The state of every key after every weekly batch (complete mode)."""
    return rounded(_snapshots(spark, sf, "stream_snapshots", lambda s: s.groupBy("label").agg(
        F.count("value").alias("n"), F.sum("value").alias("sum"))))


def q_stream_variance_snapshots(spark, sf):
    """Both variances after every batch, from the states in the checkpoint of an
    update-mode query: buffers of ``var_pop`` and of the mean of squares."""
    v = F.col("value")
    _, ckpt, weeks = _weekly(spark, sf, "variance_snapshots",
                             lambda s: s.groupBy("label").agg(F.var_pop(v).alias("variance"), F.avg(v * v).alias("squares")), "update")
    held = states.history_of(spark, ckpt, states.batches_kept(spark, ckpt), names=["n", "mean", "m2", "sum_squares", "n_squares"])
    n, mean = F.col("n"), F.col("mean")
    return rounded(held.join(weeks, "batch_id").select(
        "label", "batch", n.cast("bigint").alias("n"), F.when(n > 0, mean).alias("mean"), F.when(n > 0, F.col("m2") / n).alias("variance"),
        F.when(n > 0, F.sqrt(F.col("m2") / n)).alias("stddev"),
        F.when(n > 0, F.col("sum_squares") / F.col("n_squares") - mean * mean).alias("variance_sum_squares")))


def q_stream_histogram_snapshots(spark, sf):
    """Count, mean, bins and median estimate after every batch."""
    df = _snapshots(spark, sf, "histogram_snapshots",
                    lambda s: sq.stream_histogram_median(s, "label", "value", EVENT_BINS))
    return rounded(df.select("label", "batch", "n", "mean", F.array_join("counts", ",").alias("counts"), "median_estimate"))


def q_stream_hll_snapshots(spark, sf):
    df = _snapshots(spark, sf, "hll_snapshots", lambda s: sq.stream_hll(s, "label", "user_id", HLL_M))
    return rounded(df.withColumn("estimate_rounded", F.round("estimate").cast("bigint")))


def q_stream_registers_snapshots(spark, sf):
    """The registers of every key after every weekly batch."""
    df = _snapshots(spark, sf, "registers_snapshots", lambda s: distinct.hll_registers_wide(s, "label", "user_id", HLL_M))
    return df.select("label", "batch", "n", F.array_join("registers", ",").alias("registers"))


def q_stream_extremes_snapshots(spark, sf):
    """Top-k lists of every key after every batch, from the states in the checkpoint."""
    _, ckpt, weeks = _weekly(spark, sf, "extremes_snapshots",
                             lambda s: sq.stream_extremes(s, "label", "value", K_LARGEST, J_SMALLEST), "update")
    held = states.history_of(spark, ckpt, states.batches_kept(spark, ckpt), "extremes")
    both = F.concat(*[F.transform(side, lambda v, i: F.struct(
        F.lit(side).alias("side"), (i + 1).cast("bigint").alias("rank"), v.alias("value"))) for side in ("largest", "smallest")])
    return rounded(held.join(weeks, "batch_id").select("label", "batch", F.explode(both).alias("e")).select("label", "batch", "e.*"))


STREAM_QUERIES = {
    "stream_sum": q_stream_sum,
    "stream_variance": q_stream_variance,
    "stream_histogram_median": q_stream_histogram_median,
    "stream_hll": q_stream_hll,
    "stream_extremes": q_stream_extremes,
    "stream_kalman": q_stream_kalman,
    "stream_kalman_segmented": q_stream_kalman_segmented,
    "stream_kalman_snapshots": q_stream_kalman_snapshots,
    "stream_kalman_reordered": q_stream_kalman_reordered,
    "stream_late_counts": q_stream_late_counts,
    "stream_variance_continued": q_stream_variance_continued,
    "stream_histogram_continued": q_stream_histogram_continued,
    "stream_sketch_snapshots": q_stream_sketch_snapshots,
    "stream_exact_sum": q_stream_exact_sum,
    "stream_higher_moments": q_stream_higher_moments,
    "stream_state_snapshots": q_stream_state_snapshots,
    "stream_batch_sum": q_stream_batch_sum,
    "stream_variance_snapshots": q_stream_variance_snapshots,
    "stream_histogram_snapshots": q_stream_histogram_snapshots,
    "stream_hll_snapshots": q_stream_hll_snapshots,
    "stream_registers_snapshots": q_stream_registers_snapshots,
    "stream_extremes_snapshots": q_stream_extremes_snapshots,
}

_EVENT_EXTREMES_SQL = " UNION ALL ".join(
    f"SELECT event_type AS label, '{side}' AS side, rank, round(value, 6) AS value FROM "
    f"(SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value "
    f"{d}, event_id) AS rank FROM events WHERE value IS NOT NULL AND NOT isnan(value)) "
    f"WHERE rank <= {n}"
    for side, d, n in (("largest", "DESC", K_LARGEST), ("smallest", "ASC", J_SMALLEST)))

_WEEKLY_BATCH_SUM_SQL = (
    "SELECT event_type AS label, CAST(date_trunc('week', ts) AS DATE) AS batch, "
    "count(value) AS n, round(sum(value), 6) AS sum FROM events GROUP BY 1, 2")

# Late: below the largest event time of all earlier batches (in whole milliseconds), less the delay.
_LATE_SQL = f"""
WITH a AS (SELECT event_type AS label, value, ts, CASE WHEN event_id % {LATE_EVERY} = 0 THEN ts + INTERVAL {LATE_DAYS} DAY
             ELSE ts + to_hours(CAST(event_id * 7919 % {SHUFFLED_HOURS + 1} AS INTEGER)) END AS arrival FROM events),
b AS (SELECT *, CAST(floor(date_diff('day', CAST((SELECT min(arrival) FROM a) AS DATE), CAST(arrival AS DATE)) / {ARRIVAL_DAYS}) AS INTEGER) AS batch FROM a),
m AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM b GROUP BY batch)
SELECT label, count(*) FILTER (NOT late AND value IS NOT NULL) AS n_in_order, count(*) FILTER (late) AS n_late FROM (
  SELECT b.label, b.value, m.seen IS NOT NULL AND b.ts < date_trunc('milliseconds', m.seen) - INTERVAL {DELAY} AS late
  FROM b JOIN m ON m.batch = b.batch) GROUP BY label
"""

# Stream query -> batch oracle key (or SQL text of its own).
STREAM_ORACLES = {
    "stream_sum": "running_sum",
    "stream_variance": "running_variance",
    "stream_histogram_median": "running_histogram_median",
    "stream_hll": "hll_estimate",
    "stream_extremes": _EVENT_EXTREMES_SQL,
    "stream_kalman": "kalman_trace",
    "stream_kalman_segmented": "kalman_trace",
    "stream_kalman_snapshots": kalman_weekly_sql(),
    "stream_kalman_reordered": "kalman_trace",
    "stream_late_counts": _LATE_SQL,
    "stream_variance_continued": "running_variance",
    "stream_histogram_continued": "histogram",
    "stream_sketch_snapshots": running_distinct_sql("CAST(date_trunc('week', ts) AS DATE)", "event_type AS label", "user_id"),
    "stream_exact_sum": "exact_sum",
    "stream_higher_moments": "higher_moments_merge_partials",
    "stream_state_snapshots": history_sum_sql(WEEKLY),
    "stream_variance_snapshots": history_variance_sql(WEEKLY, stddev=True, squares=True),
    "stream_histogram_snapshots": history_histogram_sql(WEEKLY),
    "stream_hll_snapshots": history_hll_sql(WEEKLY),
    "stream_registers_snapshots": hll_registers_history_sql(WEEKLY),
    "stream_extremes_snapshots": history_extremes_sql(WEEKLY),
    "stream_batch_sum": _WEEKLY_BATCH_SUM_SQL,
}
