"""Streams: split into any number of batches = one batch; restart from the
checkpoint mid-stream keeps the state."""

import os

import pytest
from pyspark.sql import functions as F

from mergestat.operators import moments
from mergestat.operators.histogram import Bins
from mergestat.sources.tables import table
from mergestat.streaming import queries as sq
from mergestat.streaming import batch_log, states
from mergestat.streaming.sinks import batch_folders, latest_per_key, run
from mergestat.streaming.sources import read_batches, write_batch_files
from tests.conftest import SF001


def _events(spark):
    return (table(spark, SF001, "events").withColumnRenamed("event_type", "label")
            .withColumn("batch", F.to_date("ts")))


def _stream_final(spark, tmp_dir, build, files_per_trigger, keys=("label",)):
    ev = _events(spark)
    folder = os.path.join(tmp_dir, "in")
    write_batch_files(ev, "batch", folder, order=["ts", "event_id"], num_files=7)
    s = read_batches(spark, folder, ev.schema, files_per_trigger)
    out = os.path.join(tmp_dir, "out")
    q = run(build(s), os.path.join(tmp_dir, "ck"), out, "update")
    return latest_per_key(spark, out, list(keys)), q


def _through(spark, tmp_dir, df, order, build, mode, out=None, writer=None, batch=None):
    """``df`` from files of its own through a query, one batch a trigger; the log."""
    df.write.parquet(os.path.join(tmp_dir, "table"))
    files = spark.read.parquet(os.path.join(tmp_dir, "table"))
    log = batch_log.write_log(files, F.col(order) if batch is None else batch, order)
    ck = os.path.join(tmp_dir, "ck")
    q = run(build(batch_log.read_log(spark, log, files.schema, order, ck)), ck, out, mode, processing_time="0 seconds", writer=writer)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return log


def _as_dict(df, key="label"):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("files", [1, 3, 7])
def test_variance_stream_equals_batch(spark, tmp_dir, files):
    got, q = _stream_final(spark, tmp_dir, lambda s: sq.stream_variance(s, "label", "value"), files)
    want = moments.running_variance(_events(spark), "label", "value")
    g, w = _as_dict(got), _as_dict(want)
    assert g.keys() == w.keys()
    for k in w:
        assert g[k]["n"] == w[k]["n"]
        assert g[k]["variance"] == pytest.approx(w[k]["variance"], rel=1e-9)
    assert len(q.recentProgress) >= -(-7 // files)


def test_histogram_and_hll_streams_equal_batch(spark, tmp_dir):
    from mergestat.operators import distinct, histogram
    b = Bins(lo=0.0, hi=100.0, nbins=20)
    got, _ = _stream_final(spark, os.path.join(tmp_dir, "h"),
                           lambda s: sq.stream_histogram_median(s, "label", "value", b), 2)
    want = histogram.running_histogram_median(_events(spark), "label", "value", b)
    g, w = _as_dict(got), _as_dict(want)
    for k in w:
        assert g[k]["counts"] == w[k]["counts"]
        assert g[k]["median_estimate"] == w[k]["median_estimate"]
    got, _ = _stream_final(spark, os.path.join(tmp_dir, "d"),
                           lambda s: sq.stream_hll(s, "label", "user_id", 64), 2)
    want = distinct.hll_distinct(_events(spark), "label", "user_id", 64)
    g, w = _as_dict(got), _as_dict(want)
    for k in w:
        assert g[k]["estimate"] == pytest.approx(w[k]["estimate"], rel=1e-12)


def test_extremes_stream_equals_batch(spark, tmp_dir):
    from mergestat.operators import extremes
    got, _ = _stream_final(spark, tmp_dir, lambda s: sq.stream_extremes(s, "label", "value", 4, 3), 2)
    want = extremes.extremes(_events(spark), "label", "value", 4, 3, tiebreak=["event_id"])
    key = lambda r: (r["label"], r["side"], r["rank"], r["value"])
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


BIG = 2 ** 60


def _odd_events(spark):
    """Ids that differ in the last bit, a NULL key, NULL and tied order values."""
    rows = [(k, None if i % 11 == 0 else i // 2, i, float((i * 37) % 23) if i % 7 else None, i // 40)
            for i, k in enumerate([BIG, BIG + 1, None, 5] * 50)]
    return spark.createDataFrame(rows, "label long, ts int, event_id long, value double, batch int")


def test_extremes_stream_of_large_and_null_keys(spark, tmp_dir):
    from mergestat.operators import extremes
    ev = _odd_events(spark)
    out = os.path.join(tmp_dir, "out")
    _through(spark, tmp_dir, ev, "batch", lambda s: sq.stream_extremes(s, "label", "value", 4, 3), "update", out)
    want = extremes.extremes(ev, "label", "value", 4, 3, tiebreak=["event_id"])
    key = lambda r: (str(r["label"]), r["side"], r["rank"], r["value"])
    assert sorted(map(key, latest_per_key(spark, out, ["label"]).collect())) == sorted(map(key, want.collect()))


def test_kalman_stream_of_large_and_null_keys(spark, tmp_dir):
    """One trigger per batch equals one run in which rows are ordered by (batch, order)."""
    from mergestat.operators import kalman
    ev = _odd_events(spark)
    out, st = (os.path.join(tmp_dir, x) for x in ("out", "state"))
    writer = sq.kalman_segmented_writer("label", "value", ["ts", "event_id"], out, st, passthrough=["event_id"], num_partitions=3)
    _through(spark, tmp_dir, ev, "batch", lambda s: s, "append", writer=writer)
    got = {r["event_id"]: r for r in spark.read.parquet(out).collect()}
    want = kalman.kalman_trace(ev, "label", "value", ["batch", "ts", "event_id"]).collect()
    assert len(got) == len(want)
    for r in want:
        g = got[r["event_id"]]
        assert (g["label"], g["step"]) == (r["label"], r["step"])
        assert (g["x0"], g["x1"]) == pytest.approx((r["x0"], r["x1"]), rel=1e-9)
    last = spark.read.parquet(f"{st}/batch_id={batch_folders(spark, st)[-1]}").collect()
    assert sorted(str(r["label"]) for r in last) == sorted(map(str, (BIG, BIG + 1, None, 5)))


def test_kalman_states_of_quiet_keys_and_replays(spark, tmp_dir):
    """The states after a batch hold all keys, quiet ones as they were; a batch that is
    run again replaces its own trace and states."""
    from mergestat.operators import kalman
    rows = [(b * 10 + i, k, float(b * 7 + i), b) for b, keys in enumerate(["ab", "a", "b", "cc"]) for i, k in enumerate(keys)]
    ev = spark.createDataFrame(rows, "ts int, k string, z double, b int")
    out, st = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "st")
    write = sq.kalman_segmented_writer("k", "z", ["ts"], out, st, num_partitions=2)
    for b in (0, 1, 2, 2, 3, 3):
        write(ev.where(F.col("b") == b), b)
        got = {r["k"]: r for r in spark.read.parquet(f"{st}/batch_id={b}").collect()}
        want = {r["k"]: r for r in kalman.kalman_final(ev.where(F.col("b") <= b), "k", "z", ["ts"]).collect()}
        assert got.keys() == want.keys()
        for k, r in want.items():
            assert tuple(got[k][c] for c in r.asDict())[1:] == pytest.approx(tuple(r)[1:])
    assert spark.read.parquet(out).count() == len(rows)


def test_states_from_the_checkpoint(spark, tmp_dir):
    """Of every retained batch, native buffers and a processor's state alike."""
    from mergestat.operators import extremes
    ev = _events(spark).withColumn("week", F.to_date(F.date_trunc("week", "ts")))
    log = _through(spark, os.path.join(tmp_dir, "v"), ev, "ts", lambda s: s.groupBy("label").agg(F.var_pop("value").alias("v")),
                   "update", os.path.join(tmp_dir, "v-out"), batch=F.col("week"))
    ck = os.path.join(tmp_dir, "v", "ck")
    weeks = {r["batch_id"]: r["batch"] for r in batch_log.batches_of(spark, log, ck).collect()}
    kept = states.batches_kept(spark, ck)
    assert sorted(weeks.values()) == sorted({r[0] for r in ev.select("week").collect()}) and list(kept) == sorted(weeks)
    for n in kept:
        got = _as_dict(states.state_of(spark, ck, n, names=["n", "mean", "m2"]))
        want = _as_dict(moments.running_variance(ev.where(F.col("week") <= F.lit(weeks[n])), "label", "value"))
        assert got.keys() == want.keys()
        for k in want:
            assert got[k]["n"] == want[k]["n"] and got[k]["m2"] / got[k]["n"] == pytest.approx(want[k]["variance"])
    with pytest.raises(ValueError):
        states.state_of(spark, ck, names=["n"])
    _through(spark, os.path.join(tmp_dir, "x"), ev, "ts", lambda s: sq.stream_extremes(s, "label", "value", 4, 3),
             "update", os.path.join(tmp_dir, "x-out"), batch=F.col("week"))
    last = _as_dict(states.state_of(spark, os.path.join(tmp_dir, "x", "ck"), variable="extremes"))
    for side in ("largest", "smallest"):
        for k in last:
            want = extremes.extremes(ev.where(F.col("label") == k), "label", "value", 4, 3).where(F.col("side") == side)
            assert last[k][side] == [r["value"] for r in want.orderBy("rank").collect()]


def test_extremes_keep_their_type(spark, tmp_dir):
    big = [BIG, BIG + 1, BIG + 2, None, 3, -BIG - 1, -BIG]
    ev = spark.createDataFrame([("a", v, i // 3) for i, v in enumerate(big)], "k string, v long, b int")
    out = os.path.join(tmp_dir, "out")
    _through(spark, tmp_dir, ev, "b", lambda s: sq.stream_extremes(s, "k", "v", 2, 2), "update", out)
    got = sorted((r["side"], r["rank"], r["v"]) for r in latest_per_key(spark, out, ["k"]).collect())
    assert got == [("largest", 1, BIG + 2), ("largest", 2, BIG + 1), ("smallest", 1, -BIG - 1), ("smallest", 2, -BIG)]


def test_many_registers_on_a_stream(spark, tmp_dir):
    from mergestat.operators import distinct
    ev = _events(spark)
    got, _ = _stream_final(spark, tmp_dir, lambda s: sq.stream_hll_registers(s, "label", "user_id", 4096), 2, ("label", "register"))
    g = _as_dict(distinct.hll_estimate(got, "label", 4096, "xxhash64"))
    w = _as_dict(distinct.hll_distinct(ev, "label", "user_id", 4096, "xxhash64"))
    assert {k: r["estimate"] for k, r in g.items()} == pytest.approx({k: r["estimate"] for k, r in w.items()})
    with pytest.raises(ValueError):
        sq.stream_hll(ev, "label", "user_id", 4096)


def test_restart_keeps_state(spark, tmp_dir):
    """Stop after part of the input, add the rest, restart: same as one run."""
    ev = _events(spark)
    days = sorted(r[0] for r in ev.select("batch").distinct().collect())
    half = days[len(days) // 2]
    folder, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    ev.where(F.col("batch") < half).write.parquet(folder + "/a")
    s = read_batches(spark, folder + "/*", ev.schema)
    run(sq.stream_sum(s, "label", "value"), ck, out, "update")
    ev.where(F.col("batch") >= half).write.parquet(folder + "/b")
    s = read_batches(spark, folder + "/*", ev.schema)
    run(sq.stream_sum(s, "label", "value"), ck, out, "update")
    g = _as_dict(latest_per_key(spark, out, ["label"]))
    w = _as_dict(moments.running_sum(ev, "label", "value"))
    for k in w:
        assert g[k]["sum"] == pytest.approx(w[k]["sum"], rel=1e-12)


def test_segmented_kalman_stream_equals_batch(spark, tmp_dir):
    """foreachBatch form: every trigger runs the segmented scan resumed from
    the previous snapshot; one hot key spread over many partitions."""
    from mergestat.operators import kalman
    ev = _events(spark).withColumn("week", F.to_date(F.date_trunc("week", "ts")))
    out, st = (os.path.join(tmp_dir, x) for x in ("out", "state"))
    writer = sq.kalman_segmented_writer("label", "value", ["ts", "event_id"], out, st,
                                        passthrough=["event_id"], num_partitions=6)
    _through(spark, tmp_dir, ev, "ts", lambda s: s, "append", writer=writer, batch=F.col("week"))
    got = {(r["label"], r["event_id"]): r for r in spark.read.parquet(out).collect()}
    want = kalman.kalman_trace(ev, "label", "value").collect()
    assert len(got) == len(want)
    for r in want:
        g = got[(r["label"], r["event_id"])]
        assert g["step"] == r["step"]
        assert g["x0"] == pytest.approx(r["x0"], rel=1e-9)


def test_exact_sum_and_higher_moments_on_a_stream(spark, tmp_dir):
    from mergestat.operators import exact
    got, _ = _stream_final(spark, os.path.join(tmp_dir, "s"), lambda s: sq.stream_exact_sum(s, "label", "value"), 2, ("label", "exponent"))
    want = exact.exact_sum(_events(spark).repartition(11), "label", "value")
    assert sorted(map(str, exact.exact_totals(got, "label").collect())) == sorted(map(str, want.collect()))
    got, _ = _stream_final(spark, os.path.join(tmp_dir, "m"), lambda s: sq.stream_higher_moments(s, "label", "value"), 2)
    g, w = _as_dict(moments.shapes(got, "label")), _as_dict(moments.higher_moments(_events(spark), "label", "value"))
    for k in w:
        assert (g[k]["skewness"], g[k]["kurtosis"]) == pytest.approx((w[k]["skewness"], w[k]["kurtosis"]))


def test_stream_batch_sum_against_sql(spark):
    """Per-batch sums on a stream (A1) against the weekly GROUP BY."""
    import __spark_entry__ as E
    from tests.conftest import SF01
    from tests.oracle_harness import compare, duck
    problems, n = compare(E.queries()["stream_batch_sum"](spark, SF01), duck(SF01),
                          E.oracle_sql()["stream_batch_sum"])
    assert not problems and n > 0
