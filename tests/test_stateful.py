"""State functions: gone on with from a batch result, expiry on request, map state, sketches."""

import os
import time

import pytest
from pyspark.sql import functions as F

from mergestat.operators import distinct, histogram, moments
from mergestat.operators.histogram import Bins
from mergestat.streaming import batch_log
from mergestat.streaming import queries as sq
from mergestat.streaming.sinks import latest_per_key, run

BIG = 2 ** 60
BINS = Bins(lo=0.0, hi=10.0, nbins=5)


def table_of(spark, tmp_dir, rows):
    spark.createDataFrame(rows, "k long, v double, b int").write.parquet(tmp_dir + "/t")
    df = spark.read.parquet(tmp_dir + "/t")
    return df, batch_log.write_log(df, F.col("b"), "b")


def drive(spark, tmp_dir, df, log, build, skip=0):
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    q = run(build(batch_log.read_log(spark, log, df.schema, "b", ck, skip)), ck, out, "update", processing_time="0 seconds")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return out


def rows_of():
    return [((BIG, BIG + 1, None, 5)[i % 4], None if i % 9 == 0 else float(i * 37 % 23) / 2, i // 30) for i in range(120)] + \
        [(77, 3.0, 0), (88, None, 0), (99, 4.0, 3)]


def test_batch_states_go_on_as_a_stream(spark, tmp_dir):
    df, log = table_of(spark, tmp_dir, rows_of())
    past = moments.moment_partials(df.where("b < 2"), "k", "v", F.lit(0))
    out = drive(spark, tmp_dir, df, log, lambda s: sq.stream_variance_from(s, "k", "v", past), skip=2)
    got = {r["k"]: r for r in latest_per_key(spark, out, ["k"]).collect()}
    want = {r["k"]: r for r in moments.running_variance(df, "k", "v").collect()}
    assert got.keys() == want.keys() - {77, 88}                     # quiet keys stay as the batch left them
    for k, r in got.items():
        assert r["n"] == want[k]["n"] and not r["ended"]
        assert (r["mean"], r["variance"]) == pytest.approx((want[k]["mean"], want[k]["variance"]))


def test_map_state_goes_on_from_batch_counts(spark, tmp_dir):
    df, log = table_of(spark, tmp_dir, rows_of())
    past = histogram.histogram_long(df.where("b < 2"), "k", "v", BINS)
    out = drive(spark, tmp_dir, df, log, lambda s: sq.stream_histogram_from(s, "k", "v", BINS, past), skip=2)
    got = {(r["k"], r["slot"]): r["count"] for r in latest_per_key(spark, out, ["k", "slot"]).collect()}
    want = {(r["k"], r["slot"]): r["count"] for r in histogram.histogram_long(df, "k", "v", BINS).collect()}
    assert set(got) <= set(want) and len(got) > 10 and all(want[x] == n for x, n in got.items())


def test_expiry_only_on_request(spark, tmp_dir):
    """An idle key ends once, with its last state, and starts anew; without the wish it goes on."""
    rows = [(1, 2.0, 0), (2, 5.0, 0), (1, 4.0, 0)]
    df, log = table_of(spark, tmp_dir, rows)
    out, ck = tmp_dir + "/out", tmp_dir + "/ck"

    def written():
        return spark.read.schema("k long, n long, mean double, variance double, ended boolean").parquet(out)

    def until(done):
        """Timers keep a query busy, so it is watched, not waited for."""
        s = batch_log.read_log(spark, log, df.schema, "b", ck)
        q = run(sq.stream_variance_from(s, "k", "v", idle_ms=4000), ck, out, "update", processing_time="300 milliseconds")
        try:
            for _ in range(80):
                time.sleep(1)
                if q.exception() or (os.path.isdir(out) and done(written())):
                    return
        finally:
            q.stop()
    until(lambda t: t.where("ended").count() == 2)
    ended = {r["k"]: (r["n"], r["mean"]) for r in written().where("ended").collect()}
    assert ended == {1: (2, 3.0), 2: (1, 5.0)}
    spark.createDataFrame([(1, 10.0, 1)], "k long, v double, b int").write.parquet(tmp_dir + "/t2")
    batch_log.write_log(spark.read.parquet(tmp_dir + "/t2"), F.col("b"), "b", log, append=True)
    until(lambda t: t.where("mean = 10.0").count())
    again = written().where("k = 1 and mean = 10.0").first()
    assert again["n"] == 1


def test_sketch_is_the_state(spark, tmp_dir):
    df, log = table_of(spark, tmp_dir, [(i % 2, float(i % 700), i // 500) for i in range(2000)])
    out = drive(spark, tmp_dir, df, log, lambda s: sq.stream_sketch(s, "k", "v"))
    got = {r["k"]: r["e"] for r in latest_per_key(spark, out, ["k"]).select("k", F.hll_sketch_estimate("sketch").alias("e")).collect()}
    want = {r["k"]: r["sketch_estimate"] for r in distinct.distinct_sketch(df, "k", "v").collect()}
    assert got == want and all(abs(e - 350) < 20 for e in got.values())
