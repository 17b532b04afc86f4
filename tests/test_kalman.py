"""Kalman filter: the segmented scan against a plain sequential run."""

import numpy as np
import pytest

from mergestat.functions.kalman_math import Gains, KalmanParams, gain_and_update_cov, predict_cov, step
from mergestat.operators import kalman
from mergestat.plans.compare import plan_text

PRM = KalmanParams()
BIG = 2 ** 60


def sequential(zs, prm=PRM, x=None, p=None):
    x, p, out = x or prm.x_init, p or prm.p_init, []
    for z in zs:
        x, p = step(x, p, z, prm)
        out.append((x, p))
    return out


def close(a, b):
    return a == pytest.approx(b, rel=1e-9, abs=1e-9)


def frame(spark, keyed, key="long"):
    """Rows (key, event_id, z, tag) of {key: observations}; tag is a large or NULL id."""
    rows, e = [], 0
    for k, zs in keyed.items():
        for z in zs:
            rows.append((k, e, None if z is None else float(z), BIG + e if e % 3 else None))
            e += 1
    return spark.createDataFrame(rows, f"label {key}, event_id long, z double, tag long")


def checked(trace, keyed, prm=PRM):
    got = {}
    for r in trace.collect():
        got.setdefault(r["label"], []).append(r)
    assert set(got) == {k for k, zs in keyed.items() if any(z is not None for z in zs)}
    for k, rows in got.items():
        rows.sort(key=lambda r: r["step"])
        want = sequential([z for z in keyed[k] if z is not None], prm)
        assert [r["step"] for r in rows] == list(range(1, len(want) + 1))
        for r, (x, p) in zip(rows, want):
            assert close((r["x0"], r["x1"]), x) and close((r["p00"], r["p01"], r["p10"], r["p11"]), p)


def walk(seed, n, scale=20):
    return np.random.default_rng(seed).normal(0, scale, n).cumsum().tolist()


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_hot_key_and_large_ids_beside_null(spark, parts):
    """Ids that differ in the last bit stay apart, NULL is a key, one key spans partitions."""
    keyed = {BIG: walk(1, 40), BIG + 1: walk(2, 1500), None: walk(3, 70), 5: [1.0, None, 2.0], 6: [None],
             **{100 + k: walk(k, 1 + k % 4) for k in range(60)}}
    df = frame(spark, keyed)
    trace = kalman.kalman_trace(df, "label", "z", ["event_id"], num_partitions=parts, passthrough=["event_id", "tag"])
    checked(trace, keyed)
    tags = {r["event_id"]: r["tag"] for r in trace.collect()}
    assert all(t == (BIG + e if e % 3 else None) for e, t in tags.items())
    fin = {r["label"]: r for r in kalman.kalman_final(df, "label", "z", ["event_id"], num_partitions=parts).collect()}
    for k, zs in keyed.items():
        zs = [z for z in zs if z is not None]
        if zs:
            (x, p), r = sequential(zs)[-1], fin.pop(k)
            assert r["n"] == len(zs) and close((r["x0"], r["x1"]), x) and close(r["p11"], p[3])
    assert not fin


@pytest.mark.parametrize("prm", [PRM, KalmanParams(dt=0.01), KalmanParams(sigma=1e-6), KalmanParams(sigma=0.0),
                                 KalmanParams(r=100.0), KalmanParams(sigma=0.0, p_init=(3.0, 0.5, 0.5, 1.0))])
def test_parameters(spark, prm):
    keyed = {"hot": walk(4, 2500, 5), "b": walk(5, 3), "c": walk(6, 64), "d": walk(7, 65), "e": walk(8, 128)}
    checked(kalman.kalman_trace(frame(spark, keyed, "string"), "label", "z", ["event_id"], prm, num_partitions=5), keyed, prm)


def test_gains_follow_the_recursion():
    for prm, steps in ((PRM, 300), (KalmanParams(sigma=1e-6), 3000), (KalmanParams(sigma=0.0), 5000), (KalmanParams(dt=0.01), 3000)):
        p, want = prm.p_init, []
        for _ in range(steps):
            k, p = gain_and_update_cov(predict_cov(p, prm), prm)
            want.append((*k, *p))
        k0, k1, cov = Gains(prm).at(np.arange(1, steps + 1))
        assert np.allclose(np.column_stack([k0, k1, cov]), want, rtol=1e-8, atol=1e-12)


def test_two_column_keys(spark):
    rows = [(a, b, i, float(i * i % 17)) for i, (a, b) in enumerate([("x", 1), ("x", None), (None, 1), ("x", 1), (None, None)] * 30)]
    df = spark.createDataFrame(rows, "a string, b long, event_id long, z double")
    got = {(r["a"], r["b"]): r for r in kalman.kalman_final(df, ["a", "b"], "z", ["event_id"], num_partitions=4).collect()}
    assert len(got) == 4
    for k, r in got.items():
        zs = [z for a, b, _, z in rows if (a, b) == k]
        assert r["n"] == len(zs) and close((r["x0"], r["x1"]), sequential(zs)[-1][0])


@pytest.mark.parametrize("parts", [1, 5, 11])
def test_resume_from_initial_equals_whole(spark, parts):
    keyed = {BIG: walk(11, 900, 30), None: walk(12, 50), BIG + 1: walk(13, 9), 3: walk(14, 4)}
    df = frame(spark, keyed)
    whole = {r["event_id"]: r for r in kalman.kalman_trace(df, "label", "z", ["event_id"], num_partitions=parts).collect()}
    first = df.where("event_id % 1000 < 400 and label is not null or event_id < 925")
    rest = df.join(first.select("event_id"), "event_id", "left_anti")
    init = kalman.kalman_final(first, "label", "z", ["event_id"], num_partitions=parts).select("label", "n", "x0", "x1")
    got = kalman.kalman_trace(rest, "label", "z", ["event_id"], num_partitions=parts, initial=init).collect()
    assert len(got) == rest.count() > 0
    for r in got:
        w = whole[r["event_id"]]
        assert r["step"] == w["step"] and close((r["x0"], r["x1"]), (w["x0"], w["x1"])) and close(r["p00"], w["p00"])


def test_initial_for_key_without_new_rows_is_ignored(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0)], "label string, event_id long, z double")
    init = spark.createDataFrame([("a", 3, 5.0, 1.0), ("b", 7, 1.0, 1.0)], "label string, n long, x0 double, x1 double")
    out = kalman.kalman_trace(df, "label", "z", order=["event_id"], initial=init).collect()
    assert sorted((r["label"], r["step"]) for r in out) == [("a", 4), ("a", 5)]
    p = tuple(Gains(PRM).at(np.array([3]))[2][0])
    want = sequential([1.0, 2.0], x=(5.0, 1.0), p=p)[-1][0]
    assert close((max(out, key=lambda r: r["step"])["x0"]), want[0])


def test_empty_table(spark):
    df = spark.createDataFrame([], "label long, event_id long, z double")
    assert kalman.kalman_final(df, "label", "z", ["event_id"]).collect() == []


def test_lineitem_hot_query_against_sequential(spark):
    """The registered hot-key query against a sequential filter over the same rows."""
    import duckdb
    from mergestat.plans.catalog import q_kalman_lineitem_hot
    from tests.conftest import SF001
    got = {r["l_returnflag"]: r for r in q_kalman_lineitem_hot(spark, SF001).collect()}
    rows = duckdb.sql(
        f"SELECT l_returnflag, l_quantity FROM '{SF001}/lineitem.parquet' "
        "WHERE l_quantity IS NOT NULL "
        "ORDER BY l_returnflag, l_shipdate, l_orderkey, l_linenumber").fetchall()
    assert set(got) == {k for k, _ in rows}
    for k, r in got.items():
        zs = [z for key, z in rows if key == k]
        x, _ = sequential(zs)[-1]
        assert r["n"] == len(zs) and (r["x0"], r["x1"]) == pytest.approx(tuple(round(v, 6) for v in x), abs=2e-6)


def test_hot_key_is_spread_evenly_over_partitions(spark):
    from pyspark.sql import functions as F
    df = spark.range(3000).selectExpr("'hot' as label", "id as event_id", "cast(id % 17 as double) as z").union(
        spark.range(300).selectExpr("concat('k', id)", "10000 + id", "1d"))
    staged = kalman._stage(df, ["label"], ["event_id"], "z", [], 6)
    sizes = [r["c"] for r in staged.groupBy("_pid").agg(F.count("*").alias("c")).collect()]
    assert len(sizes) == 6 and max(sizes) < 2.5 * (3300 / 6)
    assert staged.where("label = 'hot'").select("_pid").distinct().count() >= 5


def test_segments_are_at_most_two_rows_per_partition(spark):
    df = spark.range(5000).selectExpr("id % 3 as label", "id as event_id", "cast(id % 17 as double) as z")
    staged = kalman._stage(df, ["label"], ["event_id"], "z", [], 7).select("label", "_z", "_pid")
    counts = staged.mapInArrow(kalman._counts(["label"]), "label long, _pid int, _first boolean, _n long").collect()
    assert len(counts) <= 2 * 7
    assert "Python" not in plan_text(staged)
