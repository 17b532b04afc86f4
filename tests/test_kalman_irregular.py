"""Unequal steps and gaps against a sequential filter; equal steps against the regular one."""

import random

import numpy as np
import pytest

from mergestat.functions.kalman_math import KalmanParams
from mergestat.operators import kalman
from mergestat.operators import kalman_irregular as ki

BIG = 2 ** 60
PARAMS = [KalmanParams(), KalmanParams(dt=0.5, accel=(0.0, 0.0), sigma=0.3, r=2.0, x_init=(0.0, 1.0), p_init=(1.0, 0.2, 0.2, 3.0)),
          KalmanParams(sigma=0.0)]


def sequential(rows, prm):
    """(time, z or None) one after the other, in plain matrices."""
    x, p = np.array(prm.x_init), np.array(prm.p_init).reshape(2, 2)
    out, before = [], None
    for t, z in rows:
        dt = prm.dt if before is None else t - before
        before = t
        f, g = np.array([[1, dt], [0, 1]]), np.array([dt * dt / 2, dt])
        x = f @ x + g * np.array(prm.accel)
        p = f @ p @ f.T + prm.sigma * np.outer(g, g)
        if z is not None:
            k = p[:, 0] / (p[0, 0] + prm.r)
            x, p = x + k * (z - x[0]), p - np.outer(k, p[0])
        out.append((dt, *x, *p.ravel()))
    return out


def rows_of(seed, hot=900):
    r = random.Random(seed)
    out = []
    for k, n in ((BIG, hot), (BIG + 1, 40), (None, 70), (5, 1), (6, 2)):
        t = r.random()
        for i in range(n):
            out.append((k, t, i, r.choice([None, r.gauss(0, 5), r.gauss(0, 5), t])))
            t += r.choice([0.0, 1.0, r.random() * 3, 20.0 if i % 50 == 0 else 0.5])
    r.shuffle(out)
    return out


@pytest.mark.parametrize("parts,prm", [(1, 0), (3, 1), (11, 0), (11, 2)])
def test_agrees_with_a_sequential_filter(spark, parts, prm):
    rows, prm = rows_of(parts), PARAMS[prm]
    df = spark.createDataFrame(rows, "k long, t double, i long, z double")
    got = {(r["k"], r["i"]): r for r in ki.kalman_irregular(df, "k", "z", ["t", "i"], params=prm, num_partitions=parts).collect()}
    assert len(got) == len(rows)
    for k in {r[0] for r in rows}:
        mine = sorted((t, i, z) for q, t, i, z in rows if q == k)
        for (_, i, z), want in zip(mine, sequential([(t, z) for t, _, z in mine], prm)):
            g = got[k, i]
            assert g["z"] == z
            assert (g["dt"], g["x0"], g["x1"], g["p00"], g["p01"], g["p10"], g["p11"]) == pytest.approx(want, rel=1e-6, abs=1e-6)


def test_equal_steps_are_the_regular_filter(spark):
    r = random.Random(3)
    rows = [(k, i, r.gauss(0, 9)) for k in "ab" for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, z double")
    got = {(x["k"], x["t"]): x for x in ki.kalman_irregular(df, "k", "z", ["t"], num_partitions=5).collect()}
    for x in kalman.kalman_trace(df, "k", "z", ["t"]).collect():
        g = got[x["k"], x["t"]]
        assert tuple(g[c] for c in ("x0", "x1", *ki.COV)) == pytest.approx(tuple(x[c] for c in ("x0", "x1", *ki.COV)), rel=1e-8)


def test_elements_compose_in_any_grouping():
    r = np.random.default_rng(1)
    z = np.where(r.random(40) < 0.3, np.nan, r.normal(size=40))
    e = ki.elements(r.random(40) * 3, z, PARAMS[1])
    whole = ki.composed(e)
    for cut in (1, 7, 39):
        two = ki.compose(ki.composed(tuple(p[:cut] for p in e)), ki.composed(tuple(p[cut:] for p in e)))
        assert all(np.allclose(a, b) for a, b in zip(whole, two))


def test_only_gaps_empty_and_missing_times(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 2.5, None), ("a", None, 3.0), ("b", 1.0, float("nan"))], "k string, t double, z double")
    got = sorted(ki.kalman_irregular(df, "k", "z", ["t"], num_partitions=2).collect())
    assert [(x["k"], x["t"], x["z"]) for x in got] == [("a", 1.0, None), ("a", 2.5, None), ("b", 1.0, None)]
    assert [x["dt"] for x in got] == [1.0, 1.5, 1.0]
    assert ki.kalman_irregular(df.limit(0), "k", "z", ["t"]).count() == 0
