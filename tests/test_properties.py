"""Property tests: a run cut anywhere equals the whole."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from mergestat.functions.kalman_math import KalmanParams, step
from mergestat.operators import kalman

finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)
PRM = KalmanParams()


def _plain(zs):
    x, p, out = PRM.x_init, PRM.p_init, []
    for z in zs:
        x, p = step(x, p, z, PRM)
        out.append(x)
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(finite, min_size=1, max_size=200), st.data())
def test_composed_maps_carry_the_estimate(zs, data):
    cut = data.draw(st.integers(min_value=0, max_value=len(zs)))
    z, t = np.array(zs), np.arange(1, len(zs) + 1)
    x0, x1 = PRM.x_init if not cut else _plain(zs[:cut])[-1]
    m00, m01, m10, m11, v0, v1 = kalman._composed(z[cut:], t[cut:], PRM)
    got = (m00 * x0 + m01 * x1 + v0, m10 * x0 + m11 * x1 + v1)
    scale = max(1.0, max(map(abs, zs)))
    assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9 * scale) for a, b in zip(got, _plain(zs)[-1]))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(finite, min_size=1, max_size=150), min_size=1, max_size=6))
def test_scan_of_many_runs_equals_plain_recursions(runs):
    z = np.array([v for r in runs for v in r])
    of = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
    t = np.concatenate([np.arange(1, len(r) + 1) for r in runs])
    x = np.tile(np.array(PRM.x_init), (len(runs), 1))
    x0, x1, _ = kalman._scan(z, t, of, x, PRM)
    want = np.array([e for r in runs for e in _plain(r)])
    scale = max(1.0, np.abs(z).max())
    assert np.allclose(np.column_stack([x0, x1]), want, rtol=1e-9, atol=1e-9 * scale)
