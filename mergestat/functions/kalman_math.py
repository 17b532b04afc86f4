"""Two-state (position, velocity) Kalman filter algebra (K1, K2).

State x = (x0 position, x1 velocity), observation z of the position.
Model: F = [[1, dt], [0, 1]], control ga = g * a with g = (dt^2/2, dt),
process noise Q = g g^T * sigma, observation H = [1, 0], observation
noise R = r.

Predict:  x <- F x + ga,            P <- F P F^T + Q
Update:   y = z - x0;  s = P00 + r;  k = P[:, 0] / s
          x <- x + k y,             P <- (I - k H) P

P and k never depend on z, so the gain sequence k_1, k_2, ... is a function
of the step number alone.  That makes every step an affine map of the
estimate, x_t = A_t x_{t-1} + c_t + k_t z_t, and lets a long trajectory be
filtered in parallel segments (see ``operators.kalman``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np


@dataclass(frozen=True)
class KalmanParams:
    # Fixed values of the original job: unit time step, acceleration (3, 3),
    # unit process-noise scale, observation noise 0.5, first estimate (10, 0)
    # and first covariance 2*I.
    dt: float = 1.0
    accel: tuple[float, float] = (3.0, 3.0)
    sigma: float = 1.0
    r: float = 0.5
    x_init: tuple[float, float] = (10.0, 0.0)
    p_init: tuple[float, float, float, float] = (2.0, 0.0, 0.0, 2.0)

    @property
    def g(self) -> tuple[float, float]:
        return (self.dt * self.dt / 2, self.dt)

    @property
    def ga(self) -> tuple[float, float]:
        g = self.g
        return (g[0] * self.accel[0], g[1] * self.accel[1])

    @property
    def q(self) -> tuple[float, float, float, float]:
        g = self.g
        return (g[0] * g[0] * self.sigma, g[0] * g[1] * self.sigma,
                g[1] * g[0] * self.sigma, g[1] * g[1] * self.sigma)


def predict_cov(p, prm: KalmanParams):
    """P <- F P F^T + Q, written out for F = [[1, dt], [0, 1]]."""
    p00, p01, p10, p11 = p
    dt = prm.dt
    q00, q01, q10, q11 = prm.q
    a00 = p00 + dt * p10
    a01 = p01 + dt * p11
    return (a00 + dt * a01 + q00, a01 + q01, p10 + dt * p11 + q10, p11 + q11)


def gain_and_update_cov(pp, prm: KalmanParams):
    """Gain k from the predicted covariance and the updated covariance."""
    p00, p01, p10, p11 = pp
    s = p00 + prm.r
    k0 = p00 / s
    k1 = p10 / s
    return (k0, k1), ((1 - k0) * p00, (1 - k0) * p01, p10 - k1 * p00, p11 - k1 * p01)


def step(x, p, z, prm: KalmanParams):
    """One full predict + update on plain floats; returns (x, p)."""
    dt = prm.dt
    ga0, ga1 = prm.ga
    x0 = x[0] + dt * x[1] + ga0
    x1 = x[1] + ga1
    (k0, k1), p_new = gain_and_update_cov(predict_cov(p, prm), prm)
    y = z - x0
    return (x0 + k0 * y, x1 + k1 * y), p_new


class Gains:
    """Gains and covariances after step t, for arrays of steps.

    The Riccati recursion ends in a float fixed point or cycle, typically after
    a few dozen steps; steps past the stored ones are read off the cycle, so the
    table depends on the parameters and never on the length of a key.  Without
    process noise it has no fixed point: there the inverse covariance is a sum
    of powers of t (``_noiseless``) and no table is kept.
    """

    def __init__(self, prm: KalmanParams):
        self.prm = prm
        p00, p01, p10, p11 = prm.p_init
        self.closed = prm.sigma == 0 and p00 * p11 - p01 * p10 != 0
        if self.closed:
            return
        gains, covs, seen = [], [], {}
        p = prm.p_init
        while p not in seen:
            seen[p] = len(covs)
            k, p = gain_and_update_cov(predict_cov(p, prm), prm)
            gains.append(k)
            covs.append(p)
        # covs[-1] is the state before gains[cycle]
        self.cycle = seen[p]
        self.gains, self.covs = np.array(gains), np.array(covs)

    def _noiseless(self, t: np.ndarray) -> np.ndarray:
        prm, t = self.prm, t.astype(float)
        p00, p01, p10, p11 = prm.p_init
        det = p00 * p11 - p01 * p10
        l00, l01, l10, l11 = p11 / det, -p01 / det, -p10 / det, p00 / det
        d = prm.dt
        a = l00 + t / prm.r
        b = l01 - t * d * l00 - d * t * (t - 1) / 2 / prm.r
        b2 = l10 - t * d * l00 - d * t * (t - 1) / 2 / prm.r
        c = l11 - t * d * (l01 + l10) + (t * d) ** 2 * l00 + d * d * (t - 1) * t * (2 * t - 1) / 6 / prm.r
        det = a * c - b * b2
        return np.stack([c / det, -b / det, -b2 / det, a / det], axis=-1)

    def at(self, steps) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(k0, k1, covariances) of 1-based ``steps``."""
        t = np.asarray(steps, np.int64)
        if self.closed:
            cov = self._noiseless(t)
            return cov[..., 0] / self.prm.r, cov[..., 2] / self.prm.r, cov
        n = len(self.gains)
        i = np.where(t <= n, t - 1, self.cycle + np.mod(t - 1 - self.cycle, n - self.cycle))
        g = self.gains[i]
        return g[..., 0], g[..., 1], self.covs[i]


@lru_cache(maxsize=8)
def gains_of(prm: KalmanParams) -> Gains:
    return Gains(prm)
