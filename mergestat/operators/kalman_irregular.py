"""Kalman filter over steps of unequal length, with gaps in the observations (K1-K5).

The model of ``functions.kalman_math`` where each step has a length of its own: the time
since the key's row before it (in units of ``unit``; the first row is one regular
step from the initial state).  A row without a value is a step too: it is predicted and
not updated.  With equal steps and no gaps this is ``kalman.kalman_trace``.

Gains now depend on the rows, so a segment is no affine map of the estimate alone.
Each step is a five-part element (A, b, C, eta, J): what it makes of an estimate and
covariance that come in, and what its observations say about them.  Elements compose
associatively (the filtering elements of Sarkka and Garcia-Fernandez, 2021), so a hot
key is cut into segments as there: rows are range-partitioned on (key, order), each
partition composes the elements of its first and last key run, these are
chained per key (two rows a partition), and every partition then filters its
rows from the estimate and covariance that come in.  Two small passes before that tell a
partition the time of the row ahead of it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergestat.functions.kalman_math import KalmanParams
from mergestat.operators.kalman import COV, run_starts
from mergestat.sources.tables import key_names

DEFAULT = KalmanParams()
BLOCK = 64
#: Fields of an element: A and C and J by rows, b and eta.
PARTS = [f"{m}{i}{j}" for m in "acj" for i in "01" for j in "01"] + ["b0", "b1", "e0", "e1"]


# ---------------------------------------------------------------- algebra

def _model(dt: np.ndarray, prm: KalmanParams):
    """Transition, control and process noise of steps of the given lengths."""
    f = np.zeros((len(dt), 2, 2))
    f[:, 0, 0] = f[:, 1, 1] = 1.0
    f[:, 0, 1] = dt
    g = np.stack([dt * dt / 2, dt], 1)
    return f, g * np.array(prm.accel), prm.sigma * g[:, :, None] * g[:, None, :]


def elements(dt: np.ndarray, z: np.ndarray, prm: KalmanParams) -> tuple[np.ndarray, ...]:
    """(A, b, C, eta, J) of each step; ``z`` is NaN where nothing was observed."""
    f, u, q = _model(dt, prm)
    seen = ~np.isnan(z)
    s = q[:, 0, 0] + prm.r
    k = np.where(seen[:, None], q[:, :, 0] / s[:, None], 0.0)
    y = np.where(seen, np.nan_to_num(z) - u[:, 0], 0.0)
    keep = np.zeros_like(f)
    keep[:, 0, 0], keep[:, 1, 0], keep[:, 1, 1] = 1 - k[:, 0], -k[:, 1], 1.0
    h = np.where(seen[:, None], f[:, 0, :], 0.0)                # what the observation says of the state before
    return keep @ f, u + k * y[:, None], keep @ q, h * (y / s)[:, None], h[:, :, None] * h[:, None, :] / s[:, None, None]


def compose(first: tuple, then: tuple) -> tuple[np.ndarray, ...]:
    """The element of ``first`` followed by ``then``, stack by stack."""
    a1, b1, c1, e1, j1 = first
    a2, b2, c2, e2, j2 = then
    d = a2 @ np.linalg.inv(np.eye(2) + c1 @ j2)
    back = a1.transpose(0, 2, 1) @ np.linalg.inv(np.eye(2) + j2 @ c1)
    return (d @ a1, (d @ (b1 + (c1 @ e2[..., None])[..., 0])[..., None])[..., 0] + b2,
            d @ c1 @ a2.transpose(0, 2, 1) + c2,
            (back @ (e2 - (j2 @ b1[..., None])[..., 0])[..., None])[..., 0] + e1, back @ j2 @ a1 + j1)


def composed(parts: tuple) -> tuple[np.ndarray, ...]:
    """One element of consecutive ones, pairing neighbours until one is left."""
    while len(parts[0]) > 1:
        n = len(parts[0]) // 2 * 2
        pairs = compose(tuple(p[:n:2] for p in parts), tuple(p[1:n:2] for p in parts))
        parts = tuple(np.concatenate([x, p[n:]]) for x, p in zip(pairs, parts))
    return parts


def applied(x: np.ndarray, p: np.ndarray, part: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Estimate and covariance behind an element, from those before it."""
    a, b, c, e, j = part
    d = a @ np.linalg.inv(np.eye(2) + p @ j)
    return (d @ (x + (p @ e[..., None])[..., 0])[..., None])[..., 0] + b, d @ p @ np.swapaxes(a, -1, -2) + c


def _step(x: np.ndarray, p: np.ndarray, f, u, q, z, prm: KalmanParams):
    """Predict and, where something was observed, update; rows side by side."""
    x = (f @ x[..., None])[..., 0] + u
    p = f @ p @ f.transpose(0, 2, 1) + q
    k = np.where(np.isnan(z)[:, None], 0.0, p[:, :, 0] / (p[:, 0, 0] + prm.r)[:, None])
    x = x + k * (np.nan_to_num(z) - x[:, 0])[:, None]
    return x, p - k[:, :, None] * p[:, None, 0, :]


def scan(dt: np.ndarray, z: np.ndarray, starts: np.ndarray, x: np.ndarray, p: np.ndarray, prm: KalmanParams):
    """Estimates and covariances of all rows; run i begins at ``starts[i]`` from (x[i], p[i]).

    Runs are cut into blocks.  Blocks that another one follows are composed, all of them
    together, and carry their run on; then all blocks step through their rows side by side.
    """
    n = len(z)
    size = np.diff(np.append(starts, n))
    blocks = -(-size // BLOCK)
    run = np.repeat(np.arange(len(starts)), blocks)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    at = starts[run] + nth * BLOCK
    length = np.minimum(size[run] - nth * BLOCK, BLOCK)
    bx, bp = x[run].copy(), p[run].copy()
    full = np.flatnonzero(nth + 1 < blocks[run])
    if len(full):
        whole = None
        for i in range(BLOCK):
            e = elements(dt[at[full] + i], z[at[full] + i], prm)
            whole = e if whole is None else compose(whole, e)
        for k, i in enumerate(full.tolist()):
            bx[i + 1], bp[i + 1] = applied(bx[i], bp[i], tuple(w[k] for w in whole))
    longest = np.argsort(-length, kind="stable")
    at, length, bx, bp = at[longest], length[longest], bx[longest], bp[longest]
    out_x, out_p = np.empty((n, 2)), np.empty((n, 2, 2))
    f, u, q = _model(dt, prm)
    for i in range(int(length[0]) if len(length) else 0):
        live = int(np.searchsorted(-length, -i, "left"))
        rows = at[:live] + i
        bx[:live], bp[:live] = _step(bx[:live], bp[:live], f[rows], u[rows], q[rows], z[rows], prm)
        out_x[rows], out_p[rows] = bx[:live], bp[:live]
    return out_x, out_p


# ---------------------------------------------------------------- passes

class _Rows:
    """Key runs and step lengths of a partition's rows, batch by batch."""

    def __init__(self, ks: list[str], prm: KalmanParams, unit: float):
        self.ks, self.prm, self.unit, self.keys, self.time = ks, prm, unit, None, None

    def read(self, b: pa.RecordBatch, before: float | None = None) -> None:
        """``before`` is the time of the row ahead of the partition, if of the same key."""
        keys = [b.column(k) for k in self.ks]
        new = run_starts(keys, self.keys)
        t = b.column("_t").to_numpy(zero_copy_only=False).astype(float)
        if self.keys is None and before is not None:
            new[0], self.time = False, before
        self.z = b.column("_z").to_numpy(zero_copy_only=False).astype(float)
        self.dt = np.diff(t, prepend=t[0] if self.time is None else self.time) / self.unit
        self.dt[new] = self.prm.dt
        self.goes_on = not new[0]
        self.starts = np.union1d([0], np.flatnonzero(new))
        self.keys, self.time = [c[-1:] for c in keys], t[-1]


def _ends(ks: list[str], prm: KalmanParams, unit: float, with_elements: bool):
    """(key, partition, whether its first run, last time or element) of each partition's first and last run."""
    names = PARTS if with_elements else ["_last"]

    def run(batches):
        rows, ends, pid = _Rows(ks, prm, unit), [], None
        for b in batches:
            if not b.num_rows:
                continue
            pid = b.column("_pid")[0].as_py()
            opening = not ends
            rows.read(b, b.column("_before")[0].as_py() if with_elements else None)
            t = b.column("_t").to_numpy(zero_copy_only=False)
            cut = np.append(rows.starts, b.num_rows)
            for r in sorted({0, len(rows.starts) - 1}):
                part = slice(int(cut[r]), int(cut[r + 1]))
                what = composed(elements(rows.dt[part], rows.z[part], prm)) if with_elements else float(t[part.stop - 1])
                if r == 0 and not opening and rows.goes_on:
                    ends[-1][1] = compose(ends[-1][1], what) if with_elements else what
                    continue
                ends = ends[:1] + [[[b.column(k)[part.start:part.start + 1] for k in ks], what]]
        if ends:
            cols = [pa.concat_arrays([e[0][k] for e in ends]) for k in range(len(ks))]
            cols += [pa.array([pid] * len(ends), pa.int32()), pa.array([i == 0 for i in range(len(ends))])]
            values = [np.concatenate([w[i].ravel() for i in (0, 2, 4, 1, 3)]).tolist() if with_elements else [w] for _, w in ends]
            cols += [pa.array(c, pa.float64()) for c in zip(*values)]
            yield pa.RecordBatch.from_arrays(cols, [*ks, "_pid", "_first", *names])
    return run


def _unpacked(row) -> tuple[np.ndarray, ...]:
    a, c, j, b, e = np.split(np.array(row, float), [4, 8, 12, 14])
    return a.reshape(2, 2), b, c.reshape(2, 2), e, j.reshape(2, 2)


def _chain(prm: KalmanParams):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pid")
        x, p = np.array(prm.x_init, float), np.array(prm.p_init, float).reshape(2, 2)
        came = []
        for row in pdf[PARTS].itertuples(index=False):
            came.append((*x, *p.ravel()))
            x, p = applied(x, p, _unpacked(row))
        out = pd.DataFrame(came, columns=["_x0", "_x1", "_p00", "_p01", "_p10", "_p11"])
        return pd.concat([pdf[["_pid", "_first"]].reset_index(drop=True), out], axis=1)
    return run


def _filter(ks: list[str], passed: list[str], prm: KalmanParams, unit: float):
    def run(batches):
        rows, end = _Rows(ks, prm, unit), None
        init = np.array(prm.x_init, float), np.array(prm.p_init, float).reshape(2, 2)
        for b in batches:
            if not b.num_rows:
                continue
            rows.read(b, b.column("_before")[0].as_py())
            x, p = np.tile(init[0], (len(rows.starts), 1)), np.tile(init[1], (len(rows.starts), 1, 1))
            if rows.goes_on:
                came = end or (np.array([b.column(c)[0].as_py() for c in ("_x0", "_x1")]),
                               np.array([b.column(f"_{c}")[0].as_py() for c in COV]).reshape(2, 2))
                x[0], p[0] = came
            ox, op = scan(rows.dt, rows.z, rows.starts, x, p, prm)
            end = ox[-1], op[-1]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in (*ks, *passed)], pa.array(rows.dt), b.column("_z"), pa.array(ox[:, 0].copy()),
                 pa.array(ox[:, 1].copy()), *[pa.array(c.copy()) for c in op.reshape(-1, 4).T]],
                [*ks, *passed, "dt", "z", "x0", "x1", *COV])
    return run


def kalman_irregular(df: DataFrame, keys: str | Sequence[str], z: str, order: Sequence[str] = ("ts", "event_id"),
                     unit: float = 1.0, params: KalmanParams = DEFAULT, num_partitions: int | None = None,
                     passthrough: Sequence[str] | None = None) -> DataFrame:
    """The estimate after every row, per key, in ``order``.

    ``order`` begins with the time: a timestamp (``unit`` in seconds) or a number (in
    its own units).  Output: key..., passthrough (default: the order columns), dt, z, x0,
    x1, p00, p01, p10, p11.  Rows whose z is NULL or NaN are predicted only; rows without a
    time are left out, as they are no step.
    """
    ks, order = key_names(keys), list(order)
    passed = [c for c in (order if passthrough is None else passthrough) if c not in ks]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    time = F.col(order[0])
    kind = df.schema[order[0]].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        time, unit = F.unix_micros(time.cast("timestamp")).cast("double"), unit * 1e6
    else:
        time = time.cast("double")
    cols = list(dict.fromkeys([*ks, *order, *passed]))
    value = F.col(z).cast("double")
    base = df.where(F.col(order[0]).isNotNull()).select(*cols, F.when(~F.isnan(value), value).alias("_z"), time.alias("_t"))
    # reliably checkpointed: all passes see the same partitions, also after a lost executor
    staged = base.repartitionByRange(n, *ks, *order).sortWithinPartitions(*ks, *order) \
        .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)

    def schema(*named):
        return T.StructType([*[T.StructField(k, staged.schema[k].dataType) for k in ks],
                             *[T.StructField(c, t) for c, t in named]])
    ends = [("_pid", T.IntegerType()), ("_first", T.BooleanType())]
    slim = staged.select(*ks, "_z", "_t", "_pid")
    last = slim.mapInArrow(_ends(ks, params, unit, False), schema(*ends, ("_last", T.DoubleType())))
    ahead = last.withColumn("_before", F.lag("_last").over(Window.partitionBy(*ks).orderBy("_pid"))) \
        .where("_first").select("_pid", "_before")
    told = slim.join(F.broadcast(ahead), "_pid").select(*slim.columns, "_before")
    parts = told.mapInArrow(_ends(ks, params, unit, True), schema(*ends, *[(c, T.DoubleType()) for c in PARTS]))
    came = ["_x0", "_x1", "_p00", "_p01", "_p10", "_p11"]
    chained = parts.groupBy(*ks).applyInPandas(_chain(params), "_pid int, _first boolean, " + ", ".join(f"{c} double" for c in came)) \
        .where("_first").drop("_first").join(F.broadcast(ahead), "_pid")
    out = schema(*[(c, staged.schema[c].dataType) for c in passed], *[(c, T.DoubleType()) for c in ("dt", "z", "x0", "x1", *COV)])
    return staged.join(F.broadcast(chained), "_pid").select(*staged.columns, "_before", *came) \
        .mapInArrow(_filter(ks, passed, params, unit), out)
