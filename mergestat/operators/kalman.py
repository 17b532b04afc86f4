"""Per-key two-state Kalman filter over ordered observations (K1-K5).

The filter is a sequential recursion per key, but its gains depend on the step
number only (``functions.kalman_math``), so each step is an affine map
x -> A_t x + c_t + k_t z_t of the estimate.  A trajectory can be cut into
segments, each segment reduced to one composed map in parallel, the maps chained
per key, and the segments run from their correct incoming estimates.  So one key
with a third of all rows spreads over many tasks:

1. Rows are range-partitioned and sorted by (key, order); bounds are sampled from
   the whole sort key, so a hot key is cut too.  The result is checkpointed in the
   shared folder, so that all passes see the same partitions even after an
   executor is lost; Spark's cleaner removes it with the query
   (``spark.cleaner.referenceTracking.cleanCheckpoints``, set by ``get_session``).
2. ``_counts``: each partition reports the steps of its first and last key run,
   the only runs that cross a boundary.  A window per key over partitions gives
   every run the number of steps before it.
3. ``_maps``: with that number known, the composed map of those two runs.
4. ``_chain``: per key the maps applied in partition order give each partition's
   first run its incoming estimate (one row per partition, the only broadcast).
5. ``_filter``: each partition runs its rows from there.

Rows stay in Arrow: keys are compared null-safe and typed, other columns are
passed through untouched.  Inside a batch the recursion runs in numpy over blocks
of all runs at once (``_scan``).  Rows of equal order within a key have no defined
order; a key all of whose rows tie cannot be cut.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergestat.functions.kalman_math import KalmanParams, gains_of
from mergestat.sources.tables import key_names

DEFAULT = KalmanParams()
BLOCK = 64
MAP = ("m00", "m01", "m10", "m11", "v0", "v1")
COV = ("p00", "p01", "p10", "p11")


# ---------------------------------------------------------------- runs

def run_starts(keys: list[pa.Array], before: list[pa.Array] | None) -> np.ndarray:
    """Where a new key begins in a sorted batch; ``before`` is the row ahead of it."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[0] = before is None
    for k, c in enumerate(keys):
        c = pa.concat_arrays([before[k], c]) if before is not None else c
        a, b = c[1:], c[:-1]
        same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        if pa.types.is_floating(c.type):
            same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
        new[n - len(a):] |= ~same.to_numpy(zero_copy_only=False)
    return new


class _Runs:
    """The key runs of a partition, batch by batch.

    After ``read``: of the observation rows (``obs``) value ``z``, step ``t`` and
    run within the batch ``of``; of the runs the state at their start, ``t0``, ``x``.
    """

    def __init__(self, ks: list[str], prm: KalmanParams):
        self.ks, self.prm, self.last, self.any = ks, prm, None, False
        self.carry = (0, *prm.x_init)       # of the run that the last batch ended in

    def read(self, b: pa.RecordBatch, first: tuple | None = None) -> None:
        """``first`` is (t0, x0, x1) of the partition's first run, if known."""
        keys = [b.column(k) for k in self.ks]
        self.new = run_starts(keys, self.last)
        self.last = [c[-1:] for c in keys]
        at = np.cumsum(self.new) - int(self.new[0])
        runs = int(at[-1]) + 1
        self.t0 = np.zeros(runs, np.int64)
        self.x = np.tile(np.array(self.prm.x_init, float), (runs, 1))
        if not self.new[0]:
            self.t0[0], self.x[0] = self.carry[0], self.carry[1:]
        elif not self.any and first is not None:
            self.t0[0], self.x[0] = first[0], first[1:]
        self.any = True
        self.obs = slice(None)
        if "_k" in b.schema.names:
            kind = b.column("_k").to_numpy()
            known = np.flatnonzero(kind == 0)
            self.t0[at[known]] = b.column("_w").to_numpy(zero_copy_only=False)[known]
            for i, c in enumerate(("_ix0", "_ix1")):
                self.x[at[known], i] = b.column(c).to_numpy(zero_copy_only=False)[known]
            self.known = at[known]
            self.obs = np.flatnonzero(kind == 1)
        else:
            self.known = np.empty(0, int)
        self.of = at[self.obs]
        self.runs, self.n = runs, np.bincount(self.of, minlength=runs)
        self.z = b.column("_z").to_numpy(zero_copy_only=False)[self.obs].astype(float)
        self.t = self.t0[self.of] + np.arange(len(self.of)) - (np.cumsum(self.n) - self.n)[self.of] + 1

    def close(self, x0=None, x1=None) -> None:
        """Carry the state of the last run to the next batch."""
        r = self.runs - 1
        end = self.x[r] if not self.n[r] or x0 is None else (x0[-1], x1[-1])
        self.carry = (int(self.t0[r] + self.n[r]), *end)


# ---------------------------------------------------------------- recursion

def _map_blocks(z, k0, k1, prm: KalmanParams) -> np.ndarray:
    """Composed maps (rows x 6) of the rows of equally long blocks."""
    n = len(z)
    m = np.zeros((6, n))
    m[0] = m[3] = 1.0
    m00, m01, m10, m11, v0, v1 = m
    ga0, ga1 = prm.ga
    for p in range(z.shape[1]):
        a, b = k0[:, p], k1[:, p]
        m00 += prm.dt * m10
        m01 += prm.dt * m11
        v0 += prm.dt * v1 + ga0
        v1 += ga1
        y = z[:, p] - v0
        m10 -= b * m00
        m11 -= b * m01
        m00 -= a * m00
        m01 -= a * m01
        v0 += a * y
        v1 += b * y
    return m.T


def _after(a, b):
    """The map a after the map b."""
    a00, a01, a10, a11, av0, av1 = a
    b00, b01, b10, b11, bv0, bv1 = b
    return (a00 * b00 + a01 * b10, a00 * b01 + a01 * b11, a10 * b00 + a11 * b10, a10 * b01 + a11 * b11,
            a00 * bv0 + a01 * bv1 + av0, a10 * bv0 + a11 * bv1 + av1)


def _scan(z, t, of, x, prm: KalmanParams):
    """Estimates (x0, x1, covariances) of all rows of the batch's runs ``of``.

    Runs are cut into blocks.  Blocks that another one follows are reduced to
    maps, all at once; the maps carry the estimate from block to block; then all
    blocks step through their rows together.
    """
    k0, k1, cov = gains_of(prm).at(t)
    n = len(z)
    run_at = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if n else np.empty(0, int)
    size = np.diff(np.append(run_at, n))
    blocks = -(-size // BLOCK)
    run = np.repeat(np.arange(len(run_at)), blocks)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    at = run_at[run] + nth * BLOCK
    length = np.minimum(size[run] - nth * BLOCK, BLOCK)
    state = x[of[run_at]][run].T.copy()
    full = np.flatnonzero(nth + 1 < blocks[run])
    if len(full):
        rows = at[full][:, None] + np.arange(BLOCK)
        for i, m in zip(full.tolist(), _map_blocks(z[rows], k0[rows], k1[rows], prm).tolist()):
            a, b = state[0, i], state[1, i]
            state[0, i + 1] = m[0] * a + m[1] * b + m[4]
            state[1, i + 1] = m[2] * a + m[3] * b + m[5]
    longest = np.argsort(-length, kind="stable")
    at, length, (x0, x1) = at[longest], length[longest], state[:, longest]
    out0, out1 = np.empty(n), np.empty(n)
    ga0, ga1 = prm.ga
    for p in range(int(length[0]) if len(length) else 0):
        live = int(np.searchsorted(-length, -p, "left"))
        i = at[:live] + p
        a, b = x0[:live], x1[:live]
        a += prm.dt * b + ga0
        b += ga1
        y = z[i] - a
        a += k0[i] * y
        b += k1[i] * y
        out0[i], out1[i] = a, b
    return out0, out1, cov


def _composed(z, t, prm: KalmanParams):
    """One map of consecutive rows."""
    k0, k1, _ = gains_of(prm).at(t)
    whole = len(z) // BLOCK * BLOCK
    maps = list(_map_blocks(*(v[:whole].reshape(-1, BLOCK) for v in (z, k0, k1)), prm)) if whole else []
    if whole < len(z):
        maps += list(_map_blocks(*(v[None, whole:] for v in (z, k0, k1)), prm))
    out = _IDENTITY
    for m in maps:
        out = _after(m.tolist(), out)
    return out


_IDENTITY = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)


# ---------------------------------------------------------------- passes

def _ends(ks, pid, first, last, names, types, values):
    """The rows of a partition's first and (if another) last run."""
    rows = [first] if last is first else [first, last]
    cols = [pa.concat_arrays([r["key"][k] for r in rows]) for k in range(len(ks))]
    cols += [pa.array([pid] * len(rows), pa.int32()), pa.array([r is first for r in rows])]
    cols += [pa.array(c, t) for c, t in zip(zip(*map(values, rows)), types)]
    return pa.RecordBatch.from_arrays(cols, [*ks, "_pid", "_first", *names])


def _counts(ks: list[str]):
    """Steps of the first and last key run of each partition.  A known state
    (``initial``) counts as the steps it already holds."""
    def run(batches):
        before = first = last = pid = None
        for b in batches:
            if not b.num_rows:
                continue
            keys = [b.column(k) for k in ks]
            at = np.flatnonzero(run_starts(keys, before))
            before = [c[-1:] for c in keys]
            pid = b.column("_pid")[0].as_py()
            w = b.column("_w").to_numpy().astype(np.int64) if "_w" in b.schema.names \
                else np.ones(b.num_rows, np.int64)
            if last is not None:
                last["n"] += int(w[:at[0] if len(at) else len(w)].sum())
            if len(at):
                n = np.add.reduceat(w, at)
                ends = [{"key": [c[i:i + 1] for c in keys], "n": int(k)}
                        for i, k in ((at[0], n[0]), (at[-1], n[-1]))]
                if first is None:
                    first = last = ends[0]
                    at = at[1:]
                if len(at):
                    last = ends[1]
        if first is not None:
            yield _ends(ks, pid, first, last, ["_n"], [pa.int64()], lambda r: (r["n"],))
    return run


def _maps(ks: list[str], prm: KalmanParams):
    """The composed map of the first and last key run of each partition.

    A run whose start is known has a map that forgets its argument."""
    def run(batches):
        runs, first, last, pid = _Runs(ks, prm), None, None, None
        for b in batches:
            if not b.num_rows:
                continue
            pid = b.column("_pid")[0].as_py()
            opening = first is None
            runs.read(b, (b.column("_t0")[0].as_py(), *prm.x_init))
            starts = np.flatnonzero(runs.new)

            def opened(r, i):
                known = r in runs.known or not (opening and r == 0)
                return {"key": [b.column(k)[i:i + 1] for k in ks], "t0": int(runs.t0[r]),
                        "m": (0.0, 0.0, 0.0, 0.0, *runs.x[r]) if known else _IDENTITY}

            def extended(run_, r):
                rows = slice(*np.searchsorted(runs.of, [r, r + 1]))
                run_["m"] = _after(_composed(runs.z[rows], runs.t[rows], prm), run_["m"])

            if opening:
                first = last = opened(0, 0)
            if opening or not runs.new[0]:
                extended(last, 0)
            if runs.runs > 1 or (runs.new[0] and not opening):
                last = opened(runs.runs - 1, int(starts[-1]))
                extended(last, runs.runs - 1)
            runs.close()
        if first is not None:
            yield _ends(ks, pid, first, last, ["_t0", *MAP], [pa.int64(), *[pa.float64()] * 6],
                        lambda r: (r["t0"], *map(float, r["m"])))
    return run


def _chain(prm: KalmanParams):
    """Per key: the maps in partition order give each segment its incoming estimate."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pid")
        x0, x1 = prm.x_init
        came = []
        for m00, m01, m10, m11, v0, v1 in zip(*(pdf[c] for c in MAP)):
            came.append((x0, x1))
            x0, x1 = m00 * x0 + m01 * x1 + v0, m10 * x0 + m11 * x1 + v1
        return pd.DataFrame({"_pid": pdf["_pid"].to_numpy(), "_first": pdf["_first"].to_numpy(),
                             "_x0": [c[0] for c in came], "_x1": [c[1] for c in came]})
    return run


def _filter(ks: list[str], passed: list[str], prm: KalmanParams, ends_only: bool):
    """Every row's estimate; with ``ends_only`` each run's last row of a batch."""
    def run(batches):
        runs = _Runs(ks, prm)
        for b in batches:
            if not b.num_rows:
                continue
            runs.read(b, tuple(b.column(c)[0].as_py() for c in ("_t0", "_x0", "_x1")))
            x0, x1, cov = _scan(runs.z, runs.t, runs.of, runs.x, prm)
            runs.close(x0, x1)
            n = len(runs.z)
            keep = np.flatnonzero(np.append(runs.of[1:] != runs.of[:-1], True)) if ends_only and n else np.arange(n)
            rows = pa.array(np.arange(b.num_rows)[runs.obs][keep])
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c).take(rows) for c in (*ks, *passed)], pa.array(runs.t[keep]), pa.array(runs.z[keep]),
                 pa.array(x0[keep]), pa.array(x1[keep]), *[pa.array(c) for c in cov.reshape(-1, 4)[keep].T]],
                [*ks, *passed, "step", "z", "x0", "x1", *COV])
    return run


# ---------------------------------------------------------------- public API

def _stage(df: DataFrame, ks: list[str], order: list[str], z: str, passthrough: list[str],
           num_partitions: int | None, initial: DataFrame | None = None) -> DataFrame:
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = list(dict.fromkeys([*ks, *order, *passthrough]))
    base = df.where(F.col(z).isNotNull()).select(*cols, F.col(z).cast("double").alias("_z"))
    sort = [*ks, *order]
    if initial is not None:
        # Known states travel as rows of kind 0, ahead of their key's observations.
        base = base.select("*", F.lit(1).alias("_k"), F.lit(1).cast("long").alias("_w"),
                           F.lit(None).cast("double").alias("_ix0"), F.lit(None).cast("double").alias("_ix1"))
        states = initial.select(
            *ks, *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in cols if c not in ks],
            F.lit(None).cast("double").alias("_z"), F.lit(0).alias("_k"), F.col("n").cast("long").alias("_w"),
            F.col("x0").cast("double").alias("_ix0"), F.col("x1").cast("double").alias("_ix1"))
        base = base.unionByName(states)
        sort = [*ks, "_k", *order]
    staged = (base.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
              .withColumn("_pid", F.spark_partition_id()))
    return staged.checkpoint(eager=True)


def kalman_trace(df: DataFrame, keys: str | Sequence[str], z: str,
                 order: Sequence[str] = ("ts", "event_id"),
                 params: KalmanParams = DEFAULT, num_partitions: int | None = None,
                 passthrough: Sequence[str] | None = None, ends_only: bool = False,
                 initial: DataFrame | None = None) -> DataFrame:
    """K4/K5: the estimate after every observation, per key, in ``order``.

    Output: key..., passthrough (default: the order columns), step (1-based
    per key), z, x0 (position), x1 (velocity), p00, p01, p10, p11.  Rows with
    NULL z are not observations and are skipped.

    ``initial`` (key..., n, x0, x1) — e.g. a previous ``kalman_final`` —
    resumes those keys from a known estimate after n steps, so a long
    history can be filtered in increments.
    """
    ks, order = key_names(keys), list(order)
    passed = [c for c in (order if passthrough is None else passthrough) if c not in ks]
    staged = _stage(df, ks, order, z, passed, num_partitions, initial)

    def fields(*named):
        return [T.StructField(c, t) for c, t in named]
    key_fields = [T.StructField(k, staged.schema[k].dataType) for k in ks]
    run_fields = [*key_fields, *fields(("_pid", T.IntegerType()), ("_first", T.BooleanType()))]
    doubles = [(c, T.DoubleType()) for c in MAP]

    extra = ["_k", "_w", "_ix0", "_ix1"] if initial is not None else []
    slim = staged.select(*ks, "_z", *extra, "_pid")
    counts = slim.mapInArrow(_counts(ks), T.StructType([*run_fields, *fields(("_n", T.LongType()))]))
    before = Window.partitionBy(*ks).orderBy("_pid").rangeBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_t0", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long")) \
        .where("_first").select("_pid", "_t0")
    maps = slim.join(F.broadcast(offsets), "_pid").select(*slim.columns, "_t0").mapInArrow(
        _maps(ks, params), T.StructType([*run_fields, *fields(("_t0", T.LongType()), *doubles)]))
    chained = maps.groupBy(*ks).applyInPandas(
        lambda pdf: _chain(params)(pdf), "_pid int, _first boolean, _x0 double, _x1 double")
    came = chained.where("_first").drop("_first").join(F.broadcast(offsets), "_pid")
    out = T.StructType([*key_fields, *[T.StructField(c, staged.schema[c].dataType) for c in passed],
                        *fields(("step", T.LongType()), *[(c, T.DoubleType()) for c in ("z", "x0", "x1", *COV)])])
    rows = slim if not passed and ends_only else staged
    return (rows.join(F.broadcast(came), "_pid").select(*rows.columns, "_t0", "_x0", "_x1")
            .mapInArrow(_filter(ks, passed, params, ends_only), out))


def kalman_final(df: DataFrame, keys, z: str, order: Sequence[str] = ("ts", "event_id"),
                 params: KalmanParams = DEFAULT, num_partitions: int | None = None,
                 initial: DataFrame | None = None) -> DataFrame:
    """K3: the state after the last observation of each key: count, estimate
    and covariance.  Only run ends leave the filter pass.  Keys of ``initial``
    without new observations are not returned."""
    ends = kalman_trace(df, keys, z, order, params, num_partitions, passthrough=[],
                        ends_only=True, initial=initial)
    return final_from_trace(ends, keys)


def final_from_trace(trace: DataFrame, keys) -> DataFrame:
    """Last row per key of a trace: (key..., n, x0, x1, p00, p01, p10, p11)."""
    ks = key_names(keys)
    last = F.max_by(F.struct("step", "x0", "x1", *COV), F.col("step"))
    return (trace.groupBy(*ks).agg(last.alias("s"))
                .select(*ks, F.col("s.step").alias("n"), "s.x0", "s.x1", *[f"s.{c}" for c in COV]))


def kalman_errors(df: DataFrame, keys, z: str, truth: str, order: Sequence[str] = ("ts", "event_id"),
                  params: KalmanParams = DEFAULT, num_partitions: int | None = None) -> DataFrame:
    """The true position beside the estimate: (key..., n, rmse_observed, rmse_estimate, mean_error, worst_error).

    Errors against column ``truth``, over the observations where it is known: of the observation
    itself, and of the filter's estimate after it.
    """
    ks = key_names(keys)
    trace = kalman_trace(df, ks, z, order, params, num_partitions, passthrough=[truth])
    t = F.col(truth)
    seen, found = F.col("z") - t, F.col("x0") - t
    return trace.where(t.isNotNull()).groupBy(*ks).agg(
        F.count(t).alias("n"), F.sqrt(F.avg(seen * seen)).alias("rmse_observed"), F.sqrt(F.avg(found * found)).alias("rmse_estimate"),
        F.avg(found).alias("mean_error"), F.max(F.abs(found)).alias("worst_error"))
