"""Approximate nearest neighbours on shifted space-filling curves.

Each of ``curves`` orderings projects the vectors on its own random orthogonal
directions, shifts them by a random offset, cuts them to a grid and orders them
by their place on the Hilbert curve.  The curve goes on inside a cell, level by
level down to the resolution of the components, and the outermost cells are
open, their outside squeezed in; so a dense cluster of distinct vectors is
ordered by place too, wherever it lies.  A query looks at the rows within
``half`` places on either side (at an end of the curve: as many on the one side)
and keeps its nearest by the exact distance.  What the windows of all curves found is merged and ranked.

Each ordering is cut into blocks of several windows, and a block also gets the
``half`` rows before and behind it, so every window is whole, however many
partitions there are.  The cuts come from a sort of the keys alone.

The scale of the grid comes from at most ``SAMPLE_ROWS`` vectors; every vector is
indexed.  Curves help as far as the data have structure.  Where they have none
(points spread evenly on a sphere) a window holds a true neighbour only somewhat
more often than chance, so ``half`` grows as the number of vectors to the power
3/4, see ``half_window``; candidates per query stay sublinear and recall is
measured against brute force in the tests.

Equal vectors are one class: the windows hold distinct vectors, and the ids of a
class (its k + 1 smallest suffice) are spelled out in the end.  So a vector that
a third of all rows share is one row of the index.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without id, take no part; vectors are compared with those
of their own length only; repeated rows count once; an id with several vectors
is answered from all of them; ties go to the smaller id; fewer candidates than k
give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged

K, CURVES, AXES, KEY_BITS, SEED = 10, 64, 16, 48, 42
#: Bits an axis, down to the resolution of the components.
DEPTH = {"<f4": 28, "<f8": 52}
SAMPLE_ROWS, PARTITION_ROWS = 2000, 100_000
#: Rows of a block at least, and windows it is as long as at least.
BLOCK_ROWS, BLOCK_WINDOWS = 4000, 4


def half_window(n: int) -> int:
    """Places a query looks at on either side among n distinct vectors."""
    return max(128, math.ceil(n ** 0.75 / 9))


def _unfolded(grid: np.ndarray, bits: int) -> list[np.ndarray]:
    """Axes whose bits, read across from the top level down, are the place of
    each row of grid coordinates below 2**bits on the Hilbert curve.

    From the top bit down, an axis whose bit is set reflects the first axis
    below that bit, one whose bit is not set swaps with it; the Gray code of
    what results, read across the axes, is the place.
    """
    kind = np.uint32 if bits <= 32 else np.uint64
    axes = [c.astype(kind) for c in grid.T]
    one = kind(1)
    for level in range(bits - 1, 0, -1):
        bit, low = kind(level), kind((1 << level) - 1)
        for k in range(len(axes)):
            up = (kind(0) - ((axes[k] >> bit) & one)) & low
            swap = (axes[0] ^ axes[k]) & (up ^ low)
            axes[k] ^= swap
            axes[0] ^= swap | up
    for k in range(1, len(axes)):
        axes[k] ^= axes[k - 1]
    turn = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        turn ^= (kind(0) - ((axes[-1] >> kind(level)) & one)) & kind((1 << level) - 1)
    return [a ^ turn for a in axes]


def hilbert(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid coordinates below 2**bits."""
    axes = _unfolded(grid, bits)
    place, one = np.zeros(len(grid), np.uint64), np.uint64(1)
    for level in range(bits - 1, -1, -1):
        for a in axes:
            place = (place << one) | ((a >> level).astype(np.uint64) & one)
    return place


def hilbert_bytes(grid: np.ndarray, bits: int) -> np.ndarray:
    """``hilbert`` of any length, as bytes (rows x bytes) that sort alike."""
    axes = np.stack(_unfolded(grid, bits), 1).astype(">u8")
    apart = np.unpackbits(axes.view(np.uint8).reshape(*axes.shape, 8), axis=2)[:, :, 64 - bits:]
    return np.packbits(apart.transpose(0, 2, 1).reshape(len(grid), -1), axis=1)


def _directions(dim: int, curve: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim, curve])
    axes = min(AXES, dim)
    q, _ = np.linalg.qr(rng.standard_normal((dim, axes)))
    return q, rng.random(axes)


def _grid(at: np.ndarray, bits: int, depth: int) -> np.ndarray:
    """Coordinates of ``depth`` bits of places in units of the 2**bits cells; what
    lies outside is squeezed into the outermost cells, in order."""
    cell = np.clip(np.floor(at), 0, (1 << bits) - 1)
    rest = at - cell
    rest = np.where(cell == 0, 1 / (2 - np.minimum(rest, 1)), np.where(cell == (1 << bits) - 1, rest / (1 + np.abs(rest)), rest))
    fine = 1 << (depth - bits)
    return cell.astype(np.int64) * fine + np.clip(rest * fine, 0, fine - 1).astype(np.int64)


def curve_keys(x: np.ndarray, ids: np.ndarray, mean: np.ndarray, spread: float, curves: int, seed: int,
               kind: str) -> np.ndarray:
    """Sort keys (rows x curves x bytes) of vectors: the place on the curve, then the id."""
    depth = DEPTH[kind]
    width = AXES * depth // 8
    out = np.zeros((len(x), curves, width + 8), np.uint8)
    tie = (ids.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
    for c in range(curves):
        q, shift = _directions(x.shape[1], c, seed)
        bits = min(16, KEY_BITS // q.shape[1])
        # six standard deviations cover the grid, less one cell for the shift
        cell = 6 * spread / ((1 << bits) - 1)
        place = hilbert_bytes(_grid(((x - mean) @ q + 3 * spread) / cell + shift, bits, depth), depth)
        out[:, c, :place.shape[1]] = place
        out[:, c, width:] = tie
    return out


def usable(vector: Column) -> Column:
    return (vector.isNotNull() & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
            & F.exists(vector, lambda v: v != 0))


def _matrix(column: pa.Array, rows: np.ndarray, dim: int) -> np.ndarray:
    """Rows of a column of number arrays of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    first = column.offsets.to_numpy()[:-1][rows] - column.offsets[0].as_py()
    return flat[first[:, None] + np.arange(dim)].astype(np.float64)


def _packed(column: pa.Array, rows: slice, kind: str) -> np.ndarray:
    """Neighbouring rows of a binary column of equally long vectors."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:][rows.start:rows.stop + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]
    return raw.view(kind).reshape(rows.stop - rows.start, -1)


def _binary(keys: np.ndarray) -> pa.Array:
    """Binary column of equally long byte strings, the last axis of ``keys``."""
    n, width = keys.size // keys.shape[-1], keys.shape[-1]
    ends = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(keys))])


def _classes(vectors: DataFrame, k: int) -> DataFrame:
    """(cid, v, dim, ids): distinct vectors with their k + 1 smallest ids."""
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    low = vectors.withColumn("rn", first).where(F.col("rn") <= k + 1)
    return low.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.element_at("ids", 1).alias("cid"), "v", F.size("v").alias("dim"), "ids")


def _scales(classes: DataFrame) -> dict[int, tuple[np.ndarray, float]]:
    """Mean and standard deviation per dimension of a bounded sample, by vector length."""
    rows = classes.select("dim", "v", F.xxhash64("cid").alias("h")).orderBy("h").limit(SAMPLE_ROWS).collect()
    found = {}
    for dim in {r["dim"] for r in rows}:
        x = np.array([r["v"] for r in rows if r["dim"] == dim], np.float64)
        found[dim] = (x.mean(0), float(max(x.std(), 1e-12)))
    return found


def _indexed(classes: DataFrame, curves: int, seed: int, kind: str) -> DataFrame:
    """(cid, dim, raw, keys): the vector's bytes, which every curve's row carries,
    and the sort key on each curve."""
    scales = _scales(classes)

    def run(batches):
        for b in batches:
            dims, ids, vectors = b.column("dim").to_numpy(), b.column("cid").to_numpy(), b.column("v")
            keys = np.empty((b.num_rows, curves, AXES * DEPTH[kind] // 8 + 8), np.uint8)
            raw = np.empty(b.num_rows, object)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x = _matrix(vectors, rows, dim)
                mean, spread = scales.get(int(dim), (np.zeros(dim), 1.0))
                keys[rows] = curve_keys(x, ids[rows], mean, spread, curves, seed, kind)
                raw[rows] = [v.tobytes() for v in x.astype(kind)]
            offsets = pa.array(np.arange(0, b.num_rows * curves + 1, curves, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("cid"), b.column("dim"), pa.array(raw, pa.binary()),
                 pa.ListArray.from_arrays(offsets, _binary(keys))], ["cid", "dim", "raw", "keys"])

    return classes.mapInArrow(run, "cid long, dim int, raw binary, keys array<binary>")


def _marks(every: int):
    """Task function: sorted keys to each ``every``-th of a partition's part of an
    ordering and its last one, with their places in that part."""
    def run(batches):
        part, now, at, last = TaskContext.get().partitionId(), None, 0, None
        out = []

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.bool_()))],
                ["curve", "dim", "part", "pos", "key", "last"])

        for b in batches:
            if not b.num_rows:
                continue
            curve, dims, keys = b.column("curve").to_numpy(), b.column("dim").to_numpy(), b.column("key")
            cut = np.flatnonzero((curve[1:] != curve[:-1]) | (dims[1:] != dims[:-1])) + 1
            for a, z in zip([0, *cut.tolist()], [*cut.tolist(), len(curve)]):
                if now != (int(curve[a]), int(dims[a])):
                    if now:
                        out.append((*now, part, at - 1, last, True))
                    now, at = (int(curve[a]), int(dims[a])), 0
                out += [(*now, part, at + i - a, keys[i].as_py(), False) for i in range(a + -at % every, z, every)]
                at, last = at + z - a, keys[z - 1].as_py()
            if out:
                yield flush()
                out = []
        if now:
            out.append((*now, part, at - 1, last, True))
            yield flush()

    return run


def _cuts(index: DataFrame, sizes: dict[int, int], curves: int, half: int, parts: int) -> tuple[dict, int]:
    """{(curve, dim): (number of its first block, cuts, first keys carried over
    each cut forwards, last keys carried backwards)} and the number of blocks.

    Cuts lie on keys whose place in the ordering is known; at least ``half`` rows
    are carried.
    """
    rows = max(BLOCK_ROWS, BLOCK_WINDOWS * (2 * half + 1))
    every = max(1, half // 2)
    known: dict = {}
    if max(sizes.values(), default=0) >= 2 * rows:
        key = ["curve", "dim", "key"]
        keys = index.select("dim", F.posexplode("keys").alias("curve", "key")).repartitionByRange(parts, *key)
        marks = keys.sortWithinPartitions(*key).select(*key).mapInArrow(
            _marks(every), "curve int, dim int, part int, pos long, key binary, last boolean")
        for r in sorted(marks.collect(), key=lambda r: (r["curve"], r["dim"], r["part"], r["pos"], r["last"])):
            places, names, before = known.setdefault((r["curve"], r["dim"]), ([], [], [0]))
            places.append(before[0] + r["pos"])
            names.append(bytes(r["key"]))
            if r["last"]:
                before[0] += r["pos"] + 1
    found, blocks = {}, 0
    for curve in range(curves):
        for dim in sorted(sizes):
            n = sizes[dim]
            many = max(1, n // rows)
            cuts, ahead, behind = [], [], []
            if many > 1:
                places, names, _ = known[curve, dim]
                for b in range(1, many):
                    at = bisect_left(places, b * n // many)
                    cuts.append(names[at])
                    ahead.append(names[bisect_right(places, places[at] - half) - 1])
                    behind.append(names[bisect_left(places, places[at] + half - 1)])
            found[curve, dim] = (blocks, *(np.array(x, f"S{len(names[0])}") if x else None for x in (cuts, ahead, behind)))
            blocks += many
    return found, blocks


def _dealt(cuts: dict):
    """Task function: rows of the index to one row per curve and block that a
    vector is in or carried to; it asks in its own block."""
    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                b = whole.slice(start, 500)
                dims, ask = b.column("dim").to_numpy(), b.column("asks").to_numpy(zero_copy_only=False)
                flat = b.column("keys").flatten()
                keys = _packed(flat, slice(0, len(flat)), "u1").reshape(b.num_rows, -1, len(flat[0].as_py()))
                out = []
                for dim in np.unique(dims).tolist():
                    rows = np.flatnonzero(dims == dim)
                    for c in range(keys.shape[1]):
                        first, cut, ahead, behind = cuts[c, dim]
                        own = np.zeros(len(rows), np.int64)
                        if cut is not None:
                            key = np.ascontiguousarray(keys[rows, c]).view(cut.dtype).ravel()
                            own = np.searchsorted(cut, key, "right")
                            on = np.flatnonzero(own < len(cut))
                            on = on[key[on] >= ahead[own[on]]]
                            back = np.flatnonzero(own > 0)
                            back = back[key[back] <= behind[own[back] - 1]]
                            for moved, by in ((on, 1), (back, -1)):
                                out.append((rows[moved], np.full(len(moved), c), first + own[moved] + by, np.zeros(len(moved), bool)))
                        out.append((rows, np.full(len(rows), c), first + own, ask[rows]))
                rows, curve, block, asks = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.astype(np.int32)), _binary(keys[rows, curve]), b.column("cid").take(pa.array(rows)),
                     pa.array(asks), b.column("raw").take(pa.array(rows))], ["block", "key", "cid", "asks", "raw"])

    return run


def _windows(half: int, k: int, kind: str):
    """Task function: sorted rows of blocks to each query's nearest classes."""
    def nearest(held):
        t = pa.Table.from_batches(held).combine_chunks()
        ids, ask = t.column("cid").to_numpy(), t.column("asks").to_numpy()
        asking = np.flatnonzero(ask)
        if not len(asking):
            return
        q_out, c_out, d_out = [], [], []
        vectors, z = t.column("raw"), t.num_rows
        x = np.concatenate([_packed(v, slice(0, len(v)), kind) for v in vectors.chunks])
        for i in asking.tolist():
            lo = max(0, min(i - half, z - 2 * half - 1))
            hi = min(z, lo + 2 * half + 1)
            d = np.sqrt(((x[lo:hi].astype(np.float64) - x[i]) ** 2).sum(1))
            d[i - lo] = np.inf
            near = np.lexsort((ids[lo:hi], d))[:k]
            near = near[np.isfinite(d[near])]
            q_out.append(np.full(len(near), ids[i]))
            c_out.append(ids[lo:hi][near])
            d_out.append(d[near])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (q_out, c_out, d_out)], ["q", "c", "d"])

    def run(batches):
        held, now = [], None
        for b in batches:
            if not b.num_rows:
                continue
            block = b.column("block").to_numpy()
            cut = (np.flatnonzero(block[1:] != block[:-1]) + 1).tolist()
            for a, z in zip([0, *cut], [*cut, len(block)]):
                if block[a] != now and held:
                    yield from nearest(held)
                    held = []
                now = block[a]
                held.append(b.slice(a, z - a))
        if held:
            yield from nearest(held)

    return run


def search(table: DataFrame, queries: Column, ident: str = "vec_id", vector: str = "embedding", k: int = K,
           curves: int = CURVES, half: int | None = None, seed: int = SEED) -> DataFrame:
    """The k nearest found of each row that meets ``queries`` (a condition on ``id``).

    Columns query_id, rank (from 1), vec_id and score (Euclidean distance).
    """
    rows = table.select(F.col(f"`{ident}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v"))).distinct()
    classes = staged(_classes(rows, k), "vector-classes")
    asked = staged(rows.where(queries).join(classes.select("v", "cid"), "v").select(
        F.col("id").alias("query_id"), F.col("cid").alias("q")), "vector-queries")
    asking = asked.select(F.col("q").alias("cid")).distinct().withColumn("asks", F.lit(True))
    n = classes.count()
    half = half or half_window(n)
    kind = "<f4" if isinstance(classes.schema["v"].dataType.elementType, T.FloatType) else "<f8"
    index = staged(_indexed(classes.drop("ids"), curves, seed, kind).join(asking, "cid", "left").withColumn(
        "asks", F.coalesce("asks", F.lit(False))), "vector-index")

    spark = table.sparkSession
    # the number of partitions decides on who does the work, not on what is found
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * curves // PARTITION_ROWS))
    cuts, blocks = _cuts(index, dict(classes.groupBy("dim").count().collect()), curves, half, parts)
    parts = max(1, min(parts, blocks))
    places = index.mapInArrow(_dealt(cuts), "block int, key binary, cid long, asks boolean, raw binary")
    places = places.repartitionById(parts, F.floor(F.col("block") * F.lit(parts).cast("long") / F.lit(max(1, blocks))).cast("int"))
    places = places.sortWithinPartitions("block", "key").select("block", "cid", "asks", "raw")
    found = places.mapInArrow(_windows(half, k, kind), "q long, c long, d double")
    best = found.groupBy("q", "c").agg(F.min("d").alias("d"))
    best = best.withColumn("rn", F.row_number().over(Window.partitionBy("q").orderBy("d", "c"))).where(F.col("rn") <= k)
    ids = classes.select("cid", "ids")
    near = best.join(ids, best.c == ids.cid).select("q", "d", "ids")
    own = asking.join(ids, "cid").select(F.col("cid").alias("q"), F.lit(0.0).alias("d"), "ids")
    near = staged(near.union(own).select("q", "d", F.explode("ids").alias("vec_id")), "vector-nearest")
    out = asked.join(near, "q").where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.min("d").alias("score"))
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return out.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
