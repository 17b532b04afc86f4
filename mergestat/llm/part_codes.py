"""Vector codes by parts: integer k-means under Drake-Hamerly adaptive bounds.

Components become integers ``floor(scale * x)``, vectors are cut into ``parts``
equal pieces, and every part position has a codebook of ``entries`` integer
entries.  A round assigns each part to its nearest entry (squared distance, ties
to the lower index) and moves each entry to the componentwise floor of its
parts' mean; entries without parts stay.  A last assignment gives the codes.

The first assignment measures every distance and persists, for each part, its b
closest entries in order, a lower bound of the distance to each but the first,
and one outer bound for all entries outside the list.  Afterwards entries have
moved by known lengths, so bounds shrink by them; the distance to the assigned
entry is measured again, and

* a bound above it settles its entry and all behind it without measuring;
* entries whose bounds do not settle them are measured in integers;
* where the outer bound does not hold either, all entries are measured anew.

Bounds only decide what is measured: every comparison that a bound leaves open is
made between integers, so codes equal those of plain k-means.  Bounds are kept
as half-precision floats, lower ones rounded down, which can only lead to
further measuring.  The number b starts at ``FIRST`` of the entries and is adapted
in every assignment, for each part position and block of ``STEP_ROWS`` vectors, to
what ``ENOUGH`` of the block's parts needed; each row says how many it keeps.

Scale: one pass over the vectors a round, written to the shared folder with its
bounds (about 3 b bytes a part); sums and counts of entries are added within each
task and then over tasks, and only ``parts * entries`` rows of them reach the
driver.

Defined cases: rows whose vector is null or holds a null or non-finite component
are dropped; a vector of another length than that of the first id (or of no
length) keeps its row, with null code and error, and takes part in no codebook.
The first entries are the vectors of the smallest ids, equal ids by components,
null ids last; with fewer vectors the codebook has fewer entries.  Repeated rows
count each.  Integers are held within +-2^((62 - log2 of the length) / 2 - 1),
2^27 at length 64, so that no sum of squares leaves 64 bits.  An empty table gives
no rows.  All input columns but the vector are kept; those named ``code`` or
``error`` are replaced.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, staged

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: b at first, as a share of the entries, and what it is adapted to: the least, the most, and the share of parts it serves.
FIRST, LEAST, MOST, ENOUGH = 1 / 8, 3, 1 / 4, 0.95
#: Rows worked on at once; guard of comparisons against rounding of doubles.
STEP_ROWS, GUARD = 2048, 1e-9
#: Largest total length of distinct labels that is broadcast.
LABEL_BYTES = 4 << 20


@dataclass
class Codebooks:
    """Entries [part, entry, component], and how far each came in the last round."""

    entries: np.ndarray
    moved: np.ndarray | None = None

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _down(x: np.ndarray) -> np.ndarray:
    """Half-precision floats at or below ``x``, from 0 up."""
    x = np.clip(x, 0.0, 65504.0)
    half = x.astype(np.float16)
    return np.where(half.astype(np.float64) > x, np.nextafter(half, np.float16(-np.inf)), half)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def measure_all(x: np.ndarray, book: np.ndarray, b: int):
    """Closest entry, its squared distance, the b closest entries, lower bounds and outer bound."""
    k = len(book)
    d = _squared(x[:, None, :], book[None, :, :])
    first = d.argmin(1)                                        # the lower index of equals
    rows = np.arange(len(x))
    least = d[rows, first]
    d[rows, first] = -1
    near = np.argpartition(d, min(b, k - 1), axis=1)[:, :b + 1] if b < k else np.tile(np.arange(k), (len(x), 1))
    dist = np.take_along_axis(d, near, 1)
    order = np.argsort(dist, axis=1, kind="stable")
    near, dist = np.take_along_axis(near, order, 1), np.sqrt(np.take_along_axis(dist, order, 1)[:, 1:].astype(np.float64))
    outer = dist[:, b - 1] if b < k else np.full(len(x), np.inf)
    return first, least, near[:, :b], dist[:, :b - 1] * (1 - GUARD), outer * (1 - GUARD)


def _adapted(need: np.ndarray, k: int) -> int:
    """How many entries to keep, from how many each part needed."""
    served = int(np.quantile(need, ENOUGH, method="higher")) if len(need) else 0
    return min(k, max(LEAST, min(served, round(k * MOST))))


def measure_some(x: np.ndarray, book: np.ndarray, moved: np.ndarray, near: np.ndarray, low: np.ndarray, outer: np.ndarray):
    """The same after entries moved, from the lists and bounds of the round before.

    The lists that come out have the adapted length; the sixth result is how many
    entries each part needed.
    """
    n, b = near.shape
    rows = np.arange(n)
    low = np.column_stack([low - moved[near[:, 1:]], outer - moved.max()])
    low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]           # in order, the outer bound last
    dist = np.full((n, b), -1, np.int64)
    dist[:, 0] = _squared(x, book[near[:, 0]])
    reach = np.sqrt(dist[:, 0].astype(np.float64)) * (1 + GUARD) + GUARD
    open_ = (low <= reach[:, None]).sum(1)                     # entries that the bounds leave open; b: the outer one too
    for j in range(1, b):
        at = np.flatnonzero(open_ >= j)
        dist[at, j] = _squared(x[at], book[near[at, j]])
    seen = dist >= 0
    # measured entries by distance, then index; what is not measured stays behind them
    by_index = np.argsort(np.where(seen, near, np.arange(b) + len(book)), axis=1, kind="stable")
    rank = np.take_along_axis(np.where(seen, dist, np.iinfo(np.int64).max), by_index, 1)
    order = np.take_along_axis(by_index, np.argsort(rank, axis=1, kind="stable"), 1)
    bound = np.where(seen, np.sqrt(np.maximum(dist, 0).astype(np.float64)) * (1 - GUARD), np.column_stack([np.zeros(n), low[:, :b - 1]]))
    near, dist, bound = (np.take_along_axis(v, order, 1) for v in (near, dist, bound))
    first, least, outer = near[:, 0].copy(), dist[:, 0].copy(), low[:, -1].copy()
    anew = np.flatnonzero(open_ >= b) if b < len(book) else rows[:0]
    need = np.minimum(open_ + 1, b)
    need[anew] = b + 1
    b_next = _adapted(need, len(book))
    if b_next < b:                                             # what leaves the list falls under the outer bound
        outer = np.minimum(outer, bound[:, b_next:].min(1))
        near, bound = near[:, :b_next].copy(), bound[:, :b_next].copy()
    elif b_next > b:                                           # a longer list is filled up where all are measured
        near = np.column_stack([near, np.repeat(near[:, :1], b_next - b, 1)])
        bound = np.column_stack([bound, np.repeat(outer[:, None], b_next - b, 1)])
    low = bound[:, 1:]
    if len(anew):
        first[anew], least[anew], near[anew], low[anew], outer[anew] = measure_all(x[anew], book, b_next)
    return first, least, near, low, outer, need


def _joined(column: pa.Array, dtype: str, rows: int) -> np.ndarray:
    """Equally long binary values, nulls left out, as a table."""
    flat = np.frombuffer(b"".join(v for v in column.to_pylist() if v is not None), dtype)
    return flat.reshape(rows, len(flat) // max(rows, 1))


def _steps(batch: pa.RecordBatch, q: int, length: int, kept: int | None = None):
    """Blocks of a batch: rows, which have the right length, and their integer vectors.

    Rows of a block keep equally many entries, as told by column ``kept``.
    """
    cuts = np.arange(0, batch.num_rows, STEP_ROWS)
    if kept is not None:
        told = batch.column(kept).fill_null(b"").to_numpy(zero_copy_only=False)
        cuts = np.union1d(cuts, np.flatnonzero(told[1:] != told[:-1]) + 1)
    for start, stop in zip(cuts.tolist(), [*cuts[1:].tolist(), batch.num_rows]):
        part = batch.slice(start, stop - start)
        column = part.column(q)
        fits = np.asarray(column.value_lengths().fill_null(0)) == length
        yield part, fits, np.asarray(column.filter(pa.array(fits)).flatten()).astype(np.int64).reshape(-1, length)


def _spread(rows: list, fits: np.ndarray) -> list:
    """``rows`` where ``fits``, None elsewhere."""
    it = iter(rows)
    return [next(it) if ok else None for ok in fits.tolist()]


def _assign(df: DataFrame, books: Codebooks, keep: list[str], q: str, listed: list[str], last: bool) -> DataFrame:
    """One assignment: kept columns, ``code`` and ``error``, and unless it is the ``last`` the lists.

    ``listed`` names the list columns (kept, near, bound); where ``df`` has them they are used.
    """
    entries, moved = books.entries, books.moved
    parts, k, width = entries.shape
    index = "<u1" if k <= 256 else "<u2"
    names = df.columns
    q_at, keep_at = names.index(q), [names.index(c) for c in keep]
    list_at = [names.index(c) for c in listed] if listed[0] in names else None
    added = ["code", *([] if last else listed)]
    schema = T.StructType([df.schema.fields[i] for i in keep_at] + [T.StructField("error", T.LongType())]
                          + [T.StructField(c, T.BinaryType()) for c in added])
    b_first = min(k, max(2, round(k * FIRST)))

    def block(part, fits, x):
        n, at = len(x), 0
        x = x.reshape(n, parts, width)
        code, error = np.empty((n, parts), index), np.zeros(n, np.int64)
        nears, bounds, kept = [], [], []
        if list_at and n:
            b_now = next(v for v in part.column(list_at[0]).to_pylist() if v is not None)
            ids, lows = _joined(part.column(list_at[1]), index, n), _joined(part.column(list_at[2]), "<f2", n)
        for p in range(parts):
            if list_at and n:
                b = b_now[p]
                got = measure_some(x[:, p], entries[p], moved[p], ids[:, at:at + b].astype(np.int64),
                                   lows[:, at:at + b - 1].astype(np.float64), lows[:, at + b - 1].astype(np.float64))
                at += b
            else:
                got = measure_all(x[:, p], entries[p], b_first)
            code[:, p] = got[0]
            error += got[1]
            kept.append(got[2].shape[1])
            nears.append(got[2].astype(index))
            bounds.append(_down(np.column_stack([got[3], got[4]])))
        cols = [[r.tobytes() for r in code]]
        if not last:
            cols += [[bytes(kept)] * n, [r.tobytes() for r in np.concatenate(nears, 1)], [r.tobytes() for r in np.concatenate(bounds, 1)]]
        return pa.RecordBatch.from_arrays(
            [part.column(i) for i in keep_at] + [pa.array(_spread(error.tolist(), fits), pa.int64())]
            + [pa.array(_spread(c, fits), pa.binary()) for c in cols], schema.names)

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                for part, fits, x in _steps(batch, q_at, parts * width, list_at and list_at[0]):
                    yield block(part, fits, x)

    return df.mapInArrow(work, schema)


def _moved(df: DataFrame, books: Codebooks, q: str) -> Codebooks:
    """Entries at the means of the parts that ``df`` assigns to them, and how far they came."""
    parts, k, width = books.entries.shape
    index = "<u1" if k <= 256 else "<u2"
    sums = [f"s{i}" for i in range(width)]
    schema = "part int, entry int, n long, " + ", ".join(f"{s} long" for s in sums)

    def work(batches):
        total, n = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            for part, _, x in _steps(batch, 0, parts * width):
                codes = _joined(part.column(1), index, len(x)).reshape(len(x), parts)
                for p in range(parts):
                    n[p] += np.bincount(codes[:, p], minlength=k)
                    np.add.at(total[p], codes[:, p], x.reshape(len(x), parts, width)[:, p])
        a, e = np.nonzero(n)
        if len(a):
            cols = [a.astype(np.int32), e.astype(np.int32), n[a, e], *(total[a, e, i] for i in range(width))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["part", "entry", "n", *sums])

    tallies = df.select(q, "code").mapInArrow(work, schema).groupBy("part", "entry").agg(F.sum("n"), *[F.sum(s) for s in sums])
    entries = books.entries.copy()
    for part, entry, n, *total in tallies.collect():
        entries[part, entry] = [t // n for t in total]
    return Codebooks(entries, np.sqrt(_squared(entries, books.entries).astype(np.float64)) * (1 + GUARD))


def encode(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", parts: int = PARTS,
           entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE) -> tuple[DataFrame, Codebooks]:
    """Rows of kept vectors with ``code`` (binary, an index a part) and ``error``, and the codebooks."""
    q, *listed = fresh(vectors, "q", "kept", "near", "bound")
    keep = [c for c in vectors.columns if c.lower() not in (vector.lower(), "code", "error")]
    v, i = F.col(f"`{vector}`"), F.col(f"`{ident}`")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = vectors.where(v.isNotNull() & ~F.coalesce(odd, F.lit(True)))
    first = valid.select(F.size(v)).orderBy(i.asc_nulls_last(), v).limit(1).collect()
    length = first[0][0] if first else 0
    if length % parts:
        raise ValueError(f"vectors of {length} components have no {parts} equal parts")
    most = 1 << ((62 - max(1, length - 1).bit_length()) // 2 - 1)
    whole = F.transform(v, lambda x: F.greatest(F.lit(-most), F.least(F.lit(most), F.floor(x.cast("double") * scale))).cast("int"))
    kept = valid.select(*[F.col(f"`{c}`") for c in keep], whole.alias(q))
    if not length:
        return kept.drop(q).withColumns({"code": F.lit(None).cast("binary"), "error": F.lit(None).cast("long")}), \
            Codebooks(np.zeros((parts, 0, 0), np.int64))
    start = kept.where(F.size(q) == length).select(q).orderBy(i.asc_nulls_last(), q).limit(entries).collect()
    book = np.array([r[0] for r in start], np.int64).reshape(len(start), parts, length // parts).transpose(1, 0, 2).copy()
    books, state = Codebooks(book), kept
    for turn in range(rounds):
        state = staged(_assign(state, books, [*keep, q], q, listed, last=False), f"part-codes-{turn}")
        books = _moved(state, books, q)
    return _assign(state, books, keep, q, listed, last=True), books


def label_totals(coded: DataFrame, label: str = "label", error: str = "error", out: str = "label_error") -> DataFrame:
    """``coded`` with the errors summed over equal labels, nulls together; null beyond 64 bits.

    Sums are partial before their shuffle.  Labels are broadcast while all of them
    together are short; else those of a 32nd of all rows or more (32 at most) are, and
    the others are joined by shuffle.
    """
    key, total, rows = fresh(coded, "label", "total", "rows")
    coded = staged(coded, "part-codes")
    sums = staged(coded.groupBy(F.col(f"`{label}`").alias(key)).agg(
        F.try_sum(F.col(f"`{error}`")).alias(total), F.count(F.lit(1)).alias(rows)), "label-errors")
    size, n = sums.agg(F.sum(F.octet_length(F.col(key).cast("string")) + 32), F.sum(rows)).first()

    def joined(part, of):
        names = [F.col(f"`{c}`") for c in coded.columns if c.lower() != out.lower()]
        return part.join(of, F.col(f"`{label}`").eqNullSafe(F.col(key)), "inner").select(*names, F.col(total).alias(out))

    if (size or 0) <= LABEL_BYTES:
        return joined(coded, F.broadcast(sums))
    hot = sums.where(F.col(rows) * 32 >= n)
    cold = coded.join(F.broadcast(hot.select(key)), F.col(f"`{label}`").eqNullSafe(F.col(key)), "left_anti")
    return joined(coded, F.broadcast(hot)).unionByName(joined(cold, sums))
