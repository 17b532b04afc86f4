"""Fixed-bin histogram building blocks.

Bins are half-open ``[e_i, e_{i+1})``.  A value's *slot* is 0 for underflow
(v < e_0), i for bin i (1..B) and B+1 for overflow (v >= e_B).  NULL and NaN
values have no slot and are left out of every count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def equal_width_edges(lo: float, hi: float, nbins: int) -> list[float]:
    """B1: B+1 edges from lo to hi (parameters, never derived from state)."""
    if not hi > lo or nbins < 1:
        raise ValueError("need hi > lo and nbins >= 1")
    w = (hi - lo) / nbins
    return [lo + i * w for i in range(nbins)] + [hi]


def equal_width_slot(v: Column, lo: float, hi: float, nbins: int) -> Column:
    """Slot of ``v`` for B equal bins over [lo, hi).

    Written with one division by the bin width so that any engine evaluating
    the same expression lands every value in the same bin.
    """
    w = (hi - lo) / nbins
    inner = F.least(F.floor((v - F.lit(lo)) / F.lit(w)).cast("int") + 1, F.lit(nbins))
    return (F.when(v.isNull() | F.isnan(v), F.lit(None).cast("int"))
            .when(v < F.lit(lo), F.lit(0))
            .when(v >= F.lit(hi), F.lit(nbins + 1))
            .otherwise(inner))


def edges_slot(v: Column, edges: Sequence[float]) -> Column:
    """Slot of ``v`` for arbitrary increasing edges: the count of edges <= v."""
    edges = [float(e) for e in edges]
    if any(b <= a for a, b in zip(edges, edges[1:])):
        raise ValueError("edges must be strictly increasing")
    expr = F.lit(0)
    for e in edges:
        expr = expr + F.when(v >= F.lit(e), 1).otherwise(0)
    return F.when(v.isNull() | F.isnan(v), F.lit(None).cast("int")).otherwise(expr)


def cumulative(arr: Column) -> Column:
    """Running totals of a numeric array, left to right, in one fold."""
    empty = F.array().cast("array<bigint>")
    fold = F.aggregate(arr, F.struct(empty.alias("out"), F.lit(0).cast("bigint").alias("sum")), lambda s, y: F.struct(
        F.concat(s["out"], F.array(s["sum"] + y)).alias("out"), (s["sum"] + y).alias("sum")))
    return fold["out"]


def median_slot(counts: Column) -> Column:
    """Slot (0-based into ``counts``) holding rank n div 2 in the running totals.

    ``counts`` holds underflow, B bins, overflow.  The rank is the integer
    ``n div 2`` and the slot is the first whose running total exceeds it —
    the upper median for even n.
    """
    n = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, y: a + y)
    rank = F.floor(n / 2).cast("bigint")
    cum = cumulative(counts)
    pos = F.array_position(F.transform(cum, lambda c: c > rank), True)
    return F.when(n > 0, (pos - 1).cast("int"))


def median_from_counts(counts: Column, edges: Sequence[float]) -> Column:
    """Midpoint of the bin holding the median rank; NULL when that rank
    falls in underflow/overflow or there are no values."""
    edges = [float(e) for e in edges]
    nb = len(edges) - 1
    mids = F.array(*[F.lit((edges[i] + edges[i + 1]) / 2) for i in range(nb)])
    slot = median_slot(counts)
    return F.when((slot >= 1) & (slot <= nb), F.element_at(mids, slot))
