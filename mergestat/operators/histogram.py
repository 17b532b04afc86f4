"""Fixed-bin histograms, running mean and the histogram median.

Counts live in one hash aggregation keyed by (key, slot) — partial in every
map task, so a hot key ships at most B+2 buffers per task.  The array form
(one row per key, ``counts`` = underflow, B bins, overflow) is a second
aggregation over at most B+2 rows per key.  Median and cumulative counts are
projections of that array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergestat.functions.binning import (cumulative, edges_slot, equal_width_edges,
                                         equal_width_slot, median_from_counts)
from mergestat.sources.tables import key_names


class Bins:
    """Bin layout: equal-width over [lo, hi) or explicit increasing edges."""

    def __init__(self, lo: float | None = None, hi: float | None = None,
                 nbins: int | None = None, edges: Sequence[float] | None = None):
        if edges is not None:
            self.edges = [float(e) for e in edges]
            self.equal = None
        else:
            self.edges = equal_width_edges(lo, hi, nbins)
            self.equal = (float(lo), float(hi), int(nbins))
        self.nbins = len(self.edges) - 1

    def slot(self, v: Column) -> Column:
        if self.equal:
            return equal_width_slot(v, *self.equal)
        return edges_slot(v, self.edges)

    @property
    def nslots(self) -> int:
        return self.nbins + 2


def _v(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def histogram_long(df: DataFrame, keys, value, bins: Bins) -> DataFrame:
    """B2+B3: (key..., slot, count) for non-empty slots; slot 0 = underflow,
    B+1 = overflow.  NULL/NaN values are not counted."""
    ks = key_names(keys)
    return (df.select(*ks, bins.slot(_v(value)).alias("slot"))
              .where(F.col("slot").isNotNull())
              .groupBy(*ks, "slot").agg(F.count("*").alias("count"))
              .select(*ks, F.col("slot").cast("bigint").alias("slot"), "count"))


def counts_array(long: DataFrame, keys, bins: Bins) -> DataFrame:
    """Long counts -> one dense ``counts`` array per key (B+2 entries)."""
    ks = key_names(keys)
    return long.groupBy(*ks).agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col("slot") == i, F.col("count"))),
                             F.lit(0).cast("bigint")) for i in range(bins.nslots)]
                ).alias("counts"))


def histogram_array(df: DataFrame, keys, value, bins: Bins) -> DataFrame:
    """B3 in one aggregation per key: counts array with n and mean next to it.

    This is the form streaming uses (one stateful aggregation).
    """
    ks = key_names(keys)
    v = _v(value)
    clean = v.isNotNull() & ~F.isnan(v)
    # Slot once per row, then B+2 conditional counts in the same aggregate.
    pre = df.select(*ks, F.when(clean, v).alias("_v"), bins.slot(v).alias("_s"))
    s = F.col("_s")
    return pre.groupBy(*ks).agg(
        F.count("_v").alias("n"),
        F.avg("_v").alias("mean"),
        F.array(*[F.count_if(s == i).cast("bigint") for i in range(bins.nslots)]).alias("counts"))


def finish_histogram(state: DataFrame, keys, bins: Bins) -> DataFrame:
    """B4+B5 as projections: cumulative counts and median estimate."""
    return state.withColumn("cumulative", cumulative(F.col("counts"))) \
                .withColumn("median_estimate", median_from_counts(F.col("counts"), bins.edges))


def histogram_cumulative(df: DataFrame, keys, value, bins: Bins) -> DataFrame:
    """B4 in long form: (key..., slot, count, cumulative) by a running window
    sum over each key's at most B+2 slot rows."""
    ks = key_names(keys)
    w = Window.partitionBy(*ks).orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    return histogram_long(df, keys, value, bins).withColumn("cumulative", F.sum("count").over(w))


def histogram_median(df: DataFrame, keys, value, bins: Bins) -> DataFrame:
    """Per key, n (values with a slot) and the estimated median.

    Two-level: slot counts (partial-aggregated), then a per-key running sum
    over at most B+2 rows; the median slot is the first whose running total
    exceeds n div 2.  NULL when that slot is under/overflow.
    """
    ks = key_names(keys)
    cum = histogram_cumulative(df, keys, value, bins)
    tot = Window.partitionBy(*ks)
    cum = cum.withColumn("n", F.sum("count").over(tot))
    rank = F.floor(F.col("n") / 2)
    mids = F.array(*[F.lit((bins.edges[i] + bins.edges[i + 1]) / 2) for i in range(bins.nbins)])
    pick = F.min(F.when(F.col("cumulative") > rank, F.col("slot")))
    out = cum.groupBy(*ks).agg(F.first("n").alias("n"), pick.alias("median_slot"))
    ms = F.col("median_slot")
    return out.select(*ks, F.col("n").cast("bigint").alias("n"),
                      F.when((ms >= 1) & (ms <= bins.nbins),
                             F.element_at(mids, ms.cast("int"))).alias("median_estimate"))


def running_histogram_median(df: DataFrame, keys, value, bins: Bins) -> DataFrame:
    """Count, mean, counts array and median estimate per key."""
    return finish_histogram(histogram_array(df, keys, value, bins), keys, bins)


def mean_vs_median(df: DataFrame, keys, value, bins: Bins,
                   approx_accuracy: int | None = None) -> DataFrame:
    """Mean next to the histogram median estimate, from one aggregation
    (count, mean and slot counts together; the median is a projection).

    With ``approx_accuracy`` a ``percentile_approx`` column is added — a
    bounded-memory quantile sketch in the same aggregation.  An exact median
    is deliberately not offered: it holds every value of a key in one buffer.
    """
    ks = key_names(keys)
    v = _v(value)
    clean = v.isNotNull() & ~F.isnan(v)
    pre = df.select(*ks, F.when(clean, v).alias("_v"), bins.slot(v).alias("_s"))
    s = F.col("_s")
    aggs = [F.count("_v").alias("n"), F.avg("_v").alias("mean"),
            F.array(*[F.count_if(s == i).cast("bigint") for i in range(bins.nslots)]).alias("_c")]
    if approx_accuracy:
        aggs.append(F.percentile_approx("_v", 0.5, approx_accuracy).alias("approx_median"))
    out = pre.groupBy(*ks).agg(*aggs)
    return (out.withColumn("median_estimate", median_from_counts(F.col("_c"), bins.edges))
               .drop("_c"))
