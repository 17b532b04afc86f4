"""Sums and moments per key (A1-A10).

All of these are one hash aggregation keyed by the key columns: Spark runs a
partial aggregate in every map task (so a hot key never ships its raw rows),
shuffles one buffer per key per task, and merges.  The same calls work on a
streaming DataFrame, where the buffers become the checkpointed state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergestat.functions.moments import (HIGHER, centred, higher_of, higher_state, merge_higher, merge_moments, moment_state,
                                         power_sums, shape_of, variance_of)
from mergestat.sources.tables import key_names


def _v(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def batch_sum(df: DataFrame, keys: str | Sequence[str], value: str | Column,
              batch: str | Column) -> DataFrame:
    """A1: sum per key within each batch (map-side combined)."""
    b = F.col(batch) if isinstance(batch, str) else batch
    return (df.groupBy(b.alias("batch"), *key_names(keys))
              .agg(F.count(_v(value)).alias("n"), F.sum(_v(value)).alias("sum")))


def running_sum(df: DataFrame, keys, value) -> DataFrame:
    """A2: total per key."""
    return df.groupBy(*key_names(keys)).agg(F.sum(_v(value)).alias("sum"))


def running_count(df: DataFrame, keys, value) -> DataFrame:
    """A3: non-null values per key."""
    return df.groupBy(*key_names(keys)).agg(F.count(_v(value)).alias("n"))


def running_mean(df: DataFrame, keys, value) -> DataFrame:
    """A4: count and mean per key."""
    v = _v(value)
    return df.groupBy(*key_names(keys)).agg(F.count(v).alias("n"), F.avg(v).alias("mean"))


def running_variance(df: DataFrame, keys, value) -> DataFrame:
    """Count, mean, population variance and standard deviation.

    ``var_pop`` keeps (n, mean, m2) buffers merged with Chan's rule, i.e. the
    numerically stable Welford/Chan algorithm; NULL for a key with no values.
    """
    v = _v(value)
    return df.groupBy(*key_names(keys)).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"),
        F.var_pop(v).alias("variance"), F.stddev_pop(v).alias("stddev"))


def running_variances(df: DataFrame, keys, value) -> DataFrame:
    """A5 next to A8: ``running_variance`` with ``variance_sum_squares``."""
    v = _v(value)
    return df.groupBy(*key_names(keys)).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_pop(v).alias("variance"),
        F.stddev_pop(v).alias("stddev"), (F.avg(v * v) - F.avg(v) * F.avg(v)).alias("variance_sum_squares"))


def running_stddev(df: DataFrame, keys, value) -> DataFrame:
    """Population standard deviation per key."""
    return df.groupBy(*key_names(keys)).agg(F.stddev_pop(_v(value)).alias("stddev"))


def variance_sum_squares(df: DataFrame, keys, value) -> DataFrame:
    """A5: mean of squares minus squared mean, next to the stable variance.

    Kept as a comparison column only: it cancels catastrophically when the
    mean is large relative to the spread.
    """
    v = _v(value)
    return df.groupBy(*key_names(keys)).agg(
        F.count(v).alias("n"),
        (F.avg(v * v) - F.avg(v) * F.avg(v)).alias("variance_sum_squares"),
        F.var_pop(v).alias("variance"))


def higher_moments(df: DataFrame, keys, value) -> DataFrame:
    """A10: population skewness and excess kurtosis per key."""
    v = _v(value)
    return df.groupBy(*key_names(keys)).agg(
        F.count(v).alias("n"), F.skewness(v).alias("skewness"),
        F.kurtosis(v).alias("kurtosis"))


def moment_partials(df: DataFrame, keys, value, batch) -> DataFrame:
    """Per (key, batch) mergeable moments: n, mean, m2 (population)."""
    v = _v(value)
    b = F.col(batch) if isinstance(batch, str) else batch
    return (df.groupBy(*key_names(keys), b.alias("batch"))
              .agg(F.count(v).alias("n"), F.avg(v).alias("mean"),
                   (F.var_pop(v) * F.count(v)).alias("m2"))
              .where(F.col("n") > 0))


def variance_from_partials(partials: DataFrame, keys) -> DataFrame:
    """Merge per-batch (n, mean, m2) partials into one variance per key.

    The k-way form of Chan's rule: with the pooled mean M,
    m2 = sum(m2_i) + sum(n_i * (mean_i - M)^2).  The pooled mean is a window
    over the key, and the final aggregation reuses that partitioning: one
    shuffle of the partial table (one row per key and batch), so the cost
    grows with the number of batches, never with the rows inside them.
    """
    ks = key_names(keys)
    w = Window.partitionBy(*ks)
    pooled = partials.withColumn("_n", F.sum("n").over(w)) \
                     .withColumn("_m", F.sum(F.col("n") * F.col("mean")).over(w) / F.col("_n"))
    d = F.col("mean") - F.col("_m")
    return (pooled.groupBy(*ks)
                  .agg(F.first("_n").alias("n"), F.first("_m").alias("mean"),
                       ((F.sum("m2") + F.sum(F.col("n") * d * d)) / F.first("_n")).alias("variance")))


def pairwise_merge(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """A7 on two tables of (key..., n, mean, variance): one merged row per key.

    The tables are put one below the other and merged in one aggregation, so a
    NULL key meets its own and a key of one side only needs no other rule.
    """
    ks = key_names(keys)
    state = moment_state(F.col("n"), F.col("mean"), F.col("variance") * F.col("n"))
    both = left.select(*ks, state.alias("s")).union(right.select(*ks, state.alias("s")))
    none = moment_state(F.lit(0), F.lit(None), F.lit(None))
    # at most one state of either side
    merged = both.groupBy(*ks).agg(F.reduce(F.collect_list("s"), none, merge_moments).alias("s"))
    return merged.select(*ks, "s.n", "s.mean", variance_of(F.col("s")).alias("variance"))


def higher_partials(df: DataFrame, keys, value, batch) -> DataFrame:
    """Per (key, batch) mergeable states up to the fourth moment: n, mean, m2, m3, m4."""
    b = F.col(batch) if isinstance(batch, str) else batch
    ks = key_names(keys)
    return df.groupBy(*ks, b.alias("batch")).agg(higher_of(_v(value)).alias("_s")).select(*ks, "batch", "_s.*")


def shapes(states: DataFrame, keys) -> DataFrame:
    """(key..., n, mean, variance, skewness, kurtosis) of states (key..., n, mean, m2, m3, m4)."""
    variance, skewness, kurtosis = shape_of(F.col("n"), F.col("m2"), F.col("m3"), F.col("m4"))
    return states.select(*key_names(keys), "n", "mean", variance.alias("variance"), skewness.alias("skewness"),
                         kurtosis.alias("kurtosis"))


def higher_from_partials(partials: DataFrame, keys) -> DataFrame:
    """A7 for A10: one state (key..., n, mean, m2, m3, m4) per key of its partials.

    The k-way form: every partial's powers are taken about the key's pooled mean,
    where they add up.  That mean is a window over the key's partials and the
    aggregation reuses its partitioning: one shuffle of one row per key and batch.
    """
    ks = key_names(keys)
    w = Window.partitionBy(*ks)
    pooled = partials.where("n > 0").withColumn("_m", F.sum(F.col("n") * F.col("mean")).over(w) / F.sum("n").over(w))
    sums = power_sums(*[F.col(c) for c in HIGHER], F.col("_m"))
    merged = pooled.groupBy(*ks).agg(F.sum("n").alias("n"), F.first("_m").alias("_m"),
                                     *[F.sum(s).alias(f"_s{p}") for p, s in enumerate(sums, 1)])
    s = [F.col(f"_s{p}") for p in range(1, 5)]
    m2, m3, m4 = centred(F.col("n"), *s)
    return merged.select(*ks, "n", (F.col("_m") + s[0] / F.col("n")).alias("mean"), m2.alias("m2"), m3.alias("m3"), m4.alias("m4"))


def pairwise_merge_higher(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """A7 for A10 on two tables of states (key..., n, mean, m2, m3, m4): one merged state per key."""
    ks = key_names(keys)
    state = higher_state(*[F.col(c) for c in HIGHER])
    both = left.select(*ks, state.alias("s")).union(right.select(*ks, state.alias("s")))
    none = higher_state(F.lit(0), *[F.lit(None)] * 4)
    # at most one state of either side
    return both.groupBy(*ks).agg(F.reduce(F.collect_list("s"), none, merge_higher).alias("s")).select(*ks, "s.*")
