"""Statistics per key that come out the same, bit for bit, however rows are dealt.

**Sums (A1, A2).**  Adding doubles rounds at every step, so a plain ``sum``
depends on the order in which partial buffers meet.  Here each value is taken
apart into exponent and integer mantissa; per key and exponent the mantissa's
three 18-bit lanes are added as BIGINT, which is exact (for up to 2^45 rows of
one key and exponent) and the same in any order.  The state is that table of
lane sums, at most some 2,000 rows a key and a handful in practice: it merges by
addition, runs as a native aggregation on a stream, and a hot key is spread over
its exponents.  Only ``exact_totals`` rounds, once, to the nearest double.

**Selection (B7).**  The value of a given rank of every key, found by digits: a
pass counts the rows per key and digit that share the digits chosen so far, a
window over those counts (at most 65,536 a key) picks the next digit, and the
rows outside it fall away.  Four digits hold a whole double; the passes end as
soon as every key's slot holds one distinct value.  Rows are only counted, so
no key's values meet in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergestat.functions.float_parts import LANE, LOWEST, exponent, lanes, mantissa, ordered_digits
from mergestat.functions.binning import median_from_counts
from mergestat.operators.histogram import Bins
from mergestat.session import scratch_path
from mergestat.sources.tables import key_names

#: Keys up to which the chosen digits are broadcast, and the bytes that they may take together.
BROADCAST_KEYS, BROADCAST_BYTES = 100_000, 16 << 20
LANES = ("lane0", "lane1", "lane2")
ODD = ("nans", "infinities", "negative_infinities")


def _v(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


# ---------------------------------------------------------------- sums

def sum_states(df: DataFrame, keys, value) -> DataFrame:
    """Mergeable state of an exact sum: (key..., exponent, lane sums, counts).

    Values without an exponent (NULL, zero, NaN, infinities) share the row of
    exponent NULL.  Works on streams; states of parts merge by ``merge_sums``.
    """
    v = _v(value)
    e = exponent(v)
    parts = df.select(*key_names(keys), v.alias("_v"), e.alias("exponent")) \
        .select(*key_names(keys), "exponent", "_v", mantissa(F.col("_v"), F.col("exponent")).alias("_m"))
    ls = lanes(F.col("_m"))
    x = F.col("_v")
    return parts.groupBy(*key_names(keys), "exponent").agg(
        F.count("_v").alias("n"), *[F.sum(c).alias(n) for c, n in zip(ls, LANES)],
        F.count_if(F.isnan(x)).alias(ODD[0]), F.count_if(x == float("inf")).alias(ODD[1]),
        F.count_if(x == float("-inf")).alias(ODD[2]))


def merge_sums(states: DataFrame, keys) -> DataFrame:
    """One state per key and exponent of any number of them."""
    return states.groupBy(*key_names(keys), "exponent").agg(*[F.sum(c).alias(c) for c in ("n", *LANES, *ODD)])


@F.pandas_udf(T.StructType([T.StructField("sum", T.DoubleType()), T.StructField("mean", T.DoubleType())]))
def _rounded(n: pd.Series, lanes_of: pd.Series) -> pd.DataFrame:
    unit = 1 << -LOWEST

    def total(count, states):
        if not count:
            return None, None
        exact = sum((s["lane0"] + (s["lane1"] << LANE) + (s["lane2"] << 2 * LANE)) << (s["exponent"] - LOWEST) for s in states)

        def nearest(whole, parts):                 # a quotient of ints is rounded once
            try:
                return whole / parts
            except OverflowError:
                return float("inf") if whole > 0 else float("-inf")
        return nearest(exact, unit), nearest(exact, unit * count)
    return pd.DataFrame([total(*r) for r in zip(n, lanes_of)], columns=["sum", "mean"], dtype=object)


def exact_totals(states: DataFrame, keys) -> DataFrame:
    """(key..., n, sum, mean) of sum states, each rounded once; NULL without values."""
    ks = key_names(keys)
    state = F.struct(F.col("exponent").cast("bigint").alias("exponent"), *LANES)
    per_key = states.groupBy(*ks).agg(
        F.sum("n").alias("n"), F.collect_list(F.when(F.col("exponent").isNotNull(), state)).alias("_s"),
        *[F.sum(c).alias(c) for c in ODD])
    nan, up, down = (F.col(c) > 0 for c in ODD)
    odd = F.when(nan | up & down, F.lit(float("nan"))).when(up, F.lit(float("inf"))).when(down, F.lit(float("-inf")))
    return per_key.select(*ks, "n", odd.alias("_o"), _rounded("n", "_s").alias("_r")).select(
        *ks, "n", F.coalesce("_o", "_r.sum").alias("sum"), F.coalesce("_o", "_r.mean").alias("mean"))


def exact_sum(df: DataFrame, keys, value) -> DataFrame:
    """A2: count, sum and mean of every key, independent of order and partitions."""
    return exact_totals(sum_states(df, keys, value), keys)


def exact_batch_sum(df: DataFrame, keys, value, batch: str | Column) -> DataFrame:
    """A1: count and sum of every key within each batch, independent of order."""
    b = F.col(batch) if isinstance(batch, str) else batch
    ks = key_names(keys)
    return exact_sum(df.withColumn("batch", b), ["batch", *ks], value).drop("mean")


# ---------------------------------------------------------------- selection

def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _small(chosen: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the chosen digits of all keys may be broadcast: few and short, by count."""
    length = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(64))
    n, size = chosen.agg(F.count(F.lit(1)), F.sum(length)).first()
    return n <= BROADCAST_KEYS and (size or 0) <= BROADCAST_BYTES


def select_rank(df: DataFrame, keys, value, rank) -> DataFrame:
    """(key..., n, value at a rank): ``rank(n)`` counts from 0 in ascending order.

    Values are doubles; NULL and NaN take no part, -0.0 equals 0.0.  A key
    without values, or whose rank lies outside 0 to n - 1, gets NULL.
    """
    ks = key_names(keys)
    v = _v(value)
    usable = v.isNotNull() & ~F.isnan(v)
    rows = df.select(*ks, F.when(usable, v + F.lit(0.0)).alias("_v"))
    mark = [f"_k{i}" for i in range(len(ks))]
    chosen, found, left = None, None, rows
    for step in range(4):
        digit = ordered_digits(F.col("_v"))[step]
        if chosen is not None:
            of = chosen.where("not _done").select(*[F.col(k).alias(m) for k, m in zip(ks, mark)], F.col("_d").alias("_was"))
            of = F.broadcast(of) if _small(chosen, ks) else of
            same = ordered_digits(F.col("_v"))[step - 1] == F.col("_was")
            for k, m in zip(ks, mark):
                same &= F.col(k).eqNullSafe(F.col(m))
            left = left.join(of, same, "left_semi")
            if step == 1:                          # what is left is small beside the table; later passes read it alone
                left = _staged(left, "rank-rows")
        counts = left.groupBy(*ks, digit.alias("_d")).agg(
            F.count("_v").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        w = Window.partitionBy(*ks).orderBy("_d")
        before = F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1))
        counts = counts.withColumn("_before", F.coalesce(before, F.lit(0)))
        if chosen is None:
            counts = counts.withColumn("_n", F.sum("_c").over(Window.partitionBy(*ks)))
            counts = counts.withColumn("_rank", rank(F.col("_n")).cast("bigint"))
        else:
            known = chosen.select(*[F.col(k).alias(m) for k, m in zip(ks, mark)], F.col("_left").alias("_rank"), "_n")
            same = F.lit(True)
            for k, m in zip(ks, mark):
                same &= F.col(k).eqNullSafe(F.col(m))
            counts = counts.join(known, same).drop(*mark)
        inside = (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_c"))
        # a key without that rank keeps one row: its digit of NULL, or its first
        pick = F.max_by(F.struct("_d", "_lo", (F.col("_lo") == F.col("_hi")).alias("_one"),
                                 (F.col("_rank") - F.col("_before")).alias("_left"), inside.alias("_in")), inside)
        now = counts.groupBy(*ks).agg(F.max("_n").alias("_n"), pick.alias("_p"))
        now = now.select(*ks, "_n", "_p._d", "_p._left", F.when(F.col("_p._in"), F.col("_p._lo")).alias("_value"),
                         (~F.col("_p._in") | F.col("_p._one")).alias("_done"))
        chosen = _staged(now, f"rank-digit-{step}")
        done = chosen.where("_done").select(*ks, F.col("_n").alias("n"), F.col("_value").alias("value"))
        found = done if found is None else found.unionByName(done)
        if chosen.where("not _done").limit(1).count() == 0:
            break
        chosen = chosen.where("not _done")
    return found


def exact_median(df: DataFrame, keys, value) -> DataFrame:
    """(key..., n, median): the value of rank ``n div 2``, the upper median."""
    return select_rank(df, keys, value, lambda n: F.floor(n / 2)).withColumnRenamed("value", "median")


def mean_and_medians(df: DataFrame, keys, value, bins: Bins) -> DataFrame:
    """Mean, exact median and histogram estimate of every key, side by side."""
    ks = key_names(keys)
    v = _v(value)
    s = F.col("_s")
    clean = df.select(*ks, F.when(~F.isnan(v), v).alias("_v"), bins.slot(v).alias("_s"))
    one = clean.groupBy(*ks).agg(F.avg("_v").alias("mean"), F.array(
        *[F.count_if(s == i).cast("bigint") for i in range(bins.nslots)]).alias("_c"))
    one = one.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(ks)], "mean",
                     median_from_counts(F.col("_c"), bins.edges).alias("median_estimate"))
    same = F.lit(True)
    for i, k in enumerate(ks):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return exact_median(df, keys, value).join(one, same).select(*ks, "n", "mean", "median", "median_estimate")
