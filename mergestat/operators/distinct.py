"""Approximate distinct counts per key: HyperLogLog registers (H1-H6).

Registers are kept in long form — one row per (key, register) holding the
maximum rank — produced by a single ``groupBy(key, register).max(rank)``.
That aggregation is partial in every map task, so even a key with a third
of all rows ships at most m rows per task, and the register "array" of a key
is spread over m groups rather than one.  The estimate is a second, tiny
aggregation over at most m rows per key.

Estimator (Flajolet et al. 2007): raw E = alpha_m * m^2 / sum(2^-M[j]); if
E <= 5m/2 and V registers are empty, use linear counting m*ln(m/V); with a
32-bit hash, if E > 2^32/30, apply the large-range correction
-2^32 * ln(1 - E/2^32).  Real division throughout.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergestat.functions.hashing import alpha, bits, hash_of, rank_of, register_of
from mergestat.session import scratch_path
from mergestat.sources.tables import key_names

TWO32 = float(2 ** 32)
#: The largest double below 2^63.
LARGEST = float(2 ** 63 - 1024)


def _log2(m: int) -> int:
    p = int(round(math.log2(m)))
    if 2 ** p != m or not 4 <= p <= 16:
        raise ValueError("m must be a power of two between 16 and 65536")
    return p


def _coordinates(value: Column, p: int, method: str) -> tuple[Column, Column]:
    h = hash_of(value, method)
    return register_of(h, p), rank_of(h, p, bits(method))


def corrected(raw: Column, empty: Column, m: int, method: str = "md5") -> Column:
    """H4: the estimate from the raw one and the number of empty registers.

    Linear counting in the low range.  A 32-bit hash also needs the correction
    for collisions near 2^32; where all its registers are full to the last bit it
    stays at its largest value.  64 bits need none.
    """
    est = F.when((raw <= 2.5 * m) & (empty > 0), F.lit(float(m)) * F.log(F.lit(float(m)) / empty))
    if bits(method) == 64:
        return est.otherwise(raw)
    full = F.least(raw, F.lit(TWO32 - 1))
    return est.when(raw <= TWO32 / 30, raw).otherwise(-TWO32 * F.log(1 - full / TWO32))


def hll_registers(df: DataFrame, keys, value: str | Column, m: int = 64,
                  method: str = "md5") -> DataFrame:
    """H1+H2: (key..., register, rank) for every non-empty register, plus
    ``n`` rows seen in that register.  Also a streaming aggregation: state is
    held per key and register, whatever m is."""
    v = F.col(value) if isinstance(value, str) else value
    reg, rank = _coordinates(v, _log2(m), method)
    ks = key_names(keys)
    return (df.where(v.isNotNull())
              .select(*ks, reg.alias("register"), rank.alias("rank"))
              .groupBy(*ks, "register")
              .agg(F.max("rank").cast("bigint").alias("rank"), F.count("*").alias("n")))


def _estimated(sums: DataFrame, ks: list[str], m: int, method: str, *more: str) -> DataFrame:
    """H3+H4 from (key..., n, z, empty_registers)."""
    est = sums.withColumn("raw_estimate", F.lit(alpha(m) * m * m) / F.col("z"))
    est = est.withColumn("estimate", corrected(F.col("raw_estimate"), F.col("empty_registers"), m, method))
    return est.select(*ks, *more, "n", "empty_registers", "raw_estimate", "estimate",
                      F.least(F.round("estimate"), F.lit(LARGEST)).cast("bigint").alias("estimate_rounded"))


def _sums(m: int) -> list[Column]:
    return [F.sum("n").alias("n"),
            (F.sum(F.pow(F.lit(2.0), -F.col("rank"))) + (F.lit(m) - F.count("*"))).alias("z"),
            (F.lit(m) - F.count("*")).cast("bigint").alias("empty_registers")]


def hll_estimate(registers: DataFrame, keys, m: int = 64, method: str = "md5") -> DataFrame:
    """H3+H4: raw estimate, empty registers and the corrected estimate."""
    ks = key_names(keys)
    return _estimated(registers.groupBy(*ks).agg(*_sums(m)), ks, m, method)


def hll_distinct(df: DataFrame, keys, value, m: int = 64, method: str = "md5") -> DataFrame:
    """Registers then estimate in one call."""
    return hll_estimate(hll_registers(df, keys, value, m, method), keys, m, method)


def hll_error_report(df: DataFrame, keys, value: str, m: int = 64,
                     method: str = "md5") -> DataFrame:
    """H5: estimate next to the exact distinct count and the relative error
    (against distinct values, not rows seen).

    One scan: the distinct (key, value) pairs with their row counts give the
    exact count, the rows and the registers, so no join is needed (a NULL key is
    a row like any other) and no key's values are ever gathered in one place.
    """
    ks = key_names(keys)
    reg, rank = _coordinates(F.col(value), _log2(m), method)
    pairs = df.where(F.col(value).isNotNull()).groupBy(*ks, value).agg(F.count("*").alias("n"))
    registers = pairs.groupBy(*ks, reg.alias("register")).agg(
        F.max(rank).cast("bigint").alias("rank"), F.sum("n").alias("n"), F.count("*").alias("exact"))
    sums = registers.groupBy(*ks).agg(*_sums(m), F.sum("exact").alias("exact"))
    return _estimated(sums, ks, m, method, "exact").select(
        *ks, "n", "exact", "estimate",
        ((F.col("estimate") - F.col("exact")) / F.col("exact")).alias("rel_error"))


#: Registers up to which a stream may hold them side by side in one row.
WIDE = 64


def hll_registers_wide(df: DataFrame, keys, value: str | Column, m: int = 64,
                       method: str = "md5") -> DataFrame:
    """H2 in one aggregation: per key, the full register array.

    For streams, where a second stateful aggregation cannot follow the first;
    m conditional maxima in one hash aggregate, so m is at most ``WIDE``.
    Beyond it stream ``hll_registers`` and estimate from what the sink holds.
    """
    if m > WIDE:
        raise ValueError(f"more than {WIDE} registers: stream hll_registers instead")
    v = F.col(value) if isinstance(value, str) else value
    reg, rank = _coordinates(v, _log2(m), method)
    ks = key_names(keys)
    base = df.where(v.isNotNull()).select(*ks, reg.alias("_r"), rank.alias("_k"))
    return base.groupBy(*ks).agg(
        F.count("*").alias("n"),
        F.array(*[F.coalesce(F.max(F.when(F.col("_r") == i, F.col("_k"))), F.lit(0))
                  for i in range(m)]).alias("registers"))


def estimate_from_array(registers: Column, m: int = 64, method: str = "md5") -> Column:
    """H3+H4 on a register array (finish step of the wide/streaming form)."""
    z = F.aggregate(registers, F.lit(0.0), lambda acc, r: acc + F.pow(F.lit(2.0), -r))
    zeros = F.size(F.filter(registers, lambda r: r == 0))
    return corrected(F.lit(alpha(m) * m * m) / z, zeros, m, method)


#: Secant steps of the likelihood estimate; it settles to the last digits in fewer.
SECANTS = 14


def likelihood_estimate(counts: Column, m: int, top: int) -> Column:
    """The most likely distinct count, from ``counts``: registers of rank 0 to ``top``.

    With x values a register, a rank of k (below ``top``) or less has the
    probability exp(-x / 2^k).  The derivative of the likelihood vanishes where

        x * sum(c_k / 2^k, k < top) + sum(c_k * (1 - h(x / 2^min(k, top - 1))), k > 0) = m - c_0,

    h(y) = y / (e^y - 1).  The left side is increasing and concave, so secants from
    0 and from below the root climb to it without overshooting.  One
    formula for all ranges: no jump between corrections.  A table whose registers
    are all at the top has no finite estimate and gets ``LARGEST``.
    """
    ranks = F.transform(F.slice(counts, 2, top), lambda c: c.cast("double"))
    share = F.array(*[F.lit(2.0 ** -min(k, top - 1)) for k in range(1, top + 1)])
    below = F.array(*[F.lit(2.0 ** -k if k < top else 0.0) for k in range(1, top + 1)])
    none = F.element_at(counts, 1).cast("double")

    def total(parts):
        return F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)
    filled = F.lit(float(m)) - none
    weight = none + total(F.zip_with(ranks, below, lambda c, w: c * w))
    tail = total(F.zip_with(ranks, share, lambda c, w: c * w))

    def excess(x):
        def gap(c, w):
            y = x * w
            # 1 - h(y): by its series where the quotient would lose its digits
            return c * F.when(y < 1e-5, y / 2 - y * y / 12).when(y > 700, F.lit(1.0)).otherwise(1 - y / F.expm1(y))
        return x * weight + total(F.zip_with(ranks, share, gap)) - filled

    def secant(s, _):
        f = excess(s["x"])
        step = F.when((f == s["f0"]) | (f >= 0), F.lit(0.0)).otherwise(-f * (s["x"] - s["x0"]) / (f - s["f0"]))
        return F.struct(s["x"].alias("x0"), f.alias("f0"), (s["x"] + step).alias("x"))
    start = F.struct(F.lit(0.0).alias("x0"), (-filled).alias("f0"), (filled / (weight + tail / 2)).alias("x"))
    x = F.aggregate(F.sequence(F.lit(1), F.lit(SECANTS)), start, secant)["x"]
    return F.when(none == m, F.lit(0.0)).when(weight == 0, F.lit(LARGEST)).otherwise(x * m)


def hll_likelihood(df: DataFrame, keys, value: str | Column, m: int = 64, method: str = "md5") -> DataFrame:
    """H4 without ranges: (key..., n, empty_registers, estimate, estimate_rounded) by likelihood.

    Registers of equal rank are counted: at most 65 numbers a key, added in one row.
    """
    ks = key_names(keys)
    top = bits(method) - _log2(m) + 1
    reg = hll_registers(df, ks, value, m, method)
    held = reg.groupBy(*ks).agg(F.sum("n").alias("n"), *[F.count_if(F.col("rank") == k).alias(f"_c{k}") for k in range(1, top + 1)])
    empty = F.lit(m) - sum((F.col(f"_c{k}") for k in range(1, top + 1)), F.lit(0))
    held = held.select(*ks, "n", empty.cast("bigint").alias("empty_registers"),
                       F.array(empty.cast("bigint"), *[F.col(f"_c{k}") for k in range(1, top + 1)]).alias("_c"))
    return held.select(*ks, "n", "empty_registers", likelihood_estimate(F.col("_c"), m, top).alias("estimate")) \
        .withColumn("estimate_rounded", F.least(F.round("estimate"), F.lit(LARGEST)).cast("bigint"))


def distinct_sketch(df: DataFrame, keys, value: str, rsd: float = 0.05,
                    lg_k: int = 12) -> DataFrame:
    """H6: Spark's own sketches — HLL++ estimate and a mergeable DataSketches
    HLL sketch (serialized, unionable across batches with ``hll_union_agg``)."""
    ks = key_names(keys)
    v = F.col(value)
    return df.groupBy(*ks).agg(
        F.approx_count_distinct(v, rsd).alias("approx_distinct"),
        F.hll_sketch_estimate(F.hll_sketch_agg(v.cast("string"), lg_k)).alias("sketch_estimate"))


def sketch_partials(df: DataFrame, keys, value: str, batch: str, lg_k: int = 12) -> DataFrame:
    """H6 state per (key, batch): a serialized DataSketches HLL sketch.

    Sketches are the mergeable state of the library path: per-batch (or
    per-day, per-file) sketches are kept instead of raw values and unioned
    later without rereading the data."""
    ks = key_names(keys)
    return df.groupBy(*ks, batch).agg(
        F.hll_sketch_agg(F.col(value).cast("string"), lg_k).alias("sketch"),
        F.count(value).alias("n"))


def union_sketches(partials: DataFrame, keys) -> DataFrame:
    """H6 merge: union per-batch sketches per key, then estimate."""
    ks = key_names(keys)
    return partials.groupBy(*ks).agg(
        F.sum("n").alias("n"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch", False)).alias("sketch_estimate"))


#: A sketch estimate is in bounds within so many standard errors.
SIGMAS = 5


def _exact(df: DataFrame, ks: list[str], value: str) -> DataFrame:
    """(key..., n, exact): rows and distinct values, both non-null, in two levels."""
    pairs = df.groupBy(*ks, value).agg(F.count(value).alias("n"))
    return pairs.groupBy(*ks).agg(F.sum("n").alias("n"), F.count(value).alias("exact"))


def _in_bounds(estimate: Column, error: float) -> Column:
    return F.abs(estimate - F.col("exact")) <= F.greatest(SIGMAS * error * F.col("exact"), F.lit(1.0))


def sketch_report(df: DataFrame, keys, value: str, rsd: float = 0.05, lg_k: int = 12) -> DataFrame:
    """H6 checked: exact count and whether each library sketch is in bounds."""
    ks = key_names(keys)
    exact = _exact(df, ks, value).withColumnsRenamed({k: f"_{k}" for k in ks})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in ks]
    both = distinct_sketch(df, ks, value, rsd, lg_k).join(exact, same)
    return both.select(*ks, "n", "exact", _in_bounds(F.col("approx_distinct"), rsd).alias("approx_in_bounds"),
                       _in_bounds(F.col("sketch_estimate"), 1.04 / 2 ** (lg_k / 2)).alias("sketch_in_bounds"))


def merged_sketch_report(df: DataFrame, partials: DataFrame, keys, value: str, lg_k: int = 12) -> DataFrame:
    """H6 merge checked: the union of per-batch sketches against the exact count."""
    ks = key_names(keys)
    exact = _exact(df, ks, value).withColumnsRenamed({k: f"_{k}" for k in ks}).withColumnRenamed("n", "_n")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in ks]
    both = union_sketches(partials, ks).join(exact, same)
    return both.select(*ks, "n", "exact", _in_bounds(F.col("sketch_estimate"), 1.04 / 2 ** (lg_k / 2)).alias("sketch_in_bounds"))


def running_sketches(partials: DataFrame, keys, batch: str) -> DataFrame:
    """H6 after every batch: (key..., batch, n, sketch) with each sketch the union of the
    key's sketches up to that batch.

    Prefix doubling: after round r a row holds the union of its last 2^r batches, and
    takes in the row 2^r places before it.  So a state costs log2(batches) merges of two
    sketches, all rows of a round at once, and no window holds sketches; the one
    window numbers (key, batch) pairs alone.
    """
    ks = key_names(keys)
    name = [f"_k{i}" for i in range(len(ks))]
    w = Window.partitionBy(*ks).orderBy(batch)
    places = partials.select(*ks, batch, "n").withColumn("_at", F.row_number().over(w)) \
        .withColumn("n", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    longest = places.agg(F.max("_at")).first()[0] or 0
    places = places.toDF(*name, "_b", "n", "_at")
    same = F.col(batch).eqNullSafe(F.col("_b"))
    for k, c in zip(ks, name):
        same &= F.col(k).eqNullSafe(F.col(c))
    rows = _kept(partials.select(*ks, batch, "sketch").join(places, same).drop(*name, "_b"), "sketches")
    reach = 1
    while reach < longest:
        before = rows.select(*[F.col(k).alias(c) for k, c in zip(ks, name)], (F.col("_at") + reach).alias("_to"), F.col("sketch").alias("_s"))
        same = F.col("_at") == F.col("_to")
        for k, c in zip(ks, name):
            same &= F.col(k).eqNullSafe(F.col(c))
        both = F.when(F.col("_s").isNull(), F.col("sketch")).when(F.col("sketch").isNull(), F.col("_s")).otherwise(
            F.hll_union("sketch", "_s", True))
        rows = _kept(rows.join(before, same, "left").withColumn("sketch", both).drop(*name, "_to", "_s"), "sketches")
        reach *= 2
    return rows.select(*ks, batch, "n", "sketch")


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: a round reads the one before twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running_sketch_report(df: DataFrame, keys, value: str, batch: str, lg_k: int = 12) -> DataFrame:
    """H6 checked after every batch: the running union against the exact running count.

    The exact count is that of values whose first batch is no later: one row per
    distinct (key, value), counted per first batch, then a running sum.
    """
    ks = key_names(keys)
    parts = sketch_partials(df, ks, value, batch, lg_k)
    first = df.where(F.col(value).isNotNull()).groupBy(*ks, value).agg(F.min(batch).alias("_b"))
    new = first.groupBy(*ks, "_b").agg(F.count(F.lit(1)).alias("_new"))
    name = [f"_n{i}" for i in range(len(ks))]
    new = new.toDF(*name, "_b", "_new")
    same = F.col(batch).eqNullSafe(F.col("_b"))
    for k, c in zip(ks, name):
        same &= F.col(k).eqNullSafe(F.col(c))
    w = Window.partitionBy(*ks).orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)
    held = running_sketches(parts, ks, batch).join(new, same, "left") \
        .select(*ks, batch, "n", F.hll_sketch_estimate("sketch").alias("_e"), F.coalesce("_new", F.lit(0)).alias("_new"))
    held = held.withColumn("exact", F.sum("_new").over(w))
    return held.select(*ks, batch, "n", "exact", _in_bounds(F.col("_e"), 1.04 / 2 ** (lg_k / 2)).alias("sketch_in_bounds"))
