"""State history: the state of every key after every batch (W5, S4 in batch).

The reference prints, after each micro-batch, the state of *all* keys seen
so far — quiet keys repeat their last state.  In batch form:

1. per-(key, batch) partial states: one partially-aggregated shuffle, so the
   table has one row per key and batch however many rows a batch holds;
2. the quiet batches of each key filled in from the partial before them
   (``lead`` + ``sequence`` + ``posexplode``): every key from its first
   batch to the last batch of the table, no join, no cross product;
3. running totals with a ``rows unbounded preceding`` window per key.  The
   window partitions hold one row per batch, so a hot key costs its number
   of batches, not its number of rows.

Batches are dates (``batch`` is a DATE column, snapped to ``step``) or
consecutive integers; a day without data is a trigger that brought nothing, so
state repeats.  Rows whose batch is NULL come before the first batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergestat.functions.binning import median_from_counts
from mergestat.functions.moments import HIGHER, centred, power_sums, shape_of
from mergestat.operators.distinct import _estimated, hll_registers
from mergestat.operators.extremes import extremes
from mergestat.operators.histogram import Bins
from mergestat.operators.moments import higher_partials
from mergestat.sources.tables import key_names


#: Batches of a key that are folded in one row, and quiet integer batches that are filled in at once.
FOLD, STRETCH = 256, 1 << 16


def _v(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _snapped(batch: Column, step: str) -> Column:
    """The first day of the step that a date falls in; steps are counted from
    Monday 1970-01-05, steps of months or years from 1970-01-01."""
    n, unit = step.split()
    n, unit = int(n), unit.rstrip("s").lower()
    if unit in ("month", "year"):
        n *= 12 if unit == "year" else 1
        months = (F.year(batch) - 1970) * 12 + F.month(batch) - 1
        return F.add_months(F.lit("1970-01-01").cast("date"), (F.floor(months / n) * n).cast("int"))
    if unit not in ("day", "week"):
        raise ValueError(f"step {step!r}: use days, weeks, months or years")
    n *= 7 if unit == "week" else 1
    monday = F.lit("1970-01-05").cast("date")
    return F.date_add(monday, (F.floor(F.datediff(batch, monday) / n) * n).cast("int"))


def _batch(df: DataFrame, batch: str | Column, step: str) -> Column:
    """The batch column, checked and snapped to the step."""
    b = F.col(batch) if isinstance(batch, str) else batch
    kind = df.select(b.alias("b")).schema["b"].dataType
    if isinstance(kind, T.DateType):
        return _snapped(b, step).alias("batch")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return b.alias("batch")
    raise TypeError(f"batches are dates or integers, not {kind.simpleString()}; convert with to_date")


def _dense(partials: DataFrame, keys, batch: str = "batch", step: str = "1 day",
           repeat: bool = False) -> DataFrame:
    """Partials with every quiet batch filled in, per key.

    Each partial row stands for its own batch and the quiet batches up to
    the key's next partial (``lead``), or up to the table's last batch; the
    first one carries the partial's values and the rest NULLs (with ``repeat``
    the values too).  One window over the partial table (one row per key and
    batch), no join and no second scan; the running windows that follow reuse
    its partitioning.  DATE batches advance by ``step``, integer batches by one.

    Rows without a batch come before the first batch of the table: their state
    is a row of batch NULL, and the key goes on from the first batch.
    """
    ks = key_names(keys)
    first, last = partials.select(F.min(batch), F.max(batch)).first()
    kind = partials.schema[batch].dataType
    first, last = F.lit(first).cast(kind), F.lit(last).cast(kind)
    inc = F.expr(f"INTERVAL {step}") if isinstance(kind, T.DateType) else F.lit(1).cast(kind)
    upto = F.coalesce(F.lead(batch).over(Window.partitionBy(*ks).orderBy(batch)) - inc, last).cast(kind)
    own = F.array(F.col(batch))
    begin = F.coalesce(F.col(batch), first)
    stats = [c for c in partials.columns if c not in (*ks, batch)]
    rows = partials.withColumn("_end", upto)
    if isinstance(kind, T.DateType):
        stretch, end = begin, F.col("_end")
    else:
        # integer batches may lie far apart: stretches of STRETCH first, so that no array grows with a gap
        long = begin.cast("decimal(20,0)"), F.col("_end").cast("decimal(20,0)")
        starts = F.when(long[1] >= long[0], F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.floor((long[1] - long[0]) / STRETCH).cast("bigint")),
            lambda i: (long[0] + i.cast("decimal(20,0)") * STRETCH).cast(kind)))
        rows = rows.select("*", F.posexplode_outer(starts).alias("_nth", "_from"))
        stretch = F.coalesce("_from", begin)
        end = F.least(F.col("_end").cast("decimal(20,0)"), stretch.cast("decimal(20,0)") + (STRETCH - 1)).cast(kind)
        own = F.when(F.coalesce("_nth", F.lit(0)) == 0, own).otherwise(F.array().cast(T.ArrayType(kind)))
    quiet = F.when(end >= stretch, F.sequence(stretch, end, inc))
    batches = F.when(F.col(batch).isNull(), F.concat(own, F.coalesce(quiet, F.array().cast(T.ArrayType(kind))))).otherwise(quiet)
    rows = rows.select(*ks, *stats, *(["_nth"] if "_nth" in rows.columns else []), F.posexplode(batches).alias("_pos", "_b"))
    if "_nth" in rows.columns:
        rows = rows.withColumn("_pos", F.col("_pos") + F.coalesce("_nth", F.lit(0)))
    return rows.select(*ks, F.col("_b").alias(batch),
                       *[F.col(c) if repeat else F.when(F.col("_pos") == 0, F.col(c)).alias(c) for c in stats])


def _running(keys, batch: str = "batch") -> Window:
    return (Window.partitionBy(*key_names(keys)).orderBy(batch)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _partials(df: DataFrame, keys, value, batch, step: str) -> DataFrame:
    v = _v(value)
    return (df.groupBy(*key_names(keys), _batch(df, batch, step))
              .agg(F.count(v).alias("pn"), F.sum(v).alias("ps"),
                   F.avg(v).alias("pmean"), (F.var_pop(v) * F.count(v)).alias("pm2")))


def history_sum(df: DataFrame, keys, value, batch, step: str = "1 day") -> DataFrame:
    """Running count and sum per key after every batch."""
    ks = key_names(keys)
    d = _dense(_partials(df, keys, value, batch, step), keys, step=step)
    w = _running(keys)
    return d.select(*ks, "batch",
                    F.sum(F.coalesce("pn", F.lit(0))).over(w).alias("n"),
                    F.sum("ps").over(w).alias("sum"))


def history_mean(df: DataFrame, keys, value, batch, step: str = "1 day") -> DataFrame:
    """Running count and mean per key after every batch."""
    ks = key_names(keys)
    d = _dense(_partials(df, keys, value, batch, step), keys, step=step)
    w = _running(keys)
    n = F.sum(F.coalesce("pn", F.lit(0))).over(w)
    return d.select(*ks, "batch", n.alias("n"),
                    (F.sum("ps").over(w) / F.when(n > 0, n)).alias("mean"))


def history_variance(df: DataFrame, keys, value, batch, step: str = "1 day") -> DataFrame:
    """Running count, mean and population variance per key after every batch,
    next to the variance from sums of squares (A5, for comparison only).

    Partials (n_i, mean_i, m2_i) are pooled with the k-way Chan rule written
    as running sums around a per-key shift c (the key's overall mean):
    m2_t = sum m2_i + sum n_i (mean_i - c)^2 - N_t (M_t - c)^2, where M_t is
    the running mean.  Shifting keeps the subtraction well conditioned.
    """
    ks = key_names(keys)
    d = _dense(_partials(df, keys, value, batch, step), keys, step=step)
    whole = Window.partitionBy(*ks)
    d = d.withColumn("_c", F.sum(F.col("pn") * F.col("pmean")).over(whole)
                     / F.sum("pn").over(whole))
    w = _running(keys)
    pn = F.coalesce(F.col("pn"), F.lit(0))
    dev = F.col("pmean") - F.col("_c")
    n = F.sum(pn).over(w)
    s1 = F.sum(F.when(pn > 0, pn * dev).otherwise(0.0)).over(w)
    s2 = F.sum(F.when(pn > 0, F.col("pm2") + pn * dev * dev).otherwise(0.0)).over(w)
    total = F.sum("ps").over(w)
    squares = F.sum(F.when(pn > 0, F.col("pm2") + pn * F.col("pmean") * F.col("pmean")).otherwise(0.0)).over(w)
    out = d.select(*ks, "batch", n.alias("n"), s1.alias("_s1"), s2.alias("_s2"), "_c",
                   total.alias("_t"), squares.alias("_q"))
    mean = F.col("_t") / F.col("n")
    var = F.greatest(F.lit(0.0), (F.col("_s2") - F.col("_s1") * F.col("_s1") / F.col("n")) / F.col("n"))
    return out.select(*ks, "batch", "n",
                      F.when(F.col("n") > 0, mean).alias("mean"),
                      F.when(F.col("n") > 0, var).alias("variance"),
                      F.when(F.col("n") > 0, F.sqrt(var)).alias("stddev"),
                      F.when(F.col("n") > 0, F.col("_q") / F.col("n") - mean * mean).alias("variance_sum_squares"))


def history_higher_moments(df: DataFrame, keys, value, batch, step: str = "1 day") -> DataFrame:
    """Running count, mean, population variance, skewness and excess kurtosis per
    key after every batch.

    Each batch's state becomes power sums about a per-key shift (the key's overall
    mean), which add up along the key; the moments after a batch are those sums
    taken back to the running mean.
    """
    ks = key_names(keys)
    parts = higher_partials(df, keys, value, _batch(df, batch, step))
    d = _dense(parts, keys, step=step)
    d = d.withColumn("_c", F.sum(F.col("n") * F.col("mean")).over(Window.partitionBy(*ks)) / F.sum("n").over(Window.partitionBy(*ks)))
    w = _running(keys)
    sums = power_sums(*[F.col(c) for c in HIGHER], F.col("_c"))
    run = d.select(*ks, "batch", "_c", F.sum(F.coalesce("n", F.lit(0))).over(w).alias("n"),
                   *[F.sum(F.when(F.col("n") > 0, s).otherwise(0.0)).over(w).alias(f"_s{p}") for p, s in enumerate(sums, 1)])
    m2, m3, m4 = centred(F.col("n"), *[F.col(f"_s{p}") for p in range(1, 5)])
    run = run.select(*ks, "batch", "n", F.when(F.col("n") > 0, F.col("_c") + F.col("_s1") / F.col("n")).alias("mean"),
                     F.greatest(m2, F.lit(0.0)).alias("m2"), m3.alias("m3"), m4.alias("m4"))
    variance, skewness, kurtosis = shape_of(F.col("n"), F.col("m2"), F.col("m3"), F.col("m4"))
    return run.select(*ks, "batch", "n", "mean", variance.alias("variance"), skewness.alias("skewness"), kurtosis.alias("kurtosis"))


def history_histogram_median(df: DataFrame, keys, value, batch, bins: Bins,
                             step: str = "1 day") -> DataFrame:
    """Running count, mean, histogram and its median estimate per key after every batch.

    Per (key, batch): B+2 slot counts and the sum of the values that have a slot, in
    one partial-aggregated shuffle; then their running sums in one window; mean and
    median are projections.
    """
    ks = key_names(keys)
    v = _v(value)
    s = F.col("_s")
    parts = (df.select(*ks, _batch(df, batch, step), bins.slot(v).alias("_s"), v.cast("double").alias("_v"))
               .groupBy(*ks, "batch")
               .agg(*[F.count_if(s == i).alias(f"_c{i}") for i in range(bins.nslots)],
                    F.sum(F.when(s.isNotNull(), F.col("_v"))).alias("_sum")))
    d = _dense(parts, keys, step=step)
    w = _running(keys)
    run = [F.sum(F.coalesce(f"_c{i}", F.lit(0))).over(w).cast("bigint").alias(f"_r{i}")
           for i in range(bins.nslots)]
    r = d.select(*ks, "batch", F.sum("_sum").over(w).alias("_sum"), *run)
    counts = F.array(*[F.col(f"_r{i}") for i in range(bins.nslots)])
    r = r.select(*ks, "batch", "_sum", counts.alias("counts"),
                 F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, y: a + y).alias("n"))
    return r.select(*ks, "batch", "n", F.when(F.col("n") > 0, F.col("_sum") / F.col("n")).alias("mean"), "counts",
                    median_from_counts(F.col("counts"), bins.edges).alias("median_estimate"))


def _running_lists(parts: DataFrame, ks, at: str, k: int, j: int, kind: T.ArrayType, most: int) -> DataFrame:
    """``parts`` (key..., at, largest, smallest) with the lists of all rows up to
    each; no key has more than ``most`` rows.

    Longer histories are folded in blocks of ``FOLD`` rows; what the blocks close
    with is a history again, whose state before a block is merged into its rows.
    """
    def merged(a, b):
        return (F.slice(F.sort_array(F.concat(a["largest"], b["largest"]), asc=False), 1, k).alias("largest"),
                F.slice(F.sort_array(F.concat(a["smallest"], b["smallest"])), 1, j).alias("smallest"))

    def fold(state, p):
        now = F.struct(p[at].alias(at), *merged(state, p))
        return F.struct(F.concat(state["out"], F.array(now)).alias("out"), now["largest"].alias("largest"),
                        now["smallest"].alias("smallest"))
    none = F.array().cast(kind)
    start = F.struct(F.filter(F.array(F.element_at("all", 1)), lambda _: F.lit(False)).alias("out"),
                     none.alias("largest"), none.alias("smallest"))
    block = f"{at}_of"
    number = (F.floor((F.row_number().over(Window.partitionBy(*ks).orderBy(at)) - 1) / FOLD) if most > FOLD else F.lit(0)).cast("bigint")
    folded = (parts.withColumn(block, number).groupBy(*ks, block)
              .agg(F.sort_array(F.collect_list(F.struct(at, "largest", "smallest"))).alias("all"))
              .select(*ks, block, F.aggregate("all", start, fold)["out"].alias("out")))
    if most <= FOLD:
        return folded.select(*ks, F.explode("out").alias("s")).select(*ks, "s.*")
    closing = folded.select(*ks, block, F.element_at("out", -1).alias("s")).select(*ks, block, "s.largest", "s.smallest")
    before = _running_lists(closing, ks, block, k, j, kind, -(-most // FOLD))
    before = before.select(*[F.col(c).alias(f"_before{i}") for i, c in enumerate(ks)], (F.col(block) + 1).alias("_before"),
                           F.struct("largest", "smallest").alias("b"))
    same = F.col(block) == F.col("_before")
    for i, c in enumerate(ks):
        same &= F.col(c).eqNullSafe(F.col(f"_before{i}"))
    rows = folded.join(before, same, "left").select(
        *ks, F.coalesce("b", F.struct(none.alias("largest"), none.alias("smallest"))).alias("b"), F.explode("out").alias("s"))
    return rows.select(*ks, F.col(f"s.{at}").alias(at), *merged(F.col("b"), F.col("s")))


def history_extremes(df: DataFrame, keys, value: str, batch, k: int = 4, j: int = 3,
                     step: str = "1 day") -> DataFrame:
    """The k largest and j smallest values of every key after every batch:
    (key..., batch, side, rank, value).

    Per (key, batch) the lists are cut before the shuffle, so what is folded
    along a key is k + j values per batch, never its rows; at most ``FOLD``
    batches are folded in one row.  Numbers keep their own type.
    """
    ks = key_names(keys)
    kind = df.schema[value].dataType
    kind = kind if isinstance(kind, T.NumericType) else T.DoubleType()
    rows = df.select(*ks, _batch(df, batch, step), F.col(value).cast(kind).alias("_v"))
    long = extremes(rows, [*ks, "batch"], "_v", k, j)

    def values(side):
        return F.collect_list(F.when(F.col("side") == side, F.col("_v"))).alias(side)
    # a batch without usable values still starts its key
    seen = rows.select(*ks, "batch").distinct()
    parts = long.select(*ks, "batch", "side", "_v").unionByName(
        seen.withColumn("side", F.lit(None).cast("string")).withColumn("_v", F.lit(None).cast(kind)))
    parts = parts.groupBy(*ks, "batch").agg(values("largest"), values("smallest"))
    most = seen.groupBy(*ks).count().agg(F.max("count")).first()[0] or 0
    states = _running_lists(parts, ks, "batch", k, j, T.ArrayType(kind), most)
    dense = _dense(states, keys, step=step, repeat=True)
    return dense.select(*ks, "batch", F.explode(F.concat(*[
        F.transform(side, lambda v, i: F.struct(F.lit(side).alias("side"), (i + 1).cast("bigint").alias("rank"), v.alias("value")))
        for side in ("largest", "smallest")])).alias("e")).select(*ks, "batch", "e.side", "e.rank", F.col("e.value").alias(value))


def history_hll(df: DataFrame, keys, value: str, batch, m: int = 64, method: str = "md5",
                step: str = "1 day") -> DataFrame:
    """Distinct count of every key after every batch: rows seen, empty registers
    and the estimates.

    Registers are merged by a running maximum per (key, register); what each
    batch changes in the sum of 2^-rank and in the number of empty registers
    runs along the key, so no register array is built per batch.
    """
    ks = key_names(keys)
    b = _batch(df, batch, step)
    rows = df.select(*ks, b, F.col(value).alias("_v"))
    reg = hll_registers(rows, [*ks, "batch"], "_v", m, method)
    before = Window.partitionBy(*ks, "register").orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    was = F.max("rank").over(before)
    reg = reg.withColumn("_was", was).select(
        *ks, "batch", "n", F.when(F.col("_was").isNull(), 1).otherwise(0).alias("new"),
        (F.pow(F.lit(2.0), -F.greatest("rank", F.coalesce("_was", F.lit(0))))
         - F.pow(F.lit(2.0), -F.coalesce("_was", F.lit(0)))).alias("dz"))
    seen = rows.select(*ks, "batch").distinct().select(
        *ks, "batch", F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("new"), F.lit(0.0).alias("dz"))
    parts = reg.unionByName(seen).groupBy(*ks, "batch").agg(
        F.sum("n").alias("n"), F.sum("new").alias("new"), F.sum("dz").alias("dz"))
    d, w = _dense(parts, keys, step=step), _running(keys)
    sums = d.select(*ks, "batch", F.sum(F.coalesce("n", F.lit(0))).over(w).cast("bigint").alias("n"),
                    (F.lit(m) + F.sum(F.coalesce("dz", F.lit(0.0))).over(w)).alias("z"),
                    (F.lit(m) - F.sum(F.coalesce("new", F.lit(0))).over(w)).cast("bigint").alias("empty_registers"))
    return _estimated(sums, [*ks, "batch"], m, method)
