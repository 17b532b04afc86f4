"""The query catalogue: every operator of the inventory as a named query.

Each entry takes ``(spark, sf_dir)``, reads the given tables and returns a
DataFrame.  Default mapping of the keyed-event model onto ``events``:
label <- event_type, value <- value, order <- (ts, event_id), batch <- the
calendar day of ts.  Other tables exercise multi-column keys (``lineitem``),
negative values (``customer``) and many keys (``user_id``).

Doubles are rounded to 6 decimals (``plans.compare.rounded``) so that the
SQL oracle in ``plans.oracle`` can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergestat.operators import distinct, exact, extremes, histogram, history, kalman, kalman_irregular, moments
from mergestat.operators.histogram import Bins
from mergestat.plans.compare import rounded
from mergestat.sources.tables import events_stream_view, keyed, keyed_event, only_key, table

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the checked queries.
EVENT_BINS = Bins(lo=0.0, hi=100.0, nbins=20)          # 20 bins over [0, 100)
QUANTITY_EDGES = [0.0, 1.0, 5.0, 10.0, 20.0, 30.0, 40.0, 50.0]
ACCTBAL_BINS = Bins(lo=0.0, hi=10000.0, nbins=10)      # negatives land in underflow
K_LARGEST, J_SMALLEST = 4, 3
HLL_M = 64


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return events_stream_view(table(spark, sf, "events"))


def _r(df: DataFrame) -> DataFrame:
    return rounded(df)


# ---------------------------------------------------------------- 2.2

def q_keyed_projection(spark, sf):
    return _r(keyed(table(spark, sf, "events"), "event_type", "value")
              .withColumnRenamed("event_type", "label"))


def q_filtered_variance(spark, sf):
    ev = only_key(table(spark, sf, "events"), "event_type", "click")
    return _r(moments.running_variance(ev, "event_type", "value")
              .withColumnRenamed("event_type", "label"))


# ---------------------------------------------------------------- 2.3

def q_batch_sum(spark, sf):
    ev = _events(spark, sf)
    return _r(moments.batch_sum(ev, "label", "value", "batch"))


def q_running_sum(spark, sf):
    return _r(moments.running_sum(_events(spark, sf), "label", "value"))


def q_running_count(spark, sf):
    return moments.running_count(_events(spark, sf), "label", "value")


def q_running_mean(spark, sf):
    return _r(moments.running_mean(_events(spark, sf), "label", "value"))


def q_running_variance(spark, sf):
    return _r(moments.running_variance(_events(spark, sf), "label", "value"))


def q_running_stddev(spark, sf):
    return _r(moments.running_stddev(_events(spark, sf), "label", "value"))


def q_variance_sum_squares(spark, sf):
    return _r(moments.variance_sum_squares(_events(spark, sf), "label", "value"))


def q_variance_lineitem(spark, sf):
    # variances near 1e9 carry no sixth decimal in double precision
    li = table(spark, sf, "lineitem")
    v = moments.running_variance(li, ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return _r(v.withColumn("variance", F.round("variance", 0)))


def q_variance_merge_partials(spark, sf):
    ev = _events(spark, sf)
    parts = moments.moment_partials(ev, "label", "value", "batch")
    return _r(moments.variance_from_partials(parts, "label"))


def q_variance_pairwise_merge(spark, sf):
    li = table(spark, sf, "lineitem")
    open_ = F.col("l_linestatus").eqNullSafe(F.lit("O"))       # every row is on one side
    a = moments.running_variance(li.where(open_), "l_returnflag", "l_quantity")
    b = moments.running_variance(li.where(~open_), "l_returnflag", "l_quantity")
    return _r(moments.pairwise_merge(a, b, "l_returnflag"))


def q_higher_moments(spark, sf):
    return _r(moments.higher_moments(_events(spark, sf), "label", "value"))


def q_higher_moments_merge_partials(spark, sf):
    """Third and fourth moments of each day, merged per key."""
    parts = moments.higher_partials(_events(spark, sf), "label", "value", "batch")
    return _r(moments.shapes(moments.higher_from_partials(parts, "label"), "label"))


def q_higher_moments_pairwise_merge(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("open", F.col("l_linestatus").eqNullSafe(F.lit("O")))
    sides = moments.higher_partials(li, "l_returnflag", "l_quantity", "open")
    a, b = (sides.where(F.col("batch") == side).drop("batch") for side in (True, False))
    return _r(moments.shapes(moments.pairwise_merge_higher(a, b, "l_returnflag"), "l_returnflag"))


def q_exact_sum(spark, sf):
    """A2 independent of order: compared to the last bit, nothing rounded."""
    return exact.exact_sum(_events(spark, sf), "label", "value")


def q_exact_batch_sum(spark, sf):
    """A1 independent of order: compared to the last bit, nothing rounded."""
    return exact.exact_batch_sum(_events(spark, sf), "label", "value", "batch")


def q_exact_median(spark, sf):
    """Mean, exact median and histogram estimate."""
    return _r(exact.mean_and_medians(_events(spark, sf), "label", "value", EVENT_BINS))


def q_exact_median_lineitem(spark, sf):
    """Hot keys: three return flags with a third of the rows each."""
    return exact.exact_median(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")


def q_exact_median_by_user(spark, sf):
    """Many keys: the median of every user."""
    return exact.exact_median(table(spark, sf, "events"), "user_id", "value")


# ---------------------------------------------------------------- 2.4

def q_k_largest(spark, sf):
    return _r(extremes.k_largest(_events(spark, sf), "label", "value", K_LARGEST,
                                 tiebreak=["event_id"]))


def q_j_smallest(spark, sf):
    return _r(extremes.j_smallest(_events(spark, sf), "label", "value", J_SMALLEST,
                                  tiebreak=["event_id"]))


def q_extremes_acctbal(spark, sf):
    cu = table(spark, sf, "customer")
    return _r(extremes.extremes(cu, "c_mktsegment", "c_acctbal", K_LARGEST, J_SMALLEST,
                                tiebreak=["c_custkey"]))


def q_extremes_totalprice(spark, sf):
    od = table(spark, sf, "orders")
    return _r(extremes.extremes(od, "o_orderpriority", "o_totalprice", K_LARGEST, J_SMALLEST,
                                tiebreak=["o_orderkey"]))


# ---------------------------------------------------------------- 2.5

def q_hll_registers(spark, sf):
    ev = table(spark, sf, "events").withColumnRenamed("event_type", "label")
    return distinct.hll_registers(ev, "label", "user_id", HLL_M)


def q_hll_estimate(spark, sf):
    ev = table(spark, sf, "events").withColumnRenamed("event_type", "label")
    return _r(distinct.hll_distinct(ev, "label", "user_id", HLL_M))


def q_hll_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    return _r(distinct.hll_distinct(li, "l_returnflag", "l_partkey", HLL_M))


def q_hll_error_report(spark, sf):
    ev = table(spark, sf, "events").withColumnRenamed("event_type", "label")
    return _r(distinct.hll_error_report(ev, "label", "user_id", HLL_M))


def q_distinct_sketch(spark, sf):
    """Exact count, and whether either library sketch is within its bound of it."""
    li = table(spark, sf, "lineitem")
    return distinct.sketch_report(li, "l_returnflag", "l_partkey")


def q_distinct_sketch_merged(spark, sf):
    """Per-day sketches of lineitem part keys, unioned per return flag, against the exact count."""
    li = table(spark, sf, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    parts = distinct.sketch_partials(li, "l_returnflag", "l_partkey", "day")
    return distinct.merged_sketch_report(li, parts, "l_returnflag", "l_partkey")


def q_hll_likelihood(spark, sf):
    """H4 by likelihood, one formula for all ranges."""
    ev = table(spark, sf, "events").withColumnRenamed("event_type", "label")
    return _r(distinct.hll_likelihood(ev, "label", "user_id", HLL_M))


def q_hll_likelihood_lineitem(spark, sf):
    return _r(distinct.hll_likelihood(table(spark, sf, "lineitem"), "l_returnflag", "l_partkey", HLL_M))


def q_running_sketches(spark, sf):
    """H6: the union of all sketches up to every day, against the exact count."""
    ev = table(spark, sf, "events").withColumnRenamed("event_type", "label").withColumn("batch", F.to_date("ts"))
    return distinct.running_sketch_report(ev, "label", "user_id", "batch")


# ---------------------------------------------------------------- 2.6

def q_histogram(spark, sf):
    return histogram.histogram_long(_events(spark, sf), "label", "value", EVENT_BINS)


def q_histogram_custom_edges(spark, sf):
    li = table(spark, sf, "lineitem")
    return histogram.histogram_long(li, "l_returnflag", "l_quantity", Bins(edges=QUANTITY_EDGES))


def q_histogram_cumulative(spark, sf):
    return histogram.histogram_cumulative(_events(spark, sf), "label", "value", EVENT_BINS)


def q_histogram_median(spark, sf):
    return _r(histogram.histogram_median(_events(spark, sf), "label", "value", EVENT_BINS))


def q_running_histogram_median(spark, sf):
    st = histogram.running_histogram_median(_events(spark, sf), "label", "value", EVENT_BINS)
    return _r(st.select("label", "n", "mean", F.array_join("counts", ",").alias("counts"),
                        "median_estimate"))


def q_mean_vs_median(spark, sf):
    return _r(histogram.mean_vs_median(_events(spark, sf), "label", "value", EVENT_BINS))


def q_histogram_acctbal(spark, sf):
    cu = table(spark, sf, "customer")
    return histogram.histogram_long(cu, "c_mktsegment", "c_acctbal", ACCTBAL_BINS)


def q_histogram_median_acctbal(spark, sf):
    cu = table(spark, sf, "customer")
    return _r(histogram.histogram_median(cu, "c_mktsegment", "c_acctbal", ACCTBAL_BINS))


# ---------------------------------------------------------------- 2.8 W5

def q_history_sum(spark, sf):
    return _r(history.history_sum(_events(spark, sf), "label", "value", "batch"))


def q_history_mean(spark, sf):
    return _r(history.history_mean(_events(spark, sf), "label", "value", "batch"))


def q_history_variance(spark, sf):
    return _r(history.history_variance(_events(spark, sf), "label", "value", "batch"))


def q_history_extremes(spark, sf):
    return _r(history.history_extremes(_events(spark, sf), "label", "value", "batch", K_LARGEST, J_SMALLEST))


def q_history_hll(spark, sf):
    ev = table(spark, sf, "events").withColumnRenamed("event_type", "label").withColumn("batch", F.to_date("ts"))
    return _r(history.history_hll(ev, "label", "user_id", "batch", HLL_M))


def q_history_by_user(spark, sf):
    """Many keys: count and sum of every user after every day."""
    ev = table(spark, sf, "events").withColumn("batch", F.to_date("ts"))
    return _r(history.history_sum(ev, "user_id", "value", "batch"))


def q_history_histogram_median(spark, sf):
    h = history.history_histogram_median(_events(spark, sf), "label", "value", "batch", EVENT_BINS)
    return _r(h.withColumn("counts", F.array_join("counts", ",")))


def q_history_higher_moments(spark, sf):
    return _r(history.history_higher_moments(_events(spark, sf), "label", "value", "batch"))


def q_history_orders_monthly(spark, sf):
    od = (table(spark, sf, "orders")
          .withColumn("month", F.to_date(F.date_trunc("month", "o_orderdate"))))
    # variances near 1e10 carry no sixth decimal in double precision
    h = history.history_variance(od, "o_orderpriority", "o_totalprice", "month", step="1 month")
    return _r(h.drop("variance_sum_squares").withColumn("variance", F.round("variance", -2)))


# ---------------------------------------------------------------- 2.7

def _whole_events(spark, sf) -> DataFrame:
    """Label and the whole event, as the filter takes them."""
    ev = table(spark, sf, "events").withColumnRenamed("event_type", "label")
    return keyed_event(ev, "label", ["ts", "event_id", "value"]).select("label", "event.*")


def q_kalman_final(spark, sf):
    ev = _whole_events(spark, sf)
    return _r(kalman.kalman_final(ev, "label", "value", ("ts", "event_id")))


def q_kalman_trace(spark, sf):
    ev = _whole_events(spark, sf)
    return _r(kalman.kalman_trace(ev, "label", "value", ("ts", "event_id"))
              .select("label", "event_id", "step", "z", "x0", "x1", "p00", "p01", "p10", "p11"))


def q_kalman_by_user(spark, sf):
    ev = table(spark, sf, "events")
    return _r(kalman.kalman_final(ev, "user_id", "value", ("ts", "event_id")))


#: Noise of the checked observations: up to this much to either side, as the id decides.
NOISE = 4.0


def q_kalman_errors(spark, sf):
    """Values as the true state, observed with noise that the id decides: errors before and after the filter."""
    ev = _whole_events(spark, sf)
    noise = (F.col("event_id") * 7919 % 1001 - 500) / 500.0 * NOISE
    return _r(kalman.kalman_errors(ev.withColumn("seen", F.col("value") + noise), "label", "seen", "value", ("ts", "event_id")))


def q_kalman_irregular(spark, sf):
    """Steps as long as the hours between events, and one in ten rows without an observation."""
    ev = _whole_events(spark, sf).withColumn("value", F.when(F.col("event_id") % 10 != 0, F.col("value")))
    return rounded(kalman_irregular.kalman_irregular(ev, "label", "value", ("ts", "event_id"), unit=3600.0,
                                                     passthrough=["event_id"]), 4)


def q_kalman_lineitem_hot(spark, sf):
    """Hot keys: three return flags, each holding about a third of lineitem.
    Range partitioning cuts each flag's trajectory over many partitions.
    No SQL oracle: a recursive CTE needs one iteration per step (hundreds of
    thousands); tests check the scan against a sequential run instead."""
    li = table(spark, sf, "lineitem")
    return _r(kalman.kalman_final(li, "l_returnflag", "l_quantity",
                                  ("l_shipdate", "l_orderkey", "l_linenumber")))


def q_variance_by_user(spark, sf):
    """Many keys: moments per user."""
    return _r(moments.running_variance(table(spark, sf, "events"), "user_id", "value"))


def q_k_largest_by_user(spark, sf):
    """Many keys: the k largest values of every user."""
    return _r(extremes.k_largest(table(spark, sf, "events"), "user_id", "value", K_LARGEST,
                                 tiebreak=["event_id"]))


BATCH_QUERIES: dict[str, Query] = {
    "keyed_projection": q_keyed_projection,
    "filtered_variance": q_filtered_variance,
    "batch_sum": q_batch_sum,
    "running_sum": q_running_sum,
    "running_count": q_running_count,
    "running_mean": q_running_mean,
    "running_variance": q_running_variance,
    "running_stddev": q_running_stddev,
    "variance_sum_squares": q_variance_sum_squares,
    "variance_lineitem": q_variance_lineitem,
    "variance_merge_partials": q_variance_merge_partials,
    "variance_pairwise_merge": q_variance_pairwise_merge,
    "higher_moments": q_higher_moments,
    "higher_moments_merge_partials": q_higher_moments_merge_partials,
    "higher_moments_pairwise_merge": q_higher_moments_pairwise_merge,
    "exact_sum": q_exact_sum,
    "exact_batch_sum": q_exact_batch_sum,
    "exact_median": q_exact_median,
    "exact_median_lineitem": q_exact_median_lineitem,
    "exact_median_by_user": q_exact_median_by_user,
    "k_largest": q_k_largest,
    "j_smallest": q_j_smallest,
    "extremes_acctbal": q_extremes_acctbal,
    "extremes_totalprice": q_extremes_totalprice,
    "hll_registers": q_hll_registers,
    "hll_estimate": q_hll_estimate,
    "hll_lineitem": q_hll_lineitem,
    "hll_error_report": q_hll_error_report,
    "hll_likelihood": q_hll_likelihood,
    "hll_likelihood_lineitem": q_hll_likelihood_lineitem,
    "running_sketches": q_running_sketches,
    "distinct_sketch": q_distinct_sketch,
    "distinct_sketch_merged": q_distinct_sketch_merged,
    "histogram": q_histogram,
    "histogram_custom_edges": q_histogram_custom_edges,
    "histogram_cumulative": q_histogram_cumulative,
    "histogram_median": q_histogram_median,
    "running_histogram_median": q_running_histogram_median,
    "mean_vs_median": q_mean_vs_median,
    "histogram_acctbal": q_histogram_acctbal,
    "histogram_median_acctbal": q_histogram_median_acctbal,
    "history_sum": q_history_sum,
    "history_mean": q_history_mean,
    "history_variance": q_history_variance,
    "history_higher_moments": q_history_higher_moments,
    "history_histogram_median": q_history_histogram_median,
    "history_orders_monthly": q_history_orders_monthly,
    "history_extremes": q_history_extremes,
    "history_hll": q_history_hll,
    "history_by_user": q_history_by_user,
    "kalman_final": q_kalman_final,
    "kalman_trace": q_kalman_trace,
    "kalman_by_user": q_kalman_by_user,
    "kalman_lineitem_hot": q_kalman_lineitem_hot,
    "kalman_irregular": q_kalman_irregular,
    "kalman_errors": q_kalman_errors,
    "variance_by_user": q_variance_by_user,
    "k_largest_by_user": q_k_largest_by_user,
}
