"""Physical plans: pruning, pushdown, partial aggregation, no shuffle in the
Kalman passes; and the driver contract."""

from pyspark.sql import functions as F

from mergestat.operators import distinct, histogram, moments
from mergestat.operators.histogram import Bins
from mergestat.plans.compare import plan_text
from mergestat.sources.tables import only_key, table
from tests.conftest import SF001, SF01


def test_filter_pushed_and_columns_pruned(spark):
    ev = only_key(table(spark, SF001, "events"), "event_type", "click")
    plan = plan_text(moments.running_variance(ev, "event_type", "value"))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan
    assert "ReadSchema: struct<event_type:string,value:double>" in plan


def test_partial_aggregation_before_shuffle(spark):
    ev = table(spark, SF001, "events")
    for df in (moments.running_variance(ev, "event_type", "value"),
               distinct.hll_registers(ev, "event_type", "user_id"),
               histogram.histogram_long(ev, "event_type", "value", Bins(0.0, 100.0, 20))):
        plan = plan_text(df)
        assert "HashAggregate" in plan and "partial_" in plan
        assert "Exchange" in plan and "hashpartitioning" in plan


def test_kalman_passes_have_no_shuffle_on_data(spark):
    from mergestat.operators import kalman
    ev = table(spark, SF001, "events")
    tr = kalman.kalman_trace(ev, "event_type", "value")
    plan = plan_text(tr)
    # the passes read the checkpointed rows and join one row per partition
    assert "MapInArrow" in plan and "BroadcastHashJoin" in plan and "Scan ExistingRDD" in plan
    assert "SortMergeJoin" not in plan


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert set(df.columns) == {"label", "n", "mean", "variance", "stddev"}
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    found, _ = E._pipeline_parts()
    assert set(qs) - set(sql) - set(found) == {"kalman_lineitem_hot"}


def test_oracle_batch_queries_match(spark):
    """The driver's gate, for the batch catalogue at sf0.01."""
    from tests.oracle_harness import compare, duck
    import __spark_entry__ as E
    from mergestat.plans.catalog import BATCH_QUERIES
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(SF01)
    bad = {}
    for name in BATCH_QUERIES:
        if name not in sql:
            continue
        problems, _ = compare(qs[name](spark, SF01), con, sql[name])
        if problems:
            bad[name] = problems
    assert not bad


def test_shifted_running_variance_large_offset(spark):
    """history_variance stays accurate when the mean dwarfs the spread."""
    from mergestat.operators import history
    rows = [("k", 1e9 + v, b) for b in range(5) for v in (-1.0, 1.0, 0.5)]
    df = spark.createDataFrame(rows, "label string, value double, batch int")
    h = {r["batch"]: r["variance"] for r in history.history_variance(df, "label", "value", "batch").collect()}
    w = {r["b"]: r["v"] for r in spark.createDataFrame(rows, "label string, value double, b int")
         .groupBy().agg(F.var_pop("value").alias("v")).withColumn("b", F.lit(4)).collect()}
    assert abs(h[4] - w[4]) < 1e-6
