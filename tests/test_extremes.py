"""k largest / j smallest against sorting."""

import random

from mergestat.operators import extremes
from mergestat.plans.compare import plan_text

BIG = 2 ** 60


def test_lists_of_large_and_null_keys(spark):
    r = random.Random(8)
    rows = [(k, r.choice([None, float("nan"), float(r.randint(-9, 9))]), i)
            for i, k in enumerate([BIG, BIG + 1, None, 4] * 40)] + [(5, -2.5, 900), (6, None, 901)]
    df = spark.createDataFrame(rows, "label long, value double, id long").repartition(5)
    got = {x["label"]: x for x in extremes.extremes_arrays(df, "label", "value", 4, 3, tiebreak=["id"]).collect()}
    for k in {k for k, _, _ in rows} - {6}:
        vs = sorted(v for key, v, _ in rows if key == k and v is not None and v == v)
        assert (got[k]["largest"], got[k]["smallest"]) == (vs[::-1][:4], vs[:3])
    assert 6 not in got


def test_smallest_integer_and_decimals(spark):
    low = -2 ** 63
    df = spark.createDataFrame([(low,), (5,), (2 ** 63 - 1,)], "value long").selectExpr("'a' as label", "value")
    got = {(r["side"], r["rank"]): r["value"] for r in extremes.extremes(df, "label", "value", 1, 1).collect()}
    assert got == {("largest", 1): 2 ** 63 - 1, ("smallest", 1): low}


def test_plan_limits_before_shuffle_and_scans_once(spark):
    from tests.conftest import SF001
    from mergestat.sources.tables import events_stream_view, table
    ev = events_stream_view(table(spark, SF001, "events"))
    plan = plan_text(extremes.k_largest(ev, "label", "value", 4, ["event_id"]))
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange") or "Partial" in plan
    both = plan_text(extremes.extremes(ev, "label", "value", 4, 3, ["event_id"]), "simple")
    assert both.count("FileScan") == 1 and both.count("Exchange") == 1 and "WindowGroupLimit" in both


def test_hot_key_with_ties_against_sorting(spark):
    """One dominant key, many duplicate values, spread over many partitions:
    the limited plan returns exactly the sorted prefix (with tie-break)."""
    import numpy as np
    rng = np.random.default_rng(9)
    rows = [("hot", float(v), i) for i, v in enumerate(rng.integers(0, 20, 5000))]
    rows += [(f"k{i % 7}", float(v), 10_000 + i) for i, v in enumerate(rng.integers(-5, 5, 300))]
    df = spark.createDataFrame(rows, "label string, value double, id long").repartition(13)
    got = {}
    for r in extremes.k_largest(df, "label", "value", 6, tiebreak=["id"]).collect():
        got.setdefault(r["label"], []).append((r["rank"], r["value"]))
    for lab in {r[0] for r in rows}:
        vals = sorted(((-v, i) for l2, v, i in rows if l2 == lab))[:6]
        assert sorted(got[lab]) == [(n + 1, -v) for n, (v, _) in enumerate(vals)]
    small = {}
    for r in extremes.j_smallest(df, "label", "value", 4, tiebreak=["id"]).collect():
        small.setdefault(r["label"], []).append(r["value"])
    assert sorted(small["hot"]) == [0.0] * 4
