"""Sums, means and variances against the statistics module; merge laws."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from mergestat.functions.moments import merge_moments, variance_of
from mergestat.operators import moments

BIG = 2 ** 60


def data(seed=1):
    r = random.Random(seed)
    keys = [BIG, BIG + 1, None, 3]
    return [(r.choice(keys), r.choice([None, r.gauss(1e4, 3)]), r.choice("xyz")) for _ in range(400)] + [(9, 2.5, "x")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "label long, value double, part string")


def values(rows, key, part=None):
    return [v for k, v, p in rows if k == key and v is not None and (part is None or p in part)]


def test_moments_per_key(spark):
    rows = data()
    got = {r["label"]: r for r in moments.running_variances(frame(spark, rows), "label", "value").collect()}
    assert set(got) == {k for k, _, _ in rows}
    for k, r in got.items():
        vs = values(rows, k)
        assert r["n"] == len(vs) and r["mean"] == pytest.approx(statistics.fmean(vs))
        assert r["variance"] == pytest.approx(statistics.pvariance(vs), rel=1e-9, abs=1e-12)
        assert r["stddev"] == pytest.approx(statistics.pstdev(vs), rel=1e-9, abs=1e-9)
        assert r["variance_sum_squares"] == pytest.approx(statistics.pvariance(vs), abs=1e-5)


def test_merge_of_parts_is_the_whole(spark):
    """Large, NULL and one-sided keys: one merged row each."""
    rows = data(2) + [(11, 4.0, "y"), (12, None, "x"), (13, None, "y")]
    df = frame(spark, rows)
    a = moments.running_variance(df.where("part = 'x'"), "label", "value")
    b = moments.running_variance(df.where("part <> 'x'"), "label", "value")
    got = moments.pairwise_merge(a, b, "label").collect()
    assert len(got) == len({k for k, _, _ in rows})
    for r in got:
        vs = values(rows, r["label"])
        assert r["n"] == len(vs)
        if vs:
            assert r["mean"] == pytest.approx(statistics.fmean(vs))
            assert r["variance"] == pytest.approx(statistics.pvariance(vs), rel=1e-9, abs=1e-12)
        else:
            assert r["mean"] is None and r["variance"] is None


def test_merge_moments_is_associative_with_identity(spark):
    rows = [(2, 1.5, 3.0), (0, None, None), (5, -2.0, 0.5), (1, 1e6, 0.0)]
    df = spark.createDataFrame([(rows,)], "s array<struct<n:long,mean:double,m2:double>>")
    left = F.reduce("s", F.col("s")[1], merge_moments)
    right = F.reduce(F.reverse("s"), F.col("s")[1], lambda a, b: merge_moments(b, a))
    r = df.select(left.alias("l"), right.alias("r"), variance_of(left).alias("v")).first()
    assert r["l"]["n"] == r["r"]["n"] == 8
    assert tuple(r["l"]) == pytest.approx(tuple(r["r"]))
    assert r["v"] == pytest.approx(r["l"]["m2"] / 8)


def test_sum_per_batch_and_in_all(spark):
    rows = data(4)
    df = frame(spark, rows)
    per = {(r["batch"], r["label"]): r["sum"] for r in moments.batch_sum(df, "label", "value", "part").collect()}
    for (p, k), s in per.items():
        vs = values(rows, k, p)
        assert s is None if not vs else s == pytest.approx(sum(vs))
    total = {r["label"]: r["sum"] for r in moments.running_sum(df, "label", "value").collect()}
    assert total == pytest.approx({k: sum(values(rows, k)) for k in {k for k, _, _ in rows}})


def test_nulls_ignored_and_nan_propagates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", float("nan")),
                                ("c", None)], "label string, value double")
    r = {x["label"]: x for x in moments.running_variance(df, "label", "value").collect()}
    assert r["a"]["n"] == 2 and r["a"]["mean"] == 2.0 and r["a"]["variance"] == 1.0
    assert math.isnan(r["b"]["mean"])
    assert r["c"]["n"] == 0 and r["c"]["variance"] is None


def test_variance_from_partials_equals_direct(spark):
    from tests.conftest import SF001
    from mergestat.sources.tables import events_stream_view, table
    ev = events_stream_view(table(spark, SF001, "events"))
    parts = moments.moment_partials(ev, "label", "value", "batch")
    merged = {r["label"]: r for r in moments.variance_from_partials(parts, "label").collect()}
    direct = {r["label"]: r for r in moments.running_variance(ev, "label", "value").collect()}
    for k, d in direct.items():
        assert merged[k]["n"] == d["n"]
        assert merged[k]["variance"] == pytest.approx(d["variance"], rel=1e-9)


def _higher(vs):
    n = len(vs)
    mu = math.fsum(vs) / n
    m = [math.fsum((v - mu) ** p for v in vs) for p in (2, 3, 4)]
    spread = m[0] > 0
    return (n, mu, m[0] / n, math.sqrt(n) * m[1] / m[0] ** 1.5 if spread else None, n * m[2] / m[0] ** 2 - 3 if spread else None)


def _close(got, want):
    assert got[0] == want[0]
    for g, w in zip(got[1:], want[1:]):
        assert (g is None and w is None) or g == pytest.approx(w, rel=1e-7, abs=1e-9)


def test_higher_moments_merge_at_every_split(spark):
    """Two halves of one sequence, cut at every place, merge into the whole: as
    expressions on literal states, by tables and from any number of parts."""
    r = random.Random(8)
    vs = [r.choice([r.expovariate(0.02), r.gauss(500, 3), 7.0]) for _ in range(30)]
    rows = [(cut, cut <= i, v) for cut in range(len(vs) + 1) for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "cut int, late boolean, value double")
    sides = moments.higher_partials(df, "cut", "value", "late")
    a, b = (sides.where(F.col("batch") == late).drop("batch") for late in (False, True))
    for merged in (moments.pairwise_merge_higher(a, b, "cut"), moments.pairwise_merge_higher(b, a, "cut"),
                   moments.higher_from_partials(sides, "cut")):
        got = moments.shapes(merged, "cut").collect()
        assert len(got) == len(vs) + 1
        for x in got:
            _close(tuple(x)[1:], _higher(vs))


def test_higher_moments_of_flat_single_and_missing_values(spark):
    rows = [("flat", 1, 2.0), ("flat", 2, 2.0), ("one", 1, 5.0), ("none", 1, None), (None, 1, 1.0), (None, 2, 4.0), (None, 2, 5.0)]
    df = spark.createDataFrame(rows, "k string, batch int, value double")
    parts = moments.higher_partials(df, "k", "value", "batch")
    got = {x.k: tuple(x)[1:] for x in moments.shapes(moments.higher_from_partials(parts, "k"), "k").collect()}
    assert got["flat"] == (2, 2.0, 0.0, None, None) and got["one"] == (1, 5.0, 0.0, None, None) and "none" not in got
    _close(got[None], _higher([1.0, 4.0, 5.0]))
    empty = moments.pairwise_merge_higher(parts.where("k = 'none'").drop("batch"), parts.where("k = 'zzz'").drop("batch"), "k")
    assert [tuple(x) for x in moments.shapes(empty, "k").collect()] == [("none", 0, None, None, None, None)]


def test_higher_moments_are_well_conditioned(spark):
    r = random.Random(9)
    vs = [1e8 + r.expovariate(1) for _ in range(900)]
    df = spark.createDataFrame([(1, i % 7, v) for i, v in enumerate(vs)], "k int, batch int, value double")
    got = moments.shapes(moments.higher_from_partials(moments.higher_partials(df, "k", "value", "batch"), "k"), "k").first()
    want = _higher([v - 1e8 for v in vs])
    assert got["skewness"] == pytest.approx(want[3], rel=1e-4) and got["kurtosis"] == pytest.approx(want[4], rel=1e-4)
