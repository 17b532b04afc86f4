"""State after every batch, against a plain computation over all earlier rows."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from mergestat.operators import distinct, history
from mergestat.operators.histogram import Bins

BIG = 2 ** 60


def rows(seed=3, batches=9):
    r = random.Random(seed)
    out = []
    for k in (BIG, BIG + 1, None, 7):
        for _ in range(25):
            b = r.choice([None, *range(2, batches)]) if k != 7 else r.randint(4, 5)
            out.append((k, r.choice([None, float("nan") if k == 7 else 1.5, *(round(r.uniform(-50, 50), 2) for _ in range(6))]), b))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "label long, value double, batch int")


def upto(data):
    """{(key, batch): values of all rows up to it} on the full grid."""
    known = [b for _, _, b in data if b is not None]
    out = {}
    for k in {k for k, _, _ in data}:
        mine = [(v, b) for key, v, b in data if key == k]
        early = any(b is None for _, b in mine)
        first = min(known) if early else min(b for _, b in mine)
        if early:
            out[k, None] = [v for v, b in mine if b is None]
        for b in range(first, max(known) + 1):
            out[k, b] = [v for v, x in mine if x is None or x <= b]
    return out


def got(df):
    return {(r["label"], r["batch"]): r for r in df.collect()}


def test_every_row_counts_in_every_statistic(spark):
    data = [d for d in rows() if d[1] is None or not math.isnan(d[1])]
    df, want = frame(spark, data), upto(data)
    total = got(history.history_sum(df, "label", "value", "batch"))
    mean = got(history.history_mean(df, "label", "value", "batch"))
    var = got(history.history_variance(df, "label", "value", "batch"))
    assert set(total) == set(mean) == set(var) == set(want)
    for key, values in want.items():
        vs = [v for v in values if v is not None]
        assert total[key]["n"] == mean[key]["n"] == var[key]["n"] == len(vs)
        if vs:
            assert total[key]["sum"] == pytest.approx(sum(vs))
            assert mean[key]["mean"] == pytest.approx(sum(vs) / len(vs))
            assert var[key]["variance"] == pytest.approx(statistics.pvariance(vs), abs=1e-9)
            assert var[key]["variance_sum_squares"] == pytest.approx(statistics.pvariance(vs), abs=1e-7)
    last = max(b for _, b in want if b is not None)
    assert sum(total[k, b]["n"] for k, b in total if b == last) == sum(v is not None for _, v, _ in data)


def test_extremes(spark):
    data = rows()
    want = upto(data)
    found = {}
    for r in history.history_extremes(frame(spark, data), "label", "value", "batch", 4, 3).collect():
        found.setdefault((r["label"], r["batch"], r["side"]), []).append((r["rank"], r["value"]))
    expected = {}
    for (k, b), values in want.items():
        vs = sorted(v for v in values if v is not None and not math.isnan(v))
        for side, top in (("largest", vs[::-1][:4]), ("smallest", vs[:3])):
            if top:
                expected[k, b, side] = list(enumerate(top, 1))
    assert {k: sorted(v) for k, v in found.items()} == expected


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_distinct_counts(spark, method):
    data = rows()
    df, want = frame(spark, data), upto(data)
    found = got(history.history_hll(df, "label", "value", "batch", 16, method))
    assert set(found) == set(want)
    for key, values in want.items():
        one = spark.createDataFrame([(v,) for v in values], "value double").withColumn("k", F.lit(1))
        e = distinct.hll_distinct(one, "k", "value", 16, method).collect()
        assert found[key]["n"] == (e[0]["n"] if e else 0)
        assert found[key]["estimate"] == pytest.approx(e[0]["estimate"] if e else 0.0)


def test_histogram(spark):
    data = rows(5)
    bins = Bins(edges=[-40.0, -10.0, 0.0, 5.0, 30.0])
    found = got(history.history_histogram_median(frame(spark, data), "label", "value", "batch", bins))
    for key, values in upto(data).items():
        vs = sorted(v for v in values if v is not None and not math.isnan(v))
        assert found[key]["n"] == len(vs)
        if vs:
            mid = vs[len(vs) // 2]
            want = next(((a + b) / 2 for a, b in zip(bins.edges, bins.edges[1:]) if a <= mid < b), None)
            assert found[key]["median_estimate"] == want


def test_only_rows_without_a_batch(spark):
    df = frame(spark, [(1, 2.0, None), (1, 3.0, None)])
    assert [tuple(r) for r in history.history_sum(df, "label", "value", "batch").collect()] == [(1, None, 2, 5.0)]
    assert history.history_sum(frame(spark, []), "label", "value", "batch").collect() == []


def test_dates_are_snapped_to_the_step(spark):
    days = [dt.date(2024, 1, 3), dt.date(2024, 1, 17), dt.date(2024, 3, 31), None]
    df = spark.createDataFrame([(1, float(i), d) for i, d in enumerate(days)], "label long, value double, batch date")
    week = history.history_sum(df, "label", "value", "batch", step="1 week").orderBy("batch").collect()
    assert week[0]["batch"] is None and [r["batch"].weekday() for r in week[1:]] == [0] * (len(week) - 1)
    assert (week[1]["batch"], week[-1]["batch"], week[-1]["n"]) == (dt.date(2024, 1, 1), dt.date(2024, 3, 25), 4)
    month = history.history_sum(df, "label", "value", "batch", step="2 months").orderBy("batch").collect()
    assert [(r["batch"], r["n"]) for r in month] == [(None, 1), (dt.date(2024, 1, 1), 3), (dt.date(2024, 3, 1), 4)]
    with pytest.raises(ValueError):
        history.history_sum(df, "label", "value", "batch", step="5 minutes")
    with pytest.raises(TypeError):
        history.history_sum(df.withColumn("t", F.col("batch").cast("timestamp")), "label", "value", "t")


@pytest.mark.parametrize("fold", [2, 3, 256])
def test_extremes_of_long_histories_keep_whole_numbers(spark, monkeypatch, fold):
    monkeypatch.setattr(history, "FOLD", fold, raising=False)
    r = random.Random(8)
    data = [(k, r.choice([None, *(2 ** 60 + r.randint(-40, 40) for _ in range(6))]), r.choice([None, *range(20)]))
            for k in (BIG, BIG, BIG, None, 7) for _ in range(25)]
    df = spark.createDataFrame(data, "label long, value long, batch int")
    out = {}
    for row in history.history_extremes(df, "label", "value", "batch", 4, 3).collect():
        out.setdefault((row["label"], row["batch"], row["side"]), []).append((row["rank"], row["value"]))
    want = {}
    for (key, batch), values in upto(data).items():
        vs = sorted(v for v in values if v is not None)
        for side, best in (("largest", vs[::-1][:4]), ("smallest", vs[:3])):
            if best:
                want[key, batch, side] = list(enumerate(best, 1))
    assert {c: sorted(v) for c, v in out.items()} == want


def test_integer_batches_far_apart(spark, monkeypatch):
    """Gaps longer than an array may be: whole stretches are filled in; none where nothing lies between."""
    monkeypatch.setattr(history, "STRETCH", 7)
    rows = [("a", 0, 1.0), ("a", 40, 2.0), ("b", 3, 5.0), ("b", None, 7.0), ("c", 41, 1.5)]
    df = spark.createDataFrame(rows, "k string, batch long, v double")
    got = sorted((r["k"], r["batch"], r["n"], r["sum"]) for r in history.history_sum(df.where("batch is not null"), "k", "v", "batch").collect())
    want = [("a", b, 1 + (b >= 40), 1.0 + 2.0 * (b >= 40)) for b in range(42)] + [("b", b, 1, 5.0) for b in range(3, 42)] + [("c", 41, 1, 1.5)]
    assert got == want
    both = {(r["batch"], r["n"], r["sum"]) for r in history.history_sum(df, "k", "v", "batch").where("k = 'b'").collect()}
    assert both == {(None, 1, 7.0)} | {(b, 1 + (b >= 3), 7.0 + 5.0 * (b >= 3)) for b in range(42)}
    monkeypatch.setattr(history, "STRETCH", 1 << 16)
    far = spark.createDataFrame([("a", 5_000_000_000, 1.0), ("a", 5_000_000_001, 2.0)], "k string, batch long, v double")
    assert [r["sum"] for r in history.history_sum(far, "k", "v", "batch").orderBy("batch").collect()] == [1.0, 3.0]


def test_histogram_history_has_mean_and_bins(spark):
    from mergestat.operators.histogram import Bins
    rows = [("a", 1, 1.0), ("a", 1, 12.0), ("a", 2, None), ("a", 3, float("nan")), ("a", 4, 3.0), ("b", 2, 7.0)]
    df = spark.createDataFrame(rows, "k string, batch int, v double")
    got = {(r["k"], r["batch"]): (r["n"], r["mean"], r["counts"]) for r in
           history.history_histogram_median(df, "k", "v", "batch", Bins(0.0, 10.0, 2)).collect()}
    assert got[("a", 1)] == (2, 6.5, [0, 1, 0, 1]) and got[("a", 3)] == (2, 6.5, [0, 1, 0, 1])
    assert got[("a", 4)] == (3, 16 / 3, [0, 2, 0, 1]) and got[("b", 4)] == (1, 7.0, [0, 0, 1, 0])
