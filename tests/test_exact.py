"""Exact sums against math.fsum and big integers, exact ranks against sorting."""

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from mergestat.functions import float_parts as fp
from mergestat.operators import exact
from mergestat.plans.catalog import BATCH_QUERIES
from mergestat.plans.compare import plan_text
from mergestat.plans.oracle import build
from tests.conftest import SF01
from tests.oracle_harness import duck

BIG = 2 ** 60


def wild(r):
    """Doubles of every size, powers of two and their neighbours among them."""
    kind = r.random()
    if kind < .5:
        v = struct.unpack("d", struct.pack("Q", r.getrandbits(64)))[0]
        return v if not math.isnan(v) else 0.0
    if kind < .6:
        return r.choice([0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, -1.7976931348623157e308])
    if kind < .8:
        return math.ldexp(r.choice([1.0, -1.0]), r.randint(-1074, 1023))
    return math.nextafter(math.ldexp(1.0, r.randint(-1021, 1023)), r.choice([0, math.inf]))


def test_parts_and_digits_of_doubles(spark):
    r = random.Random(1)
    vs = [wild(r) for _ in range(6000)] + [math.inf, -math.inf]
    df = spark.createDataFrame([(v,) for v in vs], "v double")
    e = fp.exponent(F.col("v"))
    m = fp.mantissa(F.col("v"), e)
    rows = df.select("v", e.alias("e"), m.alias("m"), F.array(*fp.lanes(m)).alias("lanes"),
                     F.array(*fp.ordered_digits(F.col("v"))).alias("d")).collect()
    for x in rows:
        if math.isfinite(x.v) and x.v:
            assert math.ldexp(x.m, x.e) == x.v
            assert sum(lane << (fp.LANE * k) for k, lane in enumerate(x.lanes)) == x.m
            assert all(0 <= d < 1 << bits for d, bits in zip(map(abs, x.d[1:]), (16, 15, 15)))
    rows.sort(key=lambda x: x.v)
    for a, b in zip(rows, rows[1:]):
        assert (a.v < b.v) == (a.d < b.d) and (a.v == b.v) == (a.d == b.d)


def rows_of(seed):
    r = random.Random(seed)
    out = []
    for k in (None, BIG, BIG + 1):
        out += [(k, v) for v in (wild(r) for _ in range(300)) if abs(v) < 1e300]
    for k in (3, 4):
        out += [(k, r.gauss(0, 1) * 10 ** r.randint(-8, 8)) for _ in range(500)]
    out += [(5, v) for v in (1e16, 1.0, -1e16, 1e-30) for _ in range(3)]
    r.shuffle(out)
    return out


def test_sums_are_rounded_once_in_any_order(spark):
    rows = rows_of(2)
    df = spark.createDataFrame(rows, "k long, v double")
    per = {k: [v for q, v in rows if q == k] for k in {k for k, _ in rows}}
    seen = set()
    for n in (1, 3, 11):
        got = {x.k: x for x in exact.exact_sum(df.repartition(n), "k", "v").collect()}
        for k, vs in per.items():
            assert got[k].sum == math.fsum(vs) and got[k].n == len(vs)
            assert got[k].mean == float(sum(map(Fraction, vs)) / len(vs))
        seen.add(tuple(sorted(map(str, got.values()))))
    assert len(seen) == 1


def test_sum_of_parts_is_the_sum(spark):
    rows = rows_of(3)
    df = spark.createDataFrame(rows, "k long, v double").withColumn("p", F.pmod(F.hash("v"), F.lit(4)))
    whole = sorted(map(str, exact.exact_sum(df, "k", "v").collect()))
    parts = exact.sum_states(df.where("p = 0"), "k", "v")
    for p in (1, 2, 3):
        parts = exact.merge_sums(parts.unionByName(exact.sum_states(df.where(f"p = {p}"), "k", "v")), "k")
    assert sorted(map(str, exact.exact_totals(parts, "k").collect())) == whole


def test_odd_values_of_sums(spark):
    nan, inf = math.nan, math.inf
    given = {1: [None], 2: [nan, 1.0], 3: [inf, 1.0], 4: [inf, -inf], 5: [-inf], 6: [1.7e308] * 3, 7: [0.0, -0.0], 8: [5e-324] * 2}
    df = spark.createDataFrame([(k, v) for k, vs in given.items() for v in vs], "k long, v double")
    got = {x.k: (x.n, x.sum) for x in exact.exact_sum(df, "k", "v").collect()}
    assert got.pop(2)[1] != got.get(2) and math.isnan(exact.exact_sum(df.where("k = 2"), "k", "v").first()["sum"])
    assert math.isnan(got.pop(4)[1])
    assert got == {1: (0, None), 3: (2, inf), 5: (1, -inf), 6: (3, inf), 7: (2, 0.0), 8: (2, 1e-323)}
    assert exact.exact_sum(df.limit(0), "k", "v").count() == 0


@pytest.mark.parametrize("name", ["exact_sum", "exact_batch_sum"])
def test_sums_equal_sql_to_the_last_bit(spark, name):
    df = BATCH_QUERIES[name](spark, SF01)
    con = duck(SF01)
    cols = ", ".join(sorted(df.columns))
    want = con.sql(f"SELECT {cols} FROM ({build()[name]})").fetchall()
    got = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) > 4


def median(vs):
    return sorted(vs)[len(vs) // 2] if vs else None


def test_median_is_the_sorted_one(spark):
    r = random.Random(4)
    rows = rows_of(5) + [(9, None), (10, math.nan), (10, 1.0), (11, math.inf), (11, -math.inf), (12, 0.0), (12, -0.0)]
    rows += [(13, 1.0 + k * 2.0 ** -52) for k in range(99)]                  # differ in the last places only
    rows += [(14, r.choice([1.5, 2.5])) for _ in range(99)]
    df = spark.createDataFrame(rows, "k long, v double")
    got = {x.k: (x.n, x.median) for x in exact.exact_median(df, "k", "v").collect()}
    for k in {k for k, _ in rows}:
        vs = [v for q, v in rows if q == k and v is not None and not math.isnan(v)]
        assert got[k] == (len(vs), median(vs))
    assert exact.exact_median(df.limit(0), "k", "v").count() == 0


def test_other_ranks_and_several_keys(spark):
    rows = [(k % 2, "x" if k % 3 else None, float(k * 7919 % 1000)) for k in range(1000)]
    df = spark.createDataFrame(rows, "a int, b string, v double")
    got = {(x.a, x.b): x["value"] for x in exact.select_rank(df, ["a", "b"], "v", lambda n: F.floor(n * 0.9)).collect()}
    for a, b in got:
        vs = sorted(v for q, s, v in rows if (q, s) == (a, b))
        assert got[a, b] == vs[int(len(vs) * 0.9)]
    assert all(x["value"] is None for x in exact.select_rank(df, "a", "v", lambda n: n).collect())


def test_no_values_meet_in_one_place(spark, monkeypatch):
    """One key with all rows: what is shuffled is counts, and keys may be too many to broadcast."""
    monkeypatch.setattr(exact, "BROADCAST_KEYS", 0)
    plans = []
    staged = exact._staged

    def keep(df, name):
        plans.append(plan_text(df))
        return staged(df, name)
    monkeypatch.setattr(exact, "_staged", keep)
    df = spark.range(30_000).select(F.lit("hot").alias("k"), F.rand(3).alias("v"))
    vs = [x.v for x in df.collect()]
    assert exact.exact_median(df, "k", "v").first()["median"] == median(vs)
    assert plans and not any("collect_list" in p or "percentile" in p for p in plans)
    assert all("partial_count" in p for p in plans if "Window" in p)
