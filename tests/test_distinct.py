"""HyperLogLog registers and estimates."""

import math

import pytest
from pyspark.sql import functions as F

from mergestat.operators import distinct


def test_million_strings_within_three_sigma(spark):
    df = spark.range(1_000_000).select(F.lit("HLL").alias("label"),
                                       F.col("id").cast("string").alias("value"))
    r = distinct.hll_distinct(df, "label", "value", 64).collect()[0]
    assert abs(r["estimate"] - 1_000_000) / 1_000_000 < 3 * 1.04 / math.sqrt(64)
    assert r["n"] == 1_000_000


def test_wide_and_long_forms_agree(spark):
    df = spark.range(5000).select((F.col("id") % 3).cast("string").alias("label"),
                                  (F.col("id") * 7919 % 1201).alias("value"))
    long = distinct.hll_registers(df, "label", "value", 64)
    est = {r["label"]: r["estimate"] for r in distinct.hll_estimate(long, "label", 64).collect()}
    wide = distinct.hll_registers_wide(df, "label", "value", 64)
    w = {r["label"]: r for r in wide.select(
        "label", "registers", distinct.estimate_from_array(F.col("registers"), 64).alias("e"))
        .collect()}
    for r in long.collect():
        assert w[r["label"]]["registers"][r["register"]] == r["rank"]
    for k, e in est.items():
        assert abs(w[k]["e"] - e) < 1e-9


def test_small_cardinality_uses_linear_counting(spark):
    df = spark.createDataFrame([("k", str(i)) for i in range(10)], "label string, value string")
    r = distinct.hll_distinct(df, "label", "value", 64).collect()[0]
    assert r["empty_registers"] > 0
    assert r["estimate"] == 64 * math.log(64 / r["empty_registers"])
    assert abs(r["estimate"] - 10) < 3


def test_rank_all_zero_upper_bits(spark):
    from mergestat.functions.hashing import rank_of, register_of
    df = spark.createDataFrame([(0,), (64,), (1 << 10,), (5,)], "h long")
    out = df.select(register_of(F.col("h"), 6).alias("r"), rank_of(F.col("h"), 6).alias("k")).collect()
    assert [(x["r"], x["k"]) for x in out] == [(0, 27), (0, 1), (0, 5), (5, 27)]


def test_xxhash_method_runs(spark):
    df = spark.range(2000).select(F.lit("a").alias("label"), F.col("id").alias("value"))
    r = distinct.hll_distinct(df, "label", "value", 64, method="xxhash64").collect()[0]
    assert abs(r["estimate"] - 2000) / 2000 < 0.4


def test_estimates_are_finite_for_full_registers(spark):
    for method, width in (("md5", 32), ("xxhash64", 64)):
        last = 0.0
        for rank in (5, 20, width - 7, width - 6, width - 5):
            regs = spark.createDataFrame([("k", i, rank, 1) for i in range(64)], "label string, register int, rank long, n long")
            e = distinct.hll_estimate(regs, "label", 64, method).first()["estimate"]
            arr = regs.groupBy("label").agg(F.collect_list("rank").alias("a")).select(
                distinct.estimate_from_array(F.col("a"), 64, method).alias("e")).first()["e"]
            assert math.isfinite(e) and e >= last and e == arr
            last = e
        assert last > 2 ** 31


def test_sixty_four_bits_reach_beyond_thirty_two(spark):
    from mergestat.functions.hashing import rank_of, register_of
    df = spark.createDataFrame([(-2 ** 63,), (0,), (-1,), (1 << 40,)], "h long")
    out = df.select(register_of(F.col("h"), 6).alias("r"), rank_of(F.col("h"), 6, 64).alias("k")).collect()
    assert [(x["r"], x["k"]) for x in out] == [(0, 58), (0, 59), (63, 1), (0, 35)]


def test_error_report_keeps_null_and_large_keys_in_one_scan(spark):
    from mergestat.plans.compare import plan_text
    big = 2 ** 60
    rows = [(k, v) for k in (big, big + 1, None) for v in range(40)] * 2 + [(big, None)]
    df = spark.createDataFrame(rows, "label long, value long")
    got = {r["label"]: r for r in distinct.hll_error_report(df, "label", "value", 64).collect()}
    assert set(got) == {big, big + 1, None}
    assert all((r["n"], r["exact"]) == (80, 40) and abs(r["rel_error"]) < 0.5 for r in got.values())
    from tests.conftest import SF001
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    plan = plan_text(distinct.hll_error_report(ev, "event_type", "user_id"), "simple")
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_library_sketch(spark):
    df = spark.range(3000).select(F.lit("a").alias("label"), F.col("id").alias("value"))
    r = distinct.distinct_sketch(df, "label", "value").collect()[0]
    assert abs(r["approx_distinct"] - 3000) / 3000 < 0.15
    assert abs(r["sketch_estimate"] - 3000) / 3000 < 0.1


def test_union_of_batch_sketches_equals_one_sketch(spark):
    """Merging per-batch sketches loses nothing against one sketch of all rows."""
    from tests.conftest import SF001
    from mergestat.sources.tables import table
    li = table(spark, SF001, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    merged = {r["l_returnflag"]: r for r in distinct.union_sketches(
        distinct.sketch_partials(li, "l_returnflag", "l_partkey", "day"), "l_returnflag").collect()}
    whole = {r["l_returnflag"]: r for r in distinct.distinct_sketch(li, "l_returnflag", "l_partkey").collect()}
    exact = {r["l_returnflag"]: r["c"] for r in
             li.groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("c")).collect()}
    for k, r in whole.items():
        assert merged[k]["sketch_estimate"] == r["sketch_estimate"]
        assert abs(merged[k]["sketch_estimate"] - exact[k]) / exact[k] < 0.05


def test_registers_against_python_md5(spark):
    """Register and rank of every value, recomputed with hashlib."""
    import hashlib
    from tests.conftest import SF001
    from mergestat.sources.tables import table
    ev = table(spark, SF001, "events")
    got = {(r["event_type"], r["register"]): r["rank"] for r in
           distinct.hll_registers(ev, "event_type", "user_id", 64).collect()}
    want = {}
    for r in ev.select("event_type", "user_id").where("user_id IS NOT NULL").collect():
        h = int(hashlib.md5(str(r["user_id"]).encode()).hexdigest()[:8], 16)
        reg, w = h & 63, h >> 6
        rank = 27 if w == 0 else (w & -w).bit_length()
        key = (r["event_type"], reg)
        want[key] = max(want.get(key, 0), rank)
    assert got == want


def test_likelihood_estimate_has_no_ranges(spark):
    """Errors within three standard errors over six orders of magnitude, for both hashes and several m."""
    sizes = [1, 2, 5, 20, 60, 100, 160, 200, 400, 1000, 30_000]
    df = spark.range(1, 1 + max(sizes)).select(F.explode(F.array(*[F.lit(n) for n in sizes])).alias("k"), F.col("id").alias("v")).where("v <= k")
    for m, method in ((64, "md5"), (1024, "xxhash64")):
        got = {r["k"]: r for r in distinct.hll_likelihood(df, "k", "v", m, method).collect()}
        for n in sizes:
            assert abs(got[n]["estimate"] - n) <= max(3 * 1.04 / math.sqrt(m) * n, 1.5), (n, m, method)
            assert got[n]["n"] == n


def test_likelihood_estimate_is_the_root_and_grows(spark):
    """The equation holds at the estimate; one more filled register never lowers it; ends are defined."""
    import random
    m, top = 64, 27
    r = random.Random(5)
    registers = [0] * m
    tables = [list(registers)]
    for _ in range(300):
        i = r.randrange(m)
        registers[i] = max(registers[i], min(top, 1 + int(r.expovariate(math.log(2)))))
        tables.append(list(registers))
    tables.append([top] * m)
    counts = [[t.count(k) for k in range(top + 1)] for t in tables]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(counts)], "i int, c array<bigint>")
    got = [x["e"] for x in df.select("i", distinct.likelihood_estimate(F.col("c"), m, top).alias("e")).orderBy("i").collect()]
    assert got[0] == 0.0 and got[-1] == distinct.LARGEST
    assert all(b >= a * (1 - 1e-12) for a, b in zip(got, got[1:]))
    for c, e in zip(counts[1:-1], got[1:-1]):
        x = e / m
        left = x * sum(c[k] * 2.0 ** -k for k in range(top))
        left += sum(c[k] * (1 - (y := x * 2.0 ** -min(k, top - 1)) / math.expm1(y)) for k in range(1, top + 1))
        assert left == pytest.approx(m - c[0], rel=1e-9)


def test_running_sketches_are_the_unions(spark):
    """After every batch, quiet ones left out: the union of all sketches so far, NULL keys among them."""
    rows = [((None, 2 ** 60, 2 ** 60 + 1)[i % 3], i % 600, (i * i) % 11) for i in range(3000)] + [(7, None, 3), (7, 1, 4)]
    df = spark.createDataFrame(rows, "k long, v long, b int")
    parts = distinct.sketch_partials(df, "k", "v", "b")
    got = {(r["k"], r["b"]): (r["n"], r["e"]) for r in distinct.running_sketches(parts, "k", "b")
           .select("k", "b", "n", F.hll_sketch_estimate("sketch").alias("e")).collect()}
    assert set(got) == {(k, b) for k, _, b in rows}
    for (k, b), (n, e) in got.items():
        seen = [v for q, v, c in rows if q == k and c <= b and v is not None]
        assert n == len(seen) and abs(e - len(set(seen))) <= max(1, 0.08 * len(set(seen)))
    assert all(r["sketch_in_bounds"] for r in distinct.running_sketch_report(df, "k", "v", "b").collect())
    assert distinct.running_sketches(parts.limit(0), "k", "b").count() == 0
