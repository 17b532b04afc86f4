"""Codes against plain integer k-means, and the bounds against all distances."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mergestat.llm import part_codes as pc
from mergestat.llm.queries import op12_part_codes
from tests.conftest import SF001, SF01

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, __q int, near int, label_error string"


def plain(rows, parts=16, entries=64, rounds=2):
    """Codes and errors of (id, vector) rows, and the codebooks, measuring everything."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return {}, np.zeros((parts, 0, 0), int)
    x = np.array([v for _, v in kept]).reshape(len(kept), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def assign():
        return np.stack([((x[:, p, None] - books[p][None]) ** 2).sum(2).argmin(1) for p in range(parts)], 1)

    for _ in range(rounds):
        code = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[code[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(0) // len(mine)
    code = assign()
    error = sum(((x[:, p] - books[p][code[:, p]]) ** 2).sum(1) for p in range(parts))
    return [(i, bytes(c.tolist()), int(e)) for (i, _), c, e in zip(kept, code, error)], books


def test_bounds_hold_and_settle_most(rng=np.random.default_rng(1)):
    needed = []
    for _ in range(60):
        k, w, n, size = int(rng.integers(1, 70)), int(rng.integers(1, 5)), int(rng.integers(1, 200)), int(rng.choice([2, 20, 300, 100000]))
        x, book = rng.integers(-size, size + 1, (n, w)), rng.integers(-size, size + 1, (k, w))
        got = pc.measure_all(x, book, min(k, max(2, round(k / 8))))
        for _ in range(4):
            first, least, near, low, outer = got[:5]
            d = ((x[:, None] - book[None]) ** 2).sum(2)
            assert (first == d.argmin(1)).all() and (least == d.min(1)).all()
            low, outer = pc._down(low).astype(float), pc._down(outer).astype(float)
            bounds = np.column_stack([np.zeros(n), low])
            for e in range(k):
                listed = (near == e).any(1)
                bound = np.where(listed, np.where(near == e, bounds, np.inf).min(1), outer if k > near.shape[1] else 0)
                assert (bound <= np.sqrt(d[:, e]) + 1e-9).all()
            new = book + rng.integers(-max(1, size // 8), max(1, size // 8) + 1, (k, w)) * (rng.random((k, 1)) < .3)
            moved, book = np.sqrt(((new - book) ** 2).sum(1).astype(float)) * (1 + pc.GUARD), new
            got = pc.measure_some(x, book, moved, near, low, outer)
            needed += (got[5] / k).tolist() if k > 30 else []
    assert np.mean(needed) < 0.5


def test_b_follows_need():
    assert pc._adapted(np.array([1] * 99 + [60]), 64) == pc.LEAST
    assert pc._adapted(np.array([9] * 100), 64) == 9
    assert pc._adapted(np.array([60] * 100), 64) == 16
    assert pc._adapted(np.array([5] * 9), 2) == 2


def rows_of(rng, n, dim=32):
    base = rng.normal(size=(n, dim)).astype(np.float32)
    base[n // 2:] = base[: n - n // 2]                              # repeated vectors
    rows = [(k // 2 if k % 7 == 0 else k, [float(x) for x in v], k % 3 or None) for k, v in enumerate(base)]
    bad = [float("nan"), float("inf"), float("-inf"), None]
    rows += [(500 + k, [0.5] * (dim - 1) + [b], 1) for k, b in enumerate(bad)] + [(600, None, 1), (None, [0.0] * dim, None), (601, [0.0] * dim, 9)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lb, "c", "e", 1, 2, "l") for i, v, lb in rows], SCHEMA)


@pytest.mark.parametrize("n", [1, 3, 40, 400])
def test_codes_are_those_of_plain_k_means(spark, n):
    rows = rows_of(np.random.default_rng(n), n)
    vectors = frame(spark, rows).repartition(5)
    coded, books = pc.encode(vectors, entries=16 if n > 3 else 64)
    want, expected = plain([(i, v) for i, v, _ in rows], entries=16 if n > 3 else 64)
    assert (books.entries == expected).all()
    got = [(r["vec_id"], bytes(r["code"]), r["error"]) for r in coded.collect()]
    def order(r):
        return r[0] is None, r[0] or 0, r[1:]
    assert sorted(got, key=order) == sorted(want, key=order)
    assert set(coded.columns) == set(vectors.columns) - {"embedding"}
    totals = pc.label_totals(coded)
    assert set(totals.columns) == set(coded.columns)
    sums = {}
    labels = [lb for i, v, lb in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for r in totals.collect():
        sums.setdefault(r["label"], [r["label_error"], 0])[1] += r["error"]
    assert totals.count() == len(labels) and set(sums) == set(labels) and all(a == b for a, b in sums.values())


def test_hot_labels_and_long_ones(spark, monkeypatch):
    monkeypatch.setattr(pc, "LABEL_BYTES", 0)
    df = spark.range(900).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("label"),
                                 F.col("id").alias("error"))
    want = {r["label"]: r["s"] for r in df.groupBy("label").agg(F.sum("error").alias("s")).collect()}
    got = pc.label_totals(df).collect()
    assert len(got) == 900 and all(r["label_error"] == want[r["label"]] for r in got)


def test_lengths_large_values_and_empty(spark):
    rows = [(1, [1.0] * 16, 1), (2, [3e38] * 16, 1), (3, [1.0] * 15, 1), (4, [], 1), (5, [-3e38] * 16, 1)]
    got = {r["vec_id"]: r for r in pc.encode(frame(spark, rows))[0].collect()}
    assert set(got) == {1, 2, 3, 4, 5} and got[3]["code"] is None and got[4]["error"] is None
    assert got[1]["error"] == got[2]["error"] == got[5]["error"] == 0
    with pytest.raises(ValueError):
        pc.encode(frame(spark, [(1, [1.0] * 15, 1)]))
    for rows in ([], [(1, None, 1)]):
        out, books = pc.encode(frame(spark, rows) if rows else frame(spark, [(1, None, 1)]).limit(0))
        assert pc.label_totals(out).count() == 0 and books.sha256 == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want, books = plain([(r["vec_id"], r["embedding"]) for r in table])
    got = op12_part_codes(spark, sf).collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in got) == sorted((i, c.hex(), e) for i, c, e in want)
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    assert {r["codebooks_sha256"] for r in got} == {sha}
