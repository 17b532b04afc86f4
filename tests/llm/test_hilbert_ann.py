import math
import os

import numpy as np
import pytest
from helpers import same_rows
from pyspark.sql import functions as F

from mergestat.llm import hilbert_ann as ha
from mergestat.llm.queries import op4_hilbert_ann

SCHEMA = "vec_id long, embedding array<float>, cid string, rank int, score string"


def slow(rows, k=10, every=100):
    """{(query, rank): (id, distance)} over usable rows."""
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in {i for i, _ in ok if i % every == 0}:
        best = {}
        for i, v in ok:
            if i != q:
                d = [math.dist(v, w) for j, w in ok if j == q and len(w) == len(v)]
                if d:
                    best[i] = min(best.get(i, math.inf), min(d))
        for rank, (d, i) in enumerate(sorted((d, i) for i, d in best.items())[:k], 1):
            out[q, rank] = (i, d)
    return out


def equal(got, want):
    assert {(r.query_id, r["rank"]): r.vec_id for r in got} == {k: v[0] for k, v in want.items()}
    assert all(abs(r.score - want[r.query_id, r["rank"]][1]) < 1e-9 for r in got)


def test_the_curve_visits_every_cell_once_and_moves_one_step():
    for axes, bits in ((1, 3), (2, 3), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        place = ha.hilbert(grid, bits)
        assert sorted(place.tolist()) == list(range(len(grid)))
        path = grid[np.argsort(place)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_odd_vectors(spark, kind):
    r = np.random.default_rng(0)
    rows = [(k, [float(x) for x in np.float32(r.standard_normal(8))]) for k in range(60)]
    same = rows[3][1]
    rows += [(k, same) for k in range(300, 340)] + [(400, same), (400, same), (500, same)]
    rows += [(600, None), (601, []), (602, [0.0] * 8), (603, [1.0, None] + [0.0] * 6), (700, [float("nan")] * 8),
             (800, [float("inf")] + [0.0] * 7), (None, rows[0][1]), (900, [1.0, 2.0]), (901, [2.0, 1.0]), (1000, [5.0]),
             (100, rows[7][1]), (100, rows[8][1])]
    df = spark.createDataFrame([(i, v, "c", 1, None) for i, v in rows], SCHEMA.replace("float", kind))
    equal(ha.search(df, F.col("id") % 100 == 0).collect(), slow(rows))


def test_empty_table(spark):
    assert ha.search(spark.createDataFrame([], SCHEMA), F.col("id") % 100 == 0).collect() == []


def test_ties_go_to_the_smaller_id(spark):
    rows = [(0, [1.0, 0.0])] + [(k, [1.0 + (-1) ** k, 0.5]) for k in range(1, 31)]
    equal(ha.search(spark.createDataFrame([(i, v, "c", 1, None) for i, v in rows], SCHEMA), F.col("id") == 0).collect(),
          {k: v for k, v in slow(rows).items() if k[0] == 0})


def recall(spark, path, every):
    df = spark.read.parquet(path)
    got = {}
    for r in ha.search(df, F.col("id") % every == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    d = df.toPandas()
    x, ids = np.stack(d.embedding).astype(float), d.vec_id.to_numpy()
    hit = total = 0
    for q, found in got.items():
        dist = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        dist[ids == q] = np.inf
        best = set(ids[np.lexsort((ids, dist))[:10]].tolist())
        hit += len(best & {v for _, v, _ in found})
        total += len(best)
        assert [k for k, _, _ in sorted(found)] == list(range(1, 11))
        assert all(abs(s - dist[ids == v][0]) < 1e-9 for _, v, s in found)
    return hit / total


def test_recall(spark):
    assert recall(spark, "/root/testdata/sf0.1/embeddings.parquet", 10) >= 0.95
    for name, every in (("check_s", 200), ("check_l", 500)):
        path = f"/root/testdata/{name}/embeddings.parquet"
        if os.path.exists(path):
            assert recall(spark, path, every) >= 0.95


def found_share(x, rows, every=40):
    """Share of the true 10 nearest that the collected ``rows`` hold; ids are places in ``x``."""
    got = {}
    for r in rows:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    asked = range(0, len(x), every)
    hit = 0
    for q in asked:
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hit += len(got.get(q, set()) & set(np.argsort(d)[:10].tolist()))
    return hit / (10 * len(asked))


def clustered(n, noise, far=1.0, seed=0):
    """Directions of which each third row lies close to one vector."""
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[::3] = far * x[0] + noise * r.standard_normal((len(x[::3]), 64)) / 8
    return x.astype(np.float32).astype(float)


@pytest.mark.parametrize("noise, far", [(1e-2, 1.0), (1e-4, 1.0), (1e-4, 30.0)])
def test_recall_within_a_dense_cluster(spark, noise, far):
    x = clustered(6000, noise, far)
    df = spark.createDataFrame([(i, v.tolist(), "c", 1, None) for i, v in enumerate(x)], SCHEMA)
    assert found_share(x, ha.search(df, F.col("id") % 40 == 0).collect()) >= 0.95


def test_windows_are_whole_whatever_the_partitions(spark, monkeypatch):
    x = clustered(3000, 1e-3, seed=3)
    df = spark.createDataFrame([(i, v.tolist(), "c", 1, None) for i, v in enumerate(x)], SCHEMA)
    scale = []
    monkeypatch.setattr(ha, "_scales", lambda classes, f=ha._scales: scale.append(f(classes)) or scale[-1])

    def run(parts, curves, half):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            return ha.search(df, F.col("id") % 40 == 0, curves=curves, half=half).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)

    def uncut(curves, half):
        keys = ha.curve_keys(x, np.arange(len(x)), *scale[-1][64], curves, ha.SEED, "<f4")
        out = {}
        for q in range(0, len(x), 40):
            seen = set()
            for c in range(curves):
                order = np.argsort(np.ascontiguousarray(keys[:, c]).view(f"S{keys.shape[2]}").ravel())
                i = int(np.flatnonzero(order == q)[0])
                lo = max(0, min(i - half, len(x) - 2 * half - 1))
                seen |= set(order[lo:lo + 2 * half + 1].tolist())
            seen = np.array(sorted(seen - {q}))
            d = np.sqrt(((x[seen] - x[q]) ** 2).sum(1))
            for rank, j in enumerate(np.lexsort((seen, d))[:10], 1):
                out[q, rank] = int(seen[j])
        return out

    for rows, curves, half, parts in ((4000, 6, 100, 400), (200, 6, 20, 4), (200, 6, 20, 97), (1, 3, 1, 4)):
        monkeypatch.setattr(ha, "BLOCK_ROWS", rows, raising=False)
        got = {(r.query_id, r["rank"]): r.vec_id for r in run(parts, curves, half)}
        assert got == uncut(curves, half), (rows, half, parts)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r)[:2] for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = op4_hilbert_ann(spark, sf).collect()
    want = slow(rows)
    assert same_rows([(r.query_id, r["rank"]) for r in got], list(want))
    assert len([r for r in got if want[r.query_id, r["rank"]][0] == r.vec_id]) >= 0.9 * len(want)
