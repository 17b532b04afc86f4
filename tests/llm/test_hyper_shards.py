import zlib
from collections import Counter

import numpy as np
from helpers import none, odd_docs, same_rows

from mergestat.llm import hyper_shards as hs
from mergestat.llm.queries import op9_hyper_shards


def lawful(rows, shards):
    sizes = Counter(r.shard for r in rows)
    n = len(rows)
    assert sorted(sizes.get(s, 0) for s in range(shards)) == sorted(n // shards + (s < n % shards) for s in range(shards))
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_matrix_has_exact_sums():
    blocks, shards = [5, 0, 17, 3, 100], [32, 31, 31, 31]
    m = hs.communication_matrix(blocks, shards, 3)
    assert m.sum(1).tolist() == blocks and m.sum(0).tolist() == shards and (m >= 0).all()


def test_large_populations_follow_the_same_law(monkeypatch):
    rng = np.random.default_rng(0)
    want = rng.hypergeometric(300, 500, 200, 20_000)
    monkeypatch.setattr(hs, "DRAWN_DIRECTLY", 50)
    got = np.array([hs.hypergeometric(rng, 300, 500, 200) for _ in range(20_000)])
    assert abs(got.mean() - want.mean()) < 0.25 and abs(got.var() / want.var() - 1) < 0.06


def test_odd_documents(spark):
    docs = odd_docs(spark)
    for shards, blocks in ((8, 512), (3, 4), (1, 1), (50, 8)):
        out = hs.shard(docs, shards, blocks=blocks)
        assert out.columns == [c for c in docs.columns if c not in ("shard", "slot")] + ["shard", "slot"]
        rows = out.collect()
        lawful(rows, shards)
        assert same_rows([(r.doc_id, r.text) for r in rows], [(r.doc_id, r.text) for r in docs.collect()])


def test_reruns_agree_and_seeds_differ(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "cast(id as string) as text")
    a, b = hs.shard(docs).collect(), hs.shard(docs.repartition(5)).collect()
    assert same_rows(a, b)
    assert not same_rows(a, hs.shard(docs, seed=1).collect())


def test_a_repeated_id_spreads_over_blocks(spark, monkeypatch):
    sizes = []
    draw = hs.communication_matrix
    monkeypatch.setattr(hs, "communication_matrix", lambda b, *more: sizes.append(b) or draw(b, *more))
    docs = spark.range(6000).selectExpr(
        "case when id % 3 = 0 then 7 when id % 3 = 1 then null else id end as doc_id", "if(id % 3 = 0, 't', cast(id as string)) as text")
    rows = hs.shard(docs, 8, blocks=64).collect()
    lawful(rows, 8)
    assert same_rows([(r.doc_id, r.text) for r in rows], [(r.doc_id, r.text) for r in docs.collect()])
    assert len(sizes[0]) == 64 and max(sizes[0]) < 2 * 6000 / 64
    # the hot id's 2,000 rows are spread over shards and slots as any others
    hits = np.zeros((8, 10))
    for r in rows:
        if r.doc_id == 7:
            hits[r.shard, r.slot // 75] += 1
    assert ((hits - 25) ** 2 / 25).sum() < 130


WORKING = ("id", "block", "at", "key", "piece", "tie", "salt", "of", "below", "hot", "of_shard", "of_piece", "start", "rank",
           "p", "n", "often", "part", "own", "count")


def test_columns_of_every_working_name_survive(spark):
    names = ["doc_id", "text", "count", *[f"__{c}" for c in WORKING]]
    docs = spark.createDataFrame([(i % 7, f"t{i}", i % 3, *[f"{i}-{c}" for c in WORKING]) for i in range(60)], names)
    for blocks in (2, 64):
        rows = hs.shard(docs, 4, blocks=blocks).collect()
        lawful(rows, 4)
        assert same_rows([tuple(r)[:-2] for r in rows], docs.collect())


def test_equal_ids_with_other_texts_in_any_order(spark):
    """Whole rows get the same places however the input is dealt."""
    docs = spark.range(4000).selectExpr("case when id % 4 = 0 then null when id % 4 = 1 then 9 else id % 50 end as doc_id",
                                        "if(id % 4 < 2, 'same', cast(id as string)) as text", "cast(id % 5 as int) as more")
    a = hs.shard(docs.repartition(7, "text"), 8, blocks=32)
    b = hs.shard(docs.orderBy("more", "text").coalesce(3), 8, blocks=32)
    assert same_rows(a.collect(), b.collect())
    lawful(a.collect(), 8)


def test_the_shuffle_is_uniform(spark):
    docs = spark.range(8000).selectExpr("id as doc_id", "'t' as text")
    rows = hs.shard(docs, 4, blocks=16).collect()
    hits = np.zeros((8, 16))
    for r in rows:
        hits[r.doc_id // 1000, r.shard * 4 + r.slot * 4 // 2000] += 1
    assert ((hits - 62.5) ** 2 / 62.5).sum() < 180   # 105 degrees of freedom


def test_empty_table(spark):
    assert hs.shard(none(odd_docs(spark))).collect() == []


def test_query(spark):
    import pandas as pd
    sf = "/root/testdata/sf0.001"
    rows = op9_hyper_shards(spark, sf).collect()
    lawful(rows, 8)
    d = pd.read_parquet(f"{sf}/documents.parquet")
    want = [(i, len(t.encode()) + 1, zlib.crc32(t.encode()), "rows", None) for i, t in zip(d.doc_id, d.text)]
    assert same_rows([(r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in rows], want)
