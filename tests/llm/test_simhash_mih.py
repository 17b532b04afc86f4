import random

import numpy as np
import xxhash
from helpers import none, odd_docs, odd_rows, same_rows

from mergestat.llm import graph, simhash_mih
from mergestat.llm.queries import op8_simhash_mih


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, fps, distance=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    best = {}
    for i, x in enumerate(ids):
        if x is not None:
            best[find(i)] = min(best.get(find(i), x), x)
    return [best.get(find(i)) for i in range(len(ids))]


def test_fingerprint():
    for r in odd_rows():
        assert simhash_mih.fingerprint(r[1]) == slow_fingerprint(r[1])


def test_odd_documents(spark):
    rows = odd_rows()
    fps = [slow_fingerprint(r[1]) for r in rows]
    want = [(r[0], f, c) for r, f, c in zip(rows, fps, slow_components([r[0] for r in rows], fps))]
    got = simhash_mih.near_duplicates(odd_docs(spark)).collect()
    assert same_rows([(r.doc_id, r.fp % (1 << 64), r.component) for r in got], want)


def test_keep_one(spark):
    docs = odd_docs(spark)
    kept = simhash_mih.keep_one(docs)
    assert kept.columns == docs.columns
    rows = odd_rows()
    comp = slow_components([r[0] for r in rows], [slow_fingerprint(r[1]) for r in rows])
    got = kept.collect()
    assert {r.doc_id for r in got if r.doc_id is not None} == {c for c in comp if c is not None}
    assert len(got) == len(set(comp))


def test_empty_table(spark):
    docs = odd_docs(spark)
    assert simhash_mih.near_duplicates(none(docs)).collect() == []
    assert simhash_mih.keep_one(none(docs)).collect() == []


def test_links_lose_nothing_and_hot_buckets_are_dealt(spark):
    r = random.Random(5)
    center = r.getrandbits(64)
    fps = {center} | {center ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 4))) for _ in range(300)}
    fps |= {r.getrandbits(64) for _ in range(300)}
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)), k) for k, f in enumerate(fps)], "fp long, doc_id long")
    want = slow_components(list(range(len(fps))), fps)
    for segments, block in ((3, 4096), (3, 16), (2, 4096), (5, 64)):
        got = {x.fp: x.component for x in simhash_mih.group_ids(df, segments=segments, block=block).collect()}
        assert [got[int(np.uint64(f).view(np.int64))] for f in fps] == want


def test_a_dense_group_leaves_its_task_as_a_star():
    f = np.arange(16, dtype=np.int64)  # all within 4 bits of each other
    u, v = simhash_mih._verified(f, np.arange(16), np.full(16, 16), 4)
    assert len(u) == 15 and set(v) == {0}


def test_components_of_a_long_chain(spark):
    edges = spark.range(0, 200).selectExpr("id as u", "id + 1 as v")
    got = {r.node: r.root for r in graph.components(edges).collect()}
    assert got == {k: 0 for k in range(1, 201)}


def test_query(spark):
    import pandas as pd
    d = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    fps = [slow_fingerprint(t) for t in d.text]
    want = [(i, f"{f:016x}", c) for i, f, c in zip(d.doc_id, fps, slow_components(list(d.doc_id), fps))]
    assert same_rows([tuple(r) for r in op8_simhash_mih(spark, "/root/testdata/sf0.001").collect()], want)
