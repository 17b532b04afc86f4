import re
from collections import Counter, defaultdict

import numpy as np
from helpers import none, odd_docs, odd_rows, prose, same_rows
from pyspark.sql import functions as F

from mergestat.llm import simhash_decontam as sd
from mergestat.llm.queries import op7_simhash_decontam


def grams(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def slow(docs, items, threshold=0.8):
    """{(id, item): best similarity over all windows of the item's size}."""
    out = {}
    held = defaultdict(set)
    its = [(i, grams(t)) for i, t in items]
    for k, (_, g) in enumerate(its):
        for x in g:
            held[x].add(k)
    for d, t in docs:
        g = grams(t)
        for k in {k for x in set(g) for k in held.get(x, ())}:
            item, ig = its[k]
            a = Counter(ig)
            for s in range(max(1, len(g) - len(ig) + 1)):
                b = Counter(g[s:s + len(ig)])
                common = sum((a & b).values())
                sim = common / (len(ig) + sum(b.values()) - common)
                if sim >= threshold:
                    out[d, item] = max(out.get((d, item), 0), sim)
    return out


def test_odd_documents_and_items(spark):
    rows = odd_rows()
    items = [(0, None), (1, ""), (2, "one"), (3, "one two three"), (4, prose(103, 33)), (4, prose(103, 33)),
             (5, prose(110, 40)[:150]), (None, prose(3, 50)), (7, "the the the the the the the the"), (8, prose(9, 60))]
    extra = [(50, prose(61, 40) + " " + prose(9, 60) + " " + prose(62, 40)),           # inside
             (51, prose(61, 40) + " " + prose(9, 60).replace(" ", " \n", 9)),          # at the end, other blanks
             (52, " ".join(w if k != 30 else "changed" for k, w in enumerate(prose(9, 60).split()))),  # one word
             (53, " ".join(w if k % 12 else "changed" for k, w in enumerate(prose(9, 60).split()))),   # too many
             (54, " ".join(prose(9, 60).split()[:52])),                                # most of it only
             (55, (prose(9, 60) + " ") * 30), (56, "the " * 500)]
    docs = odd_docs(spark).union(spark.createDataFrame(
        [(i, t, *[None] * 13) for i, t in extra], odd_docs(spark).schema))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("size", F.lit("x"))
    want = slow([(r[0], r[1]) for r in rows] + extra, items)
    got = {(r.doc_id, r.item_id): r.similarity for r in sd.matches(docs, bench).collect()}
    assert {(50, 8), (51, 8), (52, 8), (54, 8), (55, 8), (56, 7), (3, 2), (4, 3)} <= set(got) and (53, 8) not in got
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    clean = sd.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    everything = [(r[0], r[1]) for r in rows] + extra
    assert same_rows([(r.doc_id, r.text) for r in clean.collect()], [d for d in everything if not slow([d], items)])


def test_simhash_is_the_bitwise_majority(spark):
    r = np.random.default_rng(1)
    rows = [(k, [int(x) for x in r.integers(-2 ** 63, 2 ** 63 - 1, n)]) for k, n in enumerate((1, 2, 7, 100, 300))]
    df = spark.createDataFrame(rows, "i int, h array<bigint>")
    for most in (300, 70_000):
        got = {x.i: x.fp for x in df.select("i", sd.simhash(F.col("h"), most).alias("fp")).collect()}
        for k, h in rows:
            u = [x % (1 << 64) for x in h]
            want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in u) > len(u))
            assert got[k] % (1 << 64) == want


def test_blocks_miss_nothing_within_the_radius(spark):
    r = np.random.default_rng(2)
    a = r.integers(-2 ** 63, 2 ** 63 - 1, 300)
    flips = [sum(1 << int(b) for b in r.choice(64, int(r.integers(0, 17)), replace=False)) for _ in a]
    df = spark.createDataFrame([(int(x), int(np.int64(np.uint64(int(x) % (1 << 64)) ^ np.uint64(f)))) for x, f in zip(a, flips)], "a long, b long")
    shared = F.size(F.array_intersect(sd._blocks(F.col("a"), 16), sd._blocks(F.col("b"), 16)))
    assert df.where(shared == 0).count() == 0


def test_weighted_similarity(spark):
    cases = [([1, 2, 3], [1, 2, 3]), ([1, 1, 2], [1, 2, 2]), ([1, 1, 1], [1, 2, 3]), ([1], [2]), ([5, 5, 6, 6], [5, 5, 5, 6])]
    df = spark.createDataFrame(cases, "a array<bigint>, b array<bigint>")
    for (a, b), row in zip(cases, df.select(sd.similarity(F.col("a"), F.col("b")).alias("s")).collect()):
        common = sum((Counter(a) & Counter(b)).values())
        assert row.s == common / (len(a) + len(b) - common)


def test_empty_tables(spark):
    docs, bench = odd_docs(spark), spark.createDataFrame([(1, prose(3, 50))], "item_id long, text string")
    assert sd.matches(none(docs), bench).collect() == []
    assert sd.matches(docs, none(bench)).collect() == []
    assert sd.decontaminate(docs, none(bench)).count() == docs.count()


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert {(r.doc_id, r.item_id): r.similarity for r in op7_simhash_decontam(spark, sf).collect()} == slow(docs, items)
