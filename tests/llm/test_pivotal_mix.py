import re
from collections import Counter, defaultdict

import pytest
from helpers import none, odd_docs, odd_rows, same_rows
from pyspark.sql import functions as F

from mergestat.llm import pivotal_mix as pm
from mergestat.llm.queries import op6_pivotal_mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_targets(size: dict, weights=(1, 2, 3), limit=3):
    order = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, full, out = sum(size.values()), set(), {}
    while True:
        open_ = [s for s in order if s not in full]
        out = {s: limit * size[s] if s in full else (left - sum(limit * size[f] for f in full)) * w[s] / sum(w[o] for o in open_)
               for s in order}
        over = {s for s in open_ if out[s] > limit * size[s]}
        if not over:
            return out
        full |= over


def check(rows, found, limit=3):
    """rows (id, source, text), found (id, size, source_size, target, taken)."""
    size = Counter()
    biggest = defaultdict(int)
    for _, s, t in rows:
        n = len(WORD.findall(t or ""))
        size[s] += n
        biggest[s] = max(biggest[s], n)
    target = slow_targets(size)
    want = [(i, len(WORD.findall(t or "")), size[s], s) for i, s, t in rows]
    got = [(r.doc_id, r["size"], r.source_size, r.source) for r in found]
    assert same_rows(got, want)
    taken = Counter()
    for r in found:
        assert abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= limit * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - target[s]) <= biggest[s] / 2 + 1e-6


def test_odd_documents(spark):
    docs = odd_docs(spark)
    found = pm.mix(docs, keep=["doc_id", "source"]).collect()
    check([(r[0], r[3], r[1]) for r in odd_rows()], found)


def test_input_columns_survive(spark):
    docs = odd_docs(spark)
    out = pm.mix(docs)
    assert [c for c in docs.columns if c not in ("size", "copies", "taken")] == out.columns[:12]
    mixed = pm.mixed(docs)
    assert mixed.columns == docs.columns
    taken = Counter()
    for r in out.collect():
        taken[r.doc_id, r.source, r.text] += r.copies
    assert Counter((r.doc_id, r.source, r.text) for r in mixed.collect()) == +taken


WORKING = ("ident", "source", "size", "n", "i", "s", "z", "m", "k", "gs", "of_ident", "of_source", "of_size", "goal_source", "tie", "place",
           "place_ident", "own_size", "own_copies", "copies", "part", "own", "start")


def test_columns_of_every_working_name_survive(spark):
    docs = spark.range(80).selectExpr("id % 30 as doc_id", "if(id % 3 = 0, 'a', 'b') as source", "concat('w ', 'x ', id % 40) as text",
                                      "id as size", "id as copies", "id as m", "id as units",
                                      *[f"id * {k + 2} as __{c}" for k, c in enumerate(WORKING)])
    out = pm.mix(docs).collect()
    assert len(out) == 80
    mixed = pm.mixed(docs)
    assert mixed.columns == docs.columns
    own = {tuple(r) for r in docs.collect()}
    assert all(tuple(r) in own for r in mixed.collect())


def test_repeats_are_taken_alike_in_any_order(spark):
    """Equal ids, sources and sizes with other texts: the same rows are taken however the input is dealt."""
    docs = spark.range(900).selectExpr("cast(null as long) as doc_id", "if(id % 2 = 0, 'a', 'b') as source",
                                       "if(id % 3 = 0, 'one two', concat('w', id, ' x')) as text")
    a = pm.mixed(docs.repartition(6, "text")).collect()
    b = pm.mixed(docs.orderBy(F.desc("text")).coalesce(2)).collect()
    assert same_rows(a, b) and len(a) > 0


def test_copies_are_unbiased_and_reruns_agree(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"),
                                   F.expr("repeat('w ', cast(1 + id % 9 as int))").alias("text"))
    docs = docs.union(spark.range(400, 500).select("id", F.lit("b"), F.lit("w w w")))
    total = Counter()
    for seed in range(12):
        rows = pm.mix(docs, weights=(1, 1), seed=seed, fan=8, keep=["doc_id", "source"]).collect()
        total.update({r.doc_id: r.copies for r in rows})
        each = rows[0].target / rows[0].source_size
    a = [total[k] / 12 for k in range(400)]
    assert abs(sum(a) / 400 - each) < 0.01
    again = pm.mix(docs.repartition(7), weights=(1, 1), seed=11, fan=8, keep=["doc_id", "source"]).collect()
    assert same_rows(again, rows)


@pytest.mark.parametrize("n,fan", [(1, 32), (33, 32), (3000, 4)])
def test_trees_of_any_height(spark, n, fan):
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").alias("source"),
                                 F.expr("repeat('w ', cast(id % 50 as int))").alias("text"))
    rows = pm.mix(docs, fan=fan, keep=["doc_id", "source"]).collect()
    check([(r.doc_id, r.source, r.text) for r in docs.collect()], rows)


def test_empty_table(spark):
    assert pm.mix(none(odd_docs(spark))).collect() == []
    assert pm.mixed(none(odd_docs(spark))).collect() == []


def test_ranked_is_a_total_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    assert sorted((r.x, r["rank"]) for r in pm.ranked(df, [F.col("x")]).collect()) == [(k, k) for k in range(1000)]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = op6_pivotal_mix(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text")
    check([tuple(r) for r in docs.collect()], found.join(docs.drop("text"), "doc_id").collect())
