"""Runs against a scan of every distance, on words, tables and hostile texts."""

import random
import re
import time
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from mergestat.llm import word_runs as wr
from mergestat.llm.queries import op13_word_runs
from tests.conftest import SF001, SF01
from tests.llm.helpers import none, odd_docs, odd_rows

WORD = re.compile("[^\x20\x09-\x0D]+")


def scanned(words, least=24, copies=3):
    """Every stretch of every distance; the smallest distance of a stretch is its period."""
    out = {}
    for q in range(1, len(words) // copies + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, copies * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def made(r):
    k, n = r.choice([1, 2, 2, 3, 5]), r.randint(1, 90)
    kind = r.randrange(3)
    if kind == 0:
        return [r.randrange(k) for _ in range(n)]
    if kind == 1:
        period = [r.randrange(k) for _ in range(r.randint(1, 12))]
        w = [r.randrange(k) for _ in range(r.randint(0, 5))] + (period * 90)[:n] + [r.randrange(k) for _ in range(r.randint(0, 5))]
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = r.randrange(k + 1)
        return w
    w = []
    while len(w) < n:
        w += [r.randrange(9)] * r.randint(1, 30) if r.random() < .5 else [r.randrange(9), r.randrange(9)] * r.randint(1, 15)
    return w


def test_runs_are_those_of_a_scan():
    r = random.Random(3)
    for _ in range(3000):
        w, (least, copies) = made(r), r.choice([(24, 3), (24, 3), (4, 2), (1, 2), (6, 3), (10, 4)])
        assert wr.runs(np.array(w), least, copies) == scanned(w, least, copies), (w, least, copies)


def test_every_pair_is_a_run_without_extension():
    r = random.Random(4)
    for _ in range(500):
        w = made(r)
        for start, length, d in wr.maximal_pairs(np.array(w), 6, 3):
            same = [w[i] == w[i + d] for i in range(len(w) - d)]
            assert all(same[start:start + length - d])
            assert start == 0 or not same[start - 1]
            assert start + length == len(w) or not same[start + length - d]


def test_many_texts_in_one_chunk():
    r = random.Random(5)
    texts = [" ".join(map(str, made(r))) for _ in range(300)] + ["", "a " * 40, "a " * 40]
    got = wr._chunk(texts, 24, 3)
    for t, (n, found, rest) in zip(texts, got):
        w = t.split()
        assert (n, found) == (len(w), scanned(w))
        gone = {i for s, m, q in found for i in range(s + q, s + m)}
        assert rest == " ".join(x for i, x in enumerate(w) if i not in gone)


def test_hostile_texts_stay_cheap():
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 30_000:
        fib.append(fib[-1] + fib[-2])
    passages = [x for i in range(3000) for x in [1000 + i, *range(20)]]         # one passage, 3000 different words before it
    began = time.time()
    assert wr.runs(np.zeros(50_000, int)) == [(0, 50_000, 1)]
    assert wr.runs(np.array([0, 1] * 30_000)) == [(0, 60_000, 2)]
    assert wr.runs(np.array(passages)) == []
    assert len(wr.runs(np.array(fib[-1]))) > 1000
    assert time.time() - began < 30


def test_odd_rows_and_columns(spark):
    docs = odd_docs(spark).withColumn("runs", F.lit("r")).withColumn("n_words", F.lit("n")).withColumn("collapsed", F.lit(1))
    out = wr.collapse(docs)
    assert set(out.columns) == set(docs.columns)
    got = sorted((str(r["doc_id"]), r["text"] or "", r["n_words"], [tuple(x) for x in r["runs"]]) for r in out.collect())
    want = sorted((str(r[0]), r[1] or "", len(WORD.findall(r[1] or "")), scanned(WORD.findall(r[1] or ""))) for r in odd_rows()
                  if len(r[1] or "") < 30_000 or " " not in r[1])
    assert [g for g in got if len(g[1]) < 30_000 or " " not in g[1]] == want
    assert wr.collapse(none(docs)).count() == 0
    with pytest.raises(ValueError):
        wr.collapse(docs, copies=1)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query(spark, sf):
    """All columns against a scan; in the larger table long documents are scanned at the distances that recur."""
    got = {r["doc_id"]: r for r in op13_word_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        w = planted(d["doc_id"], WORD.findall(d["text"] or ""))
        a = np.array([hash(x) for x in w]) if w else np.zeros(0, int)
        found = {}
        for q in range(1, len(w) // 3 + 1):
            same = np.concatenate([[False], a[q:] == a[:-q], [False]])
            turns = np.flatnonzero(same[1:] != same[:-1])
            for i, j in zip(turns[::2].tolist(), turns[1::2].tolist()):
                if j - i + q >= max(24, 3 * q):
                    found.setdefault((i, j - i + q), q)
        found = sorted((s, n, q) for (s, n), q in found.items())
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        r = got[d["doc_id"]]
        assert r["n_runs"] == len(found)
        assert r["runs_sha256"] == sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()
        if found:
            from fractions import Fraction
            s, n, q = max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]))
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (s, n, q, 1000 * n // q)
            some += 1
        else:
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (None,) * 4
    assert some
