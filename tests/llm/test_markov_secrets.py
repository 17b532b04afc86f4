import hashlib
import random
import re
import string

import pytest
from helpers import none, odd_docs, odd_rows

from mergestat.llm import markov_secrets as ms
from mergestat.llm.queries import op10_markov_secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def slow(text):
    t = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(t) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(t) if len(m[0]) >= 24]
    return ",".join(f"{ms.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def base(rows, spark, text="text"):
    df = spark.createDataFrame(rows, "i int, text string")
    model = [0.0] * len(ms.ALPHABET) ** 2
    return {r.i: r.s for r in ms.scan(df, model).select("i", ms.listed(ms.F.col("secrets")).alias("s")).collect()}


def test_base_spans(spark):
    r = random.Random(4)
    bits = ["password", "PassWD", "secret", "token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abc", "abcdef", "AKIA",
            "Z9" * 8, "0f" * 12, "\U0001F600", "é", "\n", "-", "deadbeef" * 3, "A", ",", "AKIAAKIA", "\t"]
    rows = [(k, "".join(r.choices(bits, k=r.randint(0, 30)))) for k in range(1500)]
    rows += [(5000, None), (5001, ""), (5002, "token=secret:abcdefgh"), (5003, "token=abcdefg " * 700),
             (5004, "x" * 300_000 + " token: abcdefgh")]
    got = base(rows, spark)
    assert {k: slow(t) for k, t in rows} == got


def test_running_sums(spark):
    x = [random.Random(k).randint(0, 9) for k in range(1000)]
    df = spark.createDataFrame([(x,), (x[:1],), (x[:256],), (x[:257],)], "x array<int>")
    for row in df.select("x", ms._running(ms.F.col("x")).alias("s")).collect():
        assert row.s == [sum(row.x[:k + 1]) for k in range(len(row.x))]


def test_pieces_beside_base_spans_are_scored(spark):
    r = random.Random(11)
    hex_, access = "0f3a" * 6, "AKIA" + "Z9" * 8
    bits = [hex_, access, access + "/" + hex_, "token=abcdefgh", "/", "-", "_", " ", "password=", "G" * 15, "G" * 16, "\U0001F600", "H+/" * 9]
    texts = ["".join(r.choices(bits, k=r.randint(1, 9))) for _ in range(400)] + [None, ""]
    key = "wJalrXUtnFEMIK7MDENGbPxRfiCYqL0s9TzQvHkG"
    texts += [f"see {access}/{key} there", f"{hex_}-{key}", f"{key}_{hex_}-{key}"]

    def pieces(t):
        """Places of runs outside the base spans, by character."""
        taken = {i for s in slow(t).split(",") if s for i in range(int(s.split(":")[1]), int(s.split(":")[2]))}
        free = "".join(" " if i in taken else c for i, c in enumerate(t or ""))
        return [(m.start(), m.end(), m[0]) for m in re.finditer(f"{ms.RUN}{{{ms.RUN_CHARS},}}", free)]

    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    everything = [1.0] * len(ms.ALPHABET) ** 2
    for row in ms.scan(df, everything).collect():
        assert [(s.start, s.end, s.text) for s in row.secrets if s.kind == 3] == pieces(row.text), row.text
    assert pieces(texts[-3]) == [(4 + len(access), 4 + len(access) + 41, "/" + key)]


def test_random_strings_are_told_from_identifiers(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    model = ms.train(docs)
    r = random.Random(9)
    keys = ["".join(r.choices(string.ascii_letters + string.digits + "+/", k=r.choice((20, 24, 32)))) for _ in range(200)]
    words = {w for (t,) in docs.where("doc_id % 7 = 3").select("text").collect() for w in re.findall("[A-Za-z]{16,}", t)}
    rows = [(k, f"see {w} there") for k, w in enumerate([*keys, *words])]
    df = spark.createDataFrame(rows, "i int, text string")
    hit = {x.i for x in ms.scan(df, model).where("size(secrets) > 0").collect()}
    assert len([k for k in range(200) if k in hit]) >= 195
    assert len([k for k in hit if k >= 200]) <= 0.01 * len(words)
    spans = ms.scan(df, model).where("i = 0").first().secrets
    assert [(s.kind, s.start, s.end, s.text) for s in spans] == [(3, 4, 4 + len(keys[0]), keys[0])]


def test_odd_documents(spark):
    docs = odd_docs(spark)
    out = ms.scan(docs, ms.train(docs))
    assert out.columns == [c for c in docs.columns if c != "secrets"] + ["secrets"]
    got = out.select("text", ms.listed(ms.F.filter("secrets", lambda s: s["kind"] < 3)).alias("s")).collect()
    assert len(got) == len(odd_rows()) and all(slow(r.text) == r.s for r in got)


def test_without_secrets_or_rows(spark):
    docs = odd_docs(spark)
    model = ms.train(none(docs))
    assert len(model) == len(ms.ALPHABET) ** 2
    assert ms.scan(none(docs), model).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = op10_markov_secrets(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = slow(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == [s for s in want.split(",") if s]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(want.count(k) for k in ("assign:", "access:", "hex:"))


ALNUM = string.ascii_letters + string.digits
KEYS = {"alnum": ALNUM, "base64": ALNUM + "+/", "upper": string.ascii_uppercase + string.digits,
        "lower": string.ascii_lowercase + string.digits, "letters": string.ascii_letters}


@pytest.mark.parametrize("train_on_planted", [False, True])
def test_held_out_keys_in_whole_documents(spark, train_on_planted):
    """A random key and a long ordinary run in every document of a table: keys are found, runs are not,
    whether or not the models saw documents with such keys."""
    r = random.Random(7)
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = [(x.doc_id, x.text or "") for x in table.collect()]
    words = [w for _, t in docs for w in t.split() if w.isalpha() and w.isascii()]

    def ordinary():
        w = r.choices(words, k=5)
        return r.choice(["_".join(w[:4]).lower(), "".join(w).lower(), "-".join(w[:4]), "/".join(w[:4]).lower(), "=" * 20,
                         "".join(x.capitalize() for x in w[:4]), str(r.randint(10 ** 17, 10 ** 18)),
                         "2024-%02d-%02d_%02d-%02d-%02d" % tuple(r.randint(1, 12) for _ in range(5))])
    rows, at = [], {}
    for i, t in docs:
        key, run = "".join(r.choices(KEYS[r.choice(list(KEYS))], k=r.choice([20, 24, 32, 40, 64]))), ordinary()
        rows.append((i, f"{t} {key} and {run} end"))
        at[i] = len(t) + 1, len(t) + 1 + len(key), len(run)
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    model = ms.train(planted if train_on_planted else table)
    hits = false = candidates = 0
    for x in ms.scan(planted, model).select("doc_id", "secrets").collect():
        start, end, long = at[x.doc_id]
        hits += any(s.start <= start and s.end >= end for s in x.secrets)
        false += sum(s.kind == 3 and s.start >= end for s in x.secrets)
        candidates += long >= 16
    assert hits >= 0.95 * len(docs)
    assert false <= 0.01 * candidates
