"""Piece ids against the sentencepiece library, and round trips."""

import random

import pytest
from pyspark.sql import functions as F

from mergestat.llm import piece_codec as pc
from mergestat.llm.queries import op11_piece_codec, tokenizer_path
from tests.conftest import SF001, SF01
from tests.llm.helpers import none, odd_docs, odd_rows

MODEL = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def enc():
    return pc.PieceEncoder(MODEL)


def odd_texts(seed, n):
    r = random.Random(seed)
    pieces = [pc.encoder(MODEL).lib.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    kinds = [lambda: "".join(r.choices(pieces, k=r.randint(1, 6))),
             lambda: "".join(r.choices(" \n\tabce.,01é文\x00▁", k=r.randint(0, 40))),
             lambda: "".join(r.choices("  aaathe", k=r.randint(0, 60))),
             lambda: "".join(chr(r.choice([r.randint(0, 0x2ff), r.randint(0x2000, 0x2fff), r.randint(0x4e00, 0x9fff),
                                           r.randint(0x1f300, 0x1f6ff)])) for _ in range(r.randint(0, 20)))]
    return [r.choice(kinds)() for _ in range(n)]


def test_ids_are_the_library_s(enc):
    texts = odd_texts(1, 5000) + ["<s> </s> <unk> <0x41> ▁▁", " " * 40 + "x" + " " * 17, "́́a"]
    assert [t for t in texts if enc.encode(t) != enc.lib.encode(t)] == []


def test_adjacent_tokens_of_an_encoding_are_compatible_and_others_not(enc):
    r = random.Random(2)
    ids = sorted(enc.piece)
    hits = 0
    for _ in range(4000):
        a, b = r.choice(ids), r.choice(ids)
        if enc._edges(a) is None or enc._edges(b) is None:
            continue
        # the pair alone, by joining the best adjacent symbols until none is left
        parts = list(enc.piece[a] + enc.piece[b])
        while True:
            scored = [(enc.score.get(x + y, float("-inf")), -k) for k, (x, y) in enumerate(zip(parts, parts[1:]))]
            s, k = max(scored, default=(float("-inf"), 0))
            if s == float("-inf"):
                break
            parts[-k:-k + 2] = [parts[-k] + parts[-k + 1]]
        assert enc.compatible(a, b) == (parts == [enc.piece[a], enc.piece[b]])
        hits += not enc.compatible(a, b)
    assert hits


def test_long_units_without_spaces(enc):
    for t in ("x" * 100_000, " " * 30_000, "ab" * 50_000, "文字" * 20_000):
        assert enc.encode(t) == enc.lib.encode(t)


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(pc, "CACHE_UNITS", 20)
    monkeypatch.setattr(pc, "CACHE_PAIRS", 5)
    enc = pc.PieceEncoder(MODEL)
    for t in odd_texts(3, 300):
        assert enc.encode(t) == enc.lib.encode(t)


def test_odd_rows_and_columns(spark):
    lib = pc.encoder(MODEL).lib
    docs = odd_docs(spark).withColumn("ids", F.lit("old")).withColumn("decoded", F.lit(7))
    out = pc.decode(pc.encode(docs, MODEL), MODEL)
    assert set(out.columns) == set(docs.columns)
    got = sorted((str(r["doc_id"]), r["text"] or "", list(r["ids"]), r["decoded"]) for r in out.collect())
    want = sorted((str(r[0]), r[1] or "", lib.encode(r[1] or ""), lib.decode(lib.encode(r[1] or ""))) for r in odd_rows())
    assert got == want
    assert pc.decode(pc.encode(none(docs), MODEL), MODEL).count() == 0


def test_other_kinds_of_model_are_refused(tmp_path, monkeypatch):
    monkeypatch.setattr(pc.PieceEncoder, "_unusual", staticmethod(lambda path: True))
    with pytest.raises(ValueError):
        pc.PieceEncoder(MODEL)


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query(spark, sf):
    from hashlib import sha256
    lib = pc.encoder(MODEL).lib
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = lib.encode(r["text"] or "")
        want[r["doc_id"]] = (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(),
                             sha256(lib.decode(ids).encode()).hexdigest())
    got = {r[0]: tuple(r[1:]) for r in op11_piece_codec(spark, sf).collect()}
    assert got == want
