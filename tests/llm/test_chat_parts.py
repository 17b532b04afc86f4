import hashlib
import random

import pytest
from helpers import same_rows

from mergestat.llm import chat_parts as cp
from mergestat.llm.queries import OP3_SQL, op3_chat_parts

SCHEMA = "conv_id long, turn long, role string, text string, piece int, loss string, ident int, parts string"


def odd_turns():
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, "assistant", "\\<turn user>\\\\</turn>\n<"), (1, None, None, "first"),
            (2, 0, "assistant", ""), (2, 0, "assistant", ""), (2, 1, "we<ird>\\ role\n", "a"), (None, 1, "assistant", "lost"),
            (None, 0, "user", "é文\U0001F600\\"), (3, 0, "user", "x" * 100_000), (4, 1, "b", "tie"), (4, 1, "a", "tie"), (4, 1, "a", "aa")]
    rows += [(9, k, "assistant" if k % 2 else "user", f"turn {k} <image 0 3>") for k in range(500)]
    return [(*r, 1, "l", None, "p") for r in rows]


def slow(rows):
    def key(r):
        return tuple((x is not None, x if x is not None else 0) for x in (r[1], r[2], r[3] or ""))
    out = []
    for c in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == c), key=key)
        learned = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        every = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        out.append((c, len(turns), hashlib.sha256(every.encode()).hexdigest(), len(learned),
                    hashlib.sha256(learned.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("piece_chars", [1, 300, 1 << 20])
def test_odd_turns(spark, piece_chars):
    df = spark.createDataFrame(odd_turns(), SCHEMA)
    pieces = cp.formatted(df, piece_chars=piece_chars)
    got = cp.read_back(pieces)
    assert same_rows([tuple(r)[:5] for r in got.collect()], slow(odd_turns()))
    chars = {r.conv_id: r.n for r in pieces.groupBy("conv_id").agg({"formatted": "count"}).toDF("conv_id", "n").collect()}
    assert chars[9] == (500 if piece_chars == 1 else chars[9]) and (piece_chars < 1000 or chars[9] == 1)


def test_empty_table(spark):
    assert cp.read_back(cp.formatted(spark.createDataFrame([], SCHEMA))).collect() == []


def test_typed_parts():
    parts = [{"type": "text", "text": "see <this>"}, {"type": "image", "ref": "i.png", "width": 30, "height": 28},
             {"type": "text", "text": ""}, {"type": "text", "text": "and \\"}, {"type": "audio", "ref": "a.wav", "seconds": 1.5},
             {"type": "document", "ref": "d.pdf", "pages": 3}, {"type": "video", "ref": "v"}, {"type": None}]
    s, v, at = cp.format_turn("us>er", parts, 4)
    assert v.attachments == [(4, "image", "i.png", 6), (5, "audio", "a.wav", 38), (6, "document", "d.pdf", 1536),
                             (7, "other", "v", 0), (8, "other", None, 0)]
    assert v.tokens == 6 + 38 + 1536
    (role, got), = cp.parse(s)
    assert role == "us>er"
    assert [p[:2] for p in got] == [("text", "see <this>"), ("image", 4), ("text", ""), ("text", "and \\"), ("audio", 5),
                                    ("document", 6), ("other", 7), ("other", 8)]
    assert [cp.unescape(s[at + a:at + e]) for a, e in v.texts] == ["see <this>", "", "and \\"]


def test_parts_column(spark):
    rows = [(1, 0, "user", [("text", "look", None, None, None, None, None), ("image", None, "r", 14, 14, None, None)]),
            (1, 1, "assistant", [("text", "ok", None, None, None, None, None)]), (2, 0, "user", None)]
    df = spark.createDataFrame(rows, f"conv_id long, turn int, role string, parts array<{cp.PART}>")
    got = {r.conv_id: r for r in cp.format_chats(df, parts="parts").collect()}
    assert got[1].formatted == "<turn user>look<image 0 1></turn>\n<turn assistant>ok</turn>\n"
    assert [tuple(a) for a in got[1].attachments] == [(0, "image", "r", 1)] and got[1].expanded_tokens == 1
    assert got[2].formatted == "<turn user></turn>\n"


def test_any_text_comes_back():
    r = random.Random(1)
    for _ in range(3000):
        turns = [("".join(r.choices("<>\\/ turn\nx", k=r.randint(0, 6))), "".join(r.choices("<>\\/ \ntextimage0", k=r.randint(1, 20))))
                 for _ in range(3)]
        s = "".join(cp.format_turn(role, [{"type": "text", "text": t}])[0] for role, t in turns)
        assert [(role, p[0][1]) for role, p in cp.parse(s)] == turns


@pytest.mark.parametrize("s", ["<turn a>x", "x</turn>", "<turn a>x</turn>y", "<turn a><turn b></turn>\n", "<image 0 1>"])
def test_broken_output_is_an_error(s):
    with pytest.raises(ValueError):
        list(cp.parse(s))


def test_query(spark):
    import duckdb
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    rel = con.sql(OP3_SQL)
    out = op3_chat_parts(spark, sf)
    assert same_rows([tuple(r) for r in out.select(*rel.columns).collect()], rel.fetchall())
