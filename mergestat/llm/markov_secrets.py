"""Secret scan: fixed patterns, and character Markov models of random strings.

Three patterns find the base spans.  Beside them every run of 16 or more of the
characters of ``ALPHABET``, and of a run that touches base spans every such piece
outside them, is scored by two
first-order character Markov models, one of random strings and one of ordinary
words and identifiers: the log-likelihood ratio of the run must reach
``least`` (the prior odds against a random string).

Both models are trained from labelled samples of the scanned documents: secrets
that the patterns find count as random, all other words that more than one document
has, and all numbers, as ordinary.  The sample
is the ``sample_docs`` documents lowest in hash order of id and text for each label,
equal ones counted once; smoothing
by ``alpha`` counts per pair of characters stands for what the sample lacks, and
``uniform`` of the random model's mass goes to strings of evenly drawn
characters, whatever secrets the sample holds.

Offsets are code points, ends exclusive.  DataFrame operations only: a span's
place comes from the lengths of what ``split`` leaves between matches.

Scale: one scan without a shuffle; the broadcast model has a fixed size.

Defined cases: a null text counts as empty and has no spans; repeated rows are
scanned alike; an empty table gives no rows; all input columns are kept and one
named ``secrets`` is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, staged

# Fixed values of the base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: A cheap necessary condition of ASSIGN.
ASSIGN_GUARD = r"""(?i)(?:word|passwd|secret|token|key)["']?\x20*[:=]"""
VALUE_CHARS = 6
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = r"[A-Za-z0-9+/_=-]"
RUN_CHARS = 16
SAMPLE_DOCS, ALPHA, UNIFORM, LEAST = 2000, 0.5, 0.2, math.log(1e6)
#: Elements summed in one piece by ``_running``.
PIECE = 64

_SPAN = "array<struct<kind:int,start:int,end:int,text:string>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0), lambda s, v: s + v)


def _within(x: Column, base) -> Column:
    """Running sums of a short int array, from ``base`` on."""
    return F.transform(x, lambda v, i: base + _total(F.slice(x, F.lit(1), i + 1)))


def _pieces(x: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / PIECE).cast("int")),
                       lambda k: F.slice(x, k * PIECE + 1, PIECE))


def _running(x: Column, levels: int = 3) -> Column:
    """Running sums of an int array: of the pieces' totals first, then within each piece.

    Totals of ``levels`` levels of pieces keep arrays of ``PIECE ** levels`` numbers linear.
    """
    def from_pieces(pieces):
        totals = F.transform(pieces, _total)
        sums = _running(totals, levels - 1) if levels > 1 else _within(totals, F.lit(0))
        return _let(F.struct(pieces.alias("p"), sums.alias("s")), lambda v: F.flatten(F.transform(
            v["p"], lambda part, k: _let(F.struct(part.alias("x"), (v["s"][k] - _total(part)).alias("b")),
                                         lambda w: _within(w["x"], w["b"])))))
    return F.when(F.size(x) <= PIECE, _within(x, F.lit(0))).otherwise(_let(_pieces(x), from_pieces))


def spans(text: Column, pattern: str, kind: int, group: int = 0, chars: int = 0) -> Column:
    """Leftmost non-overlapping matches whose ``group`` has at least ``chars`` characters."""
    p = F.lit(pattern)
    none = F.array().cast(_SPAN)

    def place(m):
        ends = _running(F.zip_with(m["whole"], m["gap"], lambda w, g: F.char_length(w) + F.char_length(g)))
        rows = F.zip_with(F.arrays_zip(m["whole"].alias("w"), m["part"].alias("v")), ends, lambda z, e: F.struct(
            F.lit(kind).alias("kind"), (e - F.char_length(z["w"])).cast("int").alias("start"),
            e.cast("int").alias("end"), z["v"].alias("text")))
        return F.filter(rows, lambda s: F.char_length(s["text"]) >= chars)

    found = _let(F.regexp_extract_all(text, p, F.lit(0)), lambda whole: F.when(F.size(whole) == 0, none).otherwise(
        _let(F.struct(whole.alias("whole"), F.regexp_extract_all(text, p, F.lit(group)).alias("part"),
                      F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole)).alias("gap")), place)))
    return found


def base_spans(text: Column) -> Column:
    none = F.array().cast(_SPAN)
    return F.concat(
        F.when(text.rlike(ASSIGN_GUARD), spans(text, ASSIGN, 0, 2, VALUE_CHARS)).otherwise(none),
        F.when(text.rlike(ACCESS), spans(text, ACCESS, 1)).otherwise(none),
        F.when(text.rlike(HEX), spans(text, HEX, 2)).otherwise(none))


def _clear(runs: Column, base: Column) -> Column:
    """Runs that share no character with a base span."""
    return F.filter(runs, lambda r: ~F.exists(base, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))


def _outside(runs: Column, base: Column, chars: int) -> Column:
    """Pieces of ``chars`` characters or more that base spans leave of the runs."""
    def pieces(r):
        cut = F.array_sort(F.transform(
            F.filter(base, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])),
            lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))))
        # each span's end opens a piece, up to the next span's start
        def between(cut):
            opens = F.concat(F.array(r["start"]), F.transform(cut, lambda b: b["end"]))
            closes = F.concat(F.transform(cut, lambda b: b["start"]), F.array(r["end"]))
            def piece(a, i):
                # spans may overlap: what an earlier one covers is no piece
                begin = F.array_max(F.slice(opens, F.lit(1), i + 1))
                return F.struct(F.lit(3).alias("kind"), begin.alias("start"), closes[i].alias("end"))
            found = F.filter(F.transform(opens, piece), lambda x: x["end"] - x["start"] >= chars)
            return F.transform(found, lambda x: F.struct(
                x["kind"], x["start"], x["end"],
                F.substr(r["text"], x["start"] - r["start"] + 1, x["end"] - x["start"]).alias("text")))
        return F.when(F.size(cut) == 0, F.array(r)).otherwise(_let(cut, between))
    return F.flatten(F.transform(runs, pieces))


def _runs(text: Column, chars: int) -> Column:
    pattern = f"{RUN}{{{chars},}}"
    return F.when(text.rlike(pattern), spans(text, pattern, 3)).otherwise(F.array().cast(_SPAN))


def _pairs(token: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.char_length(token) - 1), lambda i: F.substr(token, i, F.lit(2)))


def train(docs: DataFrame, ident: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS,
          alpha: float = ALPHA, uniform: float = UNIFORM) -> list[float]:
    """Log-likelihood ratio random / ordinary of each pair of ``ALPHABET``."""
    src = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), F.col(f"`{ident}`").alias("ident"))
    src = src.where(F.col("ident").isNotNull())

    src = src.withColumn("h", F.xxhash64("text"))

    def lowest(of, random):
        """Ids and hashes alone are ranked and broadcast, so that no task gathers texts."""
        return of.select("ident", "h").distinct().orderBy(F.xxhash64("ident"), "ident", "h").limit(sample_docs).select(
            F.col("ident").alias("picked"), F.col("h").alias("picked_h"), F.lit(random).alias("random"))

    secret = F.col("text").rlike(ASSIGN_GUARD) | F.col("text").rlike(ACCESS) | F.col("text").rlike(HEX)
    picked = staged(lowest(src.where(secret), 1).union(lowest(src, 0)), "secret-sample")
    sample = src.join(F.broadcast(picked), (F.col("ident") == F.col("picked")) & (F.col("h") == F.col("picked_h"))) \
        .groupBy("random", "ident", "h").agg(F.min("text").alias("text")).withColumn("base", base_spans(F.col("text")))
    token = sample.where("random = 1").select("random", "ident", "h", F.explode("base").alias("s")).select(
        "random", "ident", "h", F.col("s.text").alias("token"))
    plain = sample.where("random = 0").select("random", "ident", "h", F.explode(_clear(_runs(F.col("text"), 4), F.col("base"))).alias("s"))
    plain = plain.select("random", "ident", "h", F.col("s.text").alias("token"))
    # a word of one document alone may be a secret that no pattern finds
    words = token.union(plain).where(F.char_length("token") > 1).groupBy("random", "token").agg(
        F.count(F.lit(1)).alias("n"), (F.count_distinct("ident", "h") > 1).alias("shared"))
    seen = words.where((F.col("random") == 1) | F.col("shared") | ~F.col("token").rlike("[^0-9]")).select(
        "random", "n", F.explode(_pairs(F.col("token"))).alias("pair")).groupBy("random", "pair").agg(F.sum("n").alias("count"))
    n = {(r["random"], r["pair"]): r["count"] for r in seen.collect()}
    size = len(ALPHABET)
    out = []
    for a in ALPHABET:
        total = [sum(n.get((k, a + b), 0) for b in ALPHABET) + alpha * size for k in (0, 1)]
        for b in ALPHABET:
            plain, random = ((n.get((k, a + b), 0) + alpha) / total[k] for k in (0, 1))
            out.append(math.log(uniform / size + (1 - uniform) * random) - math.log(plain))
    return out


def ratio(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a run of ``ALPHABET`` characters."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    place = F.transform(F.split(token, ""), lambda c: F.call_function("locate", c, F.lit(ALPHABET)))
    return _let(place, lambda p: F.aggregate(
        F.sequence(F.lit(1), F.size(p) - 1), F.lit(0.0),
        lambda s, i: s + F.element_at(table, ((F.element_at(p, i) - 1) * len(ALPHABET) + F.element_at(p, i + 1)).cast("int"))))


def scan(docs: DataFrame, model: list[float], text: str = "text", least: float = LEAST) -> DataFrame:
    """``docs`` with ``secrets``: array of (kind, start, end, text), base spans and added ones."""
    body, base = fresh(docs, "body", "base")
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "secrets"]
    d = docs.select(*keep, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(body))
    d = d.withColumn(base, base_spans(F.col(body)))
    added = F.filter(_outside(_runs(F.col(body), RUN_CHARS), F.col(base), RUN_CHARS), lambda r: ratio(r["text"], model) >= least)
    return d.select(*keep, F.concat(base, added).alias("secrets"))


def listed(secrets: Column) -> Column:
    """``kind:start:end`` of spans by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(secrets, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
