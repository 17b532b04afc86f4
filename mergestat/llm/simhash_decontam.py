"""Benchmark decontamination by SimHash of item-sized windows.

Texts are lower-cased and cut into words (runs of letters and digits) and
shingles of five words.  A window has as many shingles as a benchmark item; its
64-bit SimHash is compared with the items of that size through multi-index
Hamming blocks: ``radius`` + 1 blocks, of which two fingerprints within
``radius`` bits share at least one, so none within the radius is missed.  Pairs
found so are verified by the exact weighted Jaccard similarity of their shingles
(a shingle weighs as often as it occurs), at least ``threshold``.

Only windows that could pass verification are fingerprinted: a window as
similar as ``threshold`` to some item holds at least that share of the item's
shingles, and of such windows those that begin with one of them (or end the
document) reach the greatest similarity.  The places come from one pass that
joins all document shingles with the benchmark's.  DataFrame operations only.

Scale: the pass is one scan and, up to ``BROADCAST_ROWS`` benchmark shingles, no
shuffle; a larger benchmark joins by a shuffle.  Later steps see only documents
that share most of an item.

Defined cases: a null text counts as empty; a text without words matches
nothing; a text or item of fewer than five words is one shingle, so a short item
matches only documents that consist of it; repeated rows and items are reported
once; null ids are carried; an empty benchmark or table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, staged

SHINGLE, THRESHOLD, RADIUS = 5, 0.8, 16
#: Rows up to which the benchmark's shingles (24 bytes each), or the windows to
#: look at (40 bytes each), are broadcast.
BROADCAST_ROWS = 200_000


def shingles(text: Column, width: int = SHINGLE) -> Column:
    """Hashes of the text's shingles in order, repeats included."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))

    def cut(w):
        n = F.size(w)
        return (F.when(n == 0, F.array().cast("array<bigint>"))
                .when(n < width, F.array(F.xxhash64(w)))
                .otherwise(F.transform(F.sequence(F.lit(1), n - width + 1),
                                       lambda i: F.xxhash64(F.slice(w, i, width)))))
    return F.transform(F.array(words), cut)[0]


def simhash(hashes: Column, most: int) -> Column:
    """Bitwise majority of an array of at most ``most`` hashes.

    Counts of several bits are held side by side in one long, so an element
    costs 8 additions (16 or 32 for more than 255 or 65535 elements).
    """
    lane = 8 if most < 1 << 8 else 16 if most < 1 << 16 else 32
    mask = sum(1 << j for j in range(0, 64, lane))
    zero = F.array(*[F.lit(0).cast("long")] * lane)
    steps = F.array(*[F.lit(k) for k in range(lane)])

    def add(acc, h):
        return F.zip_with(acc, steps, lambda a, k: a + F.call_function("shiftrightunsigned", h, k).bitwiseAND(F.lit(mask)))

    def bits(acc):
        full = F.lit((1 << lane) - 1)
        return reduce(lambda a, b: a.bitwiseOR(b), [
            F.when(2 * F.shiftrightunsigned(acc[k], at).bitwiseAND(full) > F.size(hashes),
                   F.lit(_signed(1 << (k + at)))).otherwise(F.lit(0).cast("long"))
            for at in range(0, 64, lane) for k in range(lane)])

    return F.transform(F.array(F.aggregate(hashes, zero, add)), bits)[0]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _blocks(fp: Column, radius: int) -> Column:
    """(block, value) of the radius + 1 blocks of a fingerprint."""
    cut = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[
        F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("value"))
        for b, (lo, hi) in enumerate(zip(cut, cut[1:]))])


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays, weight being the count."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))

    def count(xs, y):
        return F.size(F.filter(xs, lambda x: x == y))

    # where either side repeats nothing, each common value counts once
    common = F.when(plain, F.size(F.array_intersect(a, b))).otherwise(
        F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, y: s + F.least(count(a, y), count(b, y))))
    return common / (F.size(a) + F.size(b) - common)


def _hinted(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def matches(docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", text: str = "text",
            item: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
            radius: int = RADIUS, width: int = SHINGLE) -> DataFrame:
    """One row per document and item it holds a near copy of.

    Columns ``ident``, ``text_key`` (hash of the text), ``item``,
    ``similarity``, ``distance`` (bits) and ``start`` (0-based word of the most
    similar window).
    """
    src = docs.select(F.col(f"`{ident}`").alias("ident"), F.col(f"`{text}`").alias("text"),
                      F.xxhash64(F.col(f"`{text}`")).alias("text_key"))
    items = benchmark.select(F.col(f"`{item}`").alias("item"), shingles(F.col(f"`{item_text}`"), width).alias("sh"))
    items = staged(items.where(F.size("sh") > 0).distinct().withColumn("n", F.size("sh"))
                   .withColumn("item_key", F.xxhash64("item", "sh")), "bench-items")
    most, total = items.agg(F.max("n"), F.sum("n")).first()
    empty = src.select("ident", "text_key").limit(0)
    if not most:
        return empty.select(F.col("ident").alias(ident), "text_key", F.lit(None).cast(items.schema["item"].dataType).alias(item),
                            F.lit(0.0).alias("similarity"), F.lit(0).alias("distance"), F.lit(0).alias("start"))
    items = staged(items.withColumn("fp", simhash(F.col("sh"), most)), "bench-fingerprints")

    # where documents share shingles with items
    known = items.select("item_key", "n", F.explode("sh").alias("h")).distinct()
    known = _hinted(known, total)
    seen = src.select("ident", "text_key", F.posexplode(shingles(F.col("text"), width)).alias("at", "h"))
    places = seen.join(known, "h").groupBy("ident", "text_key", "item_key", "n").agg(
        F.sort_array(F.collect_set("at")).alias("at"))
    need = F.ceil(F.lit(threshold) * F.col("n")).cast("int")
    fits = F.filter(F.sequence(F.lit(1), F.size("at") - F.col("need") + 1),
                    lambda j: F.element_at("at", (j + F.col("need") - 1).cast("int")) < F.element_at("at", j) + F.col("n"))
    windows = (places.withColumn("need", need).where(F.size("at") >= F.col("need"))
               .select("ident", "text_key", "n", F.explode(F.transform(fits, lambda j: F.element_at("at", j))).alias("start"))
               .groupBy("ident", "text_key").agg(F.collect_set(F.struct("n", "start")).alias("windows")))
    windows = staged(windows, "windows")
    rows = windows.agg(F.sum(F.size("windows"))).first()[0] or 0
    held = windows.toDF("i", "k", "windows")
    full = src.join(_hinted(held, rows), F.col("ident").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")))
    cut = full.select("ident", "text_key", shingles(F.col("text"), width).alias("sh"), "windows").select(
        "ident", "text_key", "sh", F.explode("windows").alias("w")).select(
        "ident", "text_key", F.col("w.n").alias("n"),
        F.least(F.col("w.start"), F.greatest(F.size("sh") - F.col("w.n"), F.lit(0))).alias("start"), "sh").select(
        "ident", "text_key", "n", "start", F.slice("sh", F.col("start") + 1, F.col("n")).alias("win"))
    cut = staged(cut.withColumn("fp", simhash(F.col("win"), most)), "window-fingerprints")

    # multi-index Hamming search among items of the window's size
    a = cut.select("*", F.explode(_blocks(F.col("fp"), radius)).alias("b")).select("*", "b.block", "b.value").drop("b")
    b = items.select("item", F.col("n").alias("m"), F.col("sh"), F.col("fp").alias("item_fp"),
                     F.explode(_blocks(F.col("fp"), radius)).alias("b")).select(
        "item", "m", "sh", "item_fp", F.col("b.block").alias("item_block"), F.col("b.value").alias("item_value"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    # of the blocks that a pair shares only the first brings it on
    same = [F.col("fp").bitwiseXOR(F.col("item_fp")).bitwiseAND(F.lit(_signed(((1 << (64 * (i + 1) // (radius + 1))) - 1)
            ^ ((1 << (64 * i // (radius + 1))) - 1)))) == 0 for i in range(radius + 1)]
    first = F.coalesce(*[F.when(s, F.lit(i)) for i, s in enumerate(same)])
    pairs = a.join(_hinted(b, items.count() * (radius + 1)),
                   (F.col("n") == F.col("m")) & (F.col("block") == F.col("item_block"))
                   & (F.col("value") == F.col("item_value")) & (near <= radius) & (first == F.col("block")))
    scored = pairs.select("ident", "text_key", "item", "start", near.alias("distance"),
                          similarity(F.col("win"), F.col("sh")).alias("similarity"))
    best = scored.where(F.col("similarity") >= threshold).groupBy("ident", "text_key", "item").agg(
        F.max(F.struct(F.col("similarity"), (-F.col("start")).alias("s"), "distance")).alias("b"))
    return best.select(F.col("ident").alias(ident), "text_key", F.col("item").alias(item), "b.similarity",
                       "b.distance", (-F.col("b.s")).alias("start"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", text: str = "text",
                  **options) -> DataFrame:
    """``docs`` without the rows that hold a near copy of a benchmark item."""
    found = matches(docs, benchmark, ident, text, **options)
    key, i, k = fresh(docs, "text_key", "ident", "found_key")
    hit = staged(found.select(F.col(f"`{ident}`").alias(i), F.col("text_key").alias(k)).distinct(), "contaminated")
    d = docs.withColumn(key, F.xxhash64(F.col(f"`{text}`")))
    d = d.join(_hinted(hit, hit.count()), F.col(f"`{ident}`").eqNullSafe(F.col(i)) & (F.col(key) == F.col(k)), "left_anti")
    return d.drop(key)
