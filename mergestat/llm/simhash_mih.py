"""SimHash near-duplicates by multi-index hashing.

A document's 64-bit fingerprint is the bitwise majority of the XXH64 values of
its word shingles.  The fingerprint is cut into ``segments`` pieces; two
fingerprints within ``distance`` bits agree on at least one piece up to
``distance // segments`` bits.  So each distinct fingerprint enters one table
row per piece and probes the small Hamming ball around each piece; probe and
table rows meet on (piece, value), and only pairs whose complete distance is
small enough link.

Scale: equal fingerprints collapse to one row before the search.  A probe is
sent by one side of a pair only (the one whose highest differing bit is set).
What a bucket links leaves its task as a spanning star, so a group of g near
copies gives about g rows and not g squared.  Buckets with more than ``block``
table rows are dealt as a grid of cells, so none is worked in a single task.

Defined cases: a null text counts as empty; a text without words has
fingerprint zero, which links like any other; texts shorter than a shingle are
one shingle; repeated rows share a component; a null id is carried and never
names a component unless the component holds no other id (then it is null); an
empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, is_empty, staged
from .graph import components, spanning_stars

SHINGLE, DISTANCE, SEED, SEGMENTS, BLOCK = 4, 4, 42, 3, 4096
#: Most pairs compared in one numpy step.
STEP = 1 << 21
#: Most hot buckets whose list is broadcast (16 bytes each).
BROADCAST_ROWS = 100_000


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned SimHash of one whole text."""
    import xxhash

    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    size = np.fromiter(map(len, words), np.int64, n)
    end = np.cumsum(size + 1) - 1
    first, last = (end - size)[: n - shingle + 1].tolist(), end[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    total = n - shingle + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, total, 1 << 15):
        h = np.fromiter((digest(line[a:b], seed) for a, b in
                         zip(first[at:at + (1 << 15)], last[at:at + (1 << 15)])), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") \
            .sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Columns ``keep`` and ``fp`` (the fingerprint as a signed long)."""
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle, seed) for t in b.column(len(keep)).to_pylist()],
                          np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp)], [*keep, "fp"])

    schema = src.drop("__text").schema.add("fp", "long")
    return src.mapInArrow(run, schema)


def _pieces(segments: int) -> list[tuple[int, int]]:
    """(shift, width) of each piece; they cover the 64 bits."""
    cut = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def _entries(fps: DataFrame, distance: int, segments: int) -> DataFrame:
    """Table rows (probe false) and probe rows of all distinct fingerprints."""
    pieces, near = _pieces(segments), distance // segments

    def run(batches):
        for b in batches:
            f = b.column(0).to_numpy().view(np.uint64)
            for p, (shift, width) in enumerate(pieces):
                part = (f >> np.uint64(shift)) & np.uint64((1 << width) - 1)
                for r in range(near + 1):
                    for bits in combinations(range(width), r):
                        flip = np.uint64(sum(1 << x for x in bits))
                        on = ((part >> np.uint64(bits[-1])) & np.uint64(1)).astype(bool) \
                            if bits else slice(None)
                        value = part[on] ^ flip
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(value), p, np.int32)),
                             pa.array(value.view(np.int64)),
                             pa.array(np.full(len(value), bool(r))),
                             pa.array(f[on].view(np.int64))],
                            ["piece", "value", "probe", "fp"])

    return fps.select("fp").mapInArrow(run, "piece int, value long, probe boolean, fp long")


def _verified(fp: np.ndarray, base: np.ndarray, end: np.ndarray, distance: int):
    """Links of table rows ``base`` to all later rows of their bucket, as stars."""
    count = end - base - 1
    base, count = base[count > 0], count[count > 0]
    edges_u, edges_v = [], []
    at = 0
    cum = np.concatenate([[0], np.cumsum(count)])
    while at < len(base):
        stop = max(at + 1, int(np.searchsorted(cum, cum[at] + STEP, "right")) - 1)
        c = count[at:stop]
        left = np.repeat(base[at:stop], c)
        right = left + 1 + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        x = (fp[left] ^ fp[right]).view(np.uint64)
        hit = (np.bitwise_count(x) <= distance) & (x != 0)
        if hit.any():
            u, v = spanning_stars(fp[left[hit]], fp[right[hit]])
            edges_u.append(u)
            edges_v.append(v)
        at = stop
    if not edges_u:
        return np.empty(0, fp.dtype), np.empty(0, fp.dtype)
    return spanning_stars(np.concatenate(edges_u), np.concatenate(edges_v))


def _bucket_links(batches, distance: int):
    """Rows sorted by bucket and probe; yields the partition's links as stars."""
    rest: list[np.ndarray] | None = None
    found_u, found_v, kept = [], [], 0

    def work(cols):
        bucket_change = np.any([c[1:] != c[:-1] for c in cols[:-2]], axis=0)
        start = np.concatenate([[0], np.flatnonzero(bucket_change) + 1])
        size = np.diff(np.concatenate([start, [len(cols[0])]]))
        end = np.repeat(start + size, size)
        base = np.flatnonzero(~cols[-2])
        return _verified(cols[-1], base, end[base], distance)

    def flush(cols):
        nonlocal found_u, found_v, kept
        u, v = work(cols)
        if len(u):
            found_u.append(u)
            found_v.append(v)
            kept += len(u)
            if kept > STEP:
                u, v = spanning_stars(np.concatenate(found_u), np.concatenate(found_v))
                found_u, found_v, kept = [u], [v], 0

    for b in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if not len(cols[0]):
            continue
        if rest is not None:
            cols = [np.concatenate(x) for x in zip(rest, cols)]
        last = np.ones(len(cols[0]), bool)
        for c in cols[:-2]:
            last &= c == c[-1]
        cut = int(np.argmax(last))
        if cut:
            flush([c[:cut] for c in cols])
        rest = [c[cut:] for c in cols]
    if rest is not None:
        flush(rest)
    if found_u:
        u, v = spanning_stars(np.concatenate(found_u), np.concatenate(found_v))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def links(fps: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS,
          block: int = BLOCK) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints within ``distance``."""
    rows = _entries(fps, distance, segments)
    table = F.explode(F.array(*[
        F.struct(F.lit(p).alias("piece"),
                 F.shiftrightunsigned("fp", shift).bitwiseAND((1 << width) - 1).alias("value"))
        for p, (shift, width) in enumerate(_pieces(segments))])).alias("t")
    hot = staged(fps.select(table).groupBy("t.piece", "t.value").count()
                 .where(F.col("count") > block), "hot-buckets")
    n_hot = hot.count()
    rows = rows.withColumn("lo", F.lit(0)).withColumn("hi", F.lit(0))
    if n_hot:
        grid = hot.select("piece", "value", F.ceil(F.col("count") / block).cast("int").alias("nb"))
        if n_hot <= BROADCAST_ROWS:
            grid = F.broadcast(grid)
        own = F.pmod(F.xxhash64("fp"), F.col("nb")).cast("int")
        rows = (rows.drop("lo", "hi").join(grid, ["piece", "value"], "left")
                .withColumn("nb", F.coalesce("nb", F.lit(1))).withColumn("own", own)
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
                .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")))
    key = ["piece", "value", "lo", "hi"]
    dealt = rows.select(*key, "probe", "fp").repartition(*key).sortWithinPartitions(*key, "probe")
    return dealt.mapInArrow(lambda it: _bucket_links(it, distance), "u long, v long")


def group_ids(fps: DataFrame, ident: str = "doc_id", distance: int = DISTANCE,
              segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """(fp, root, component): each distinct ``fp``, the smallest fingerprint of
    its group and the smallest id in the group."""
    nodes = staged(fps.groupBy("fp").agg(F.min(ident).alias("rep")), "fp-nodes")
    edges = staged(links(nodes, distance, segments, block), "fp-links")
    if is_empty(edges):
        return nodes.select("fp", F.col("fp").alias("root"), F.col("rep").alias("component"))
    root = components(edges)
    member = root.union(root.select(F.col("root").alias("node"), "root").distinct())
    member = member.join(nodes, member.node == nodes.fp).select("fp", "root", "rep")
    least = member.groupBy("root").agg(F.min("rep").alias("component"))
    named = member.join(least, "root").select("fp", "root", "component")
    return nodes.join(named, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("rep")).otherwise(F.col("component")).alias("component"))


def near_duplicates(docs: DataFrame, ident: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, distance: int = DISTANCE,
                    segments: int = SEGMENTS, seed: int = SEED) -> DataFrame:
    """One row per input row: id, ``text_key``, ``fp``, ``root`` and ``component``."""
    src = docs.select(F.col(f"`{ident}`").alias("ident"), F.col(f"`{text}`").alias("text"),
                      F.xxhash64(F.col(f"`{text}`")).alias("text_key"))
    fps = staged(fingerprints(src, "text", ("ident", "text_key"), shingle, seed), "fingerprints")
    # staged, so that the join reads two plain shuffles and can split a hot fingerprint
    groups = staged(group_ids(fps, "ident", distance, segments), "fp-groups")
    return fps.join(groups, "fp").select(F.col("ident").alias(ident), "text_key", "fp", "root", "component")


def keep_one(docs: DataFrame, ident: str = "doc_id", text: str = "text",
             shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` without all but one document of each group.

    The group's smallest id stays (of equal ids that with the smaller text
    hash, of equal rows one); columns are those of ``docs``.
    """
    found = near_duplicates(docs, ident, text, shingle, distance)
    kept = found.groupBy("root").agg(
        F.min(F.struct(F.col(f"`{ident}`").isNull().alias("no_id"), F.col(f"`{ident}`").alias("ident"),
                       F.col("text_key"))).alias("best")).select("best.ident", "best.text_key")
    key, id_, key_, n = fresh(docs, "text_key", "ident", "kept_key", "n")
    kept = kept.select(F.col("ident").alias(id_), F.col("text_key").alias(key_))
    d = docs.withColumn(key, F.xxhash64(F.col(f"`{text}`")))
    d = d.join(kept, F.col(f"`{ident}`").eqNullSafe(F.col(id_)) & (F.col(key) == F.col(key_)), "left_semi")
    one = Window.partitionBy(F.col(f"`{ident}`"), F.col(key)).orderBy(F.lit(0))
    return d.withColumn(n, F.row_number().over(one)).where(F.col(n) == 1).select(
        *[F.col(f"`{c}`") for c in docs.columns])
