"""Uniform shuffle into shards of exact sizes by a hypergeometric matrix.

Rows fall into source blocks by a hash of their id.  How many rows block i gives
to shard j is drawn at once, as a matrix with the block sizes as row sums and
the exact shard sizes as column sums, each block's row being multivariate
hypergeometric given the blocks before it.  Each block is then permuted and
dealt by its counts, rows are exchanged, and each shard is permuted again: the
result is a uniform shuffle, and shard sizes differ by one row at most.

The second permutation orders a shard by a hash; it is cut into pieces of that
hash, so a shard is not the work of one task, and a piece starts where the
counts of the pieces before it end.  Those counts come from the id column alone.
All hashes are of the seed, the id and the place in the block, so a retried task
repeats itself.  DataFrame operations only; the driver holds blocks x shards
counts, where a block is ``block_rows`` rows or more.

Where ids recur, a hash of the whole row takes part in every hash and order, so
rows of one id and other contents have places of their own.  Rows equal in all of it
are alike, and which of them goes where is open; if more than a block of rows are
alike, they are numbered first (without meeting in one task) and the number takes part as well,
so that they spread over all blocks; there are fewer such groups than blocks.

Defined cases: rows with equal (or null) ids are rows like any other; a null text is kept; an empty table gives no rows; columns
of the input named ``shard`` or ``slot`` are replaced, those of any other name are kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import content, fresh, is_empty, numbered, staged, unit_hash

SHARDS, SEED, BLOCKS, BLOCK_ROWS = 8, 42, 512, 100_000
#: Counts (8 bytes each) up to which the matrix and the pieces' starts are broadcast.
BROADCAST_COUNTS = 2_000_000
#: numpy draws hypergeometric counts below this population.
DRAWN_DIRECTLY = 10 ** 9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """Good ones among ``sample`` drawn without replacement, for any population.

    Large populations: think of all members at random places in [0, 1].  Those
    left of sample / population are about as many as wanted; what is missing or
    too much is again a draw without replacement, of about the square root.
    """
    base, sign = 0, 1
    while good + bad >= DRAWN_DIRECTLY and 0 < sample < good + bad:
        p = sample / (good + bad)
        g, b = int(rng.binomial(good, p)), int(rng.binomial(bad, p))
        base += sign * g
        if g + b <= sample:
            good, bad, sample = good - g, bad - b, sample - g - b
        else:
            good, bad, sample, sign = g, b, g + b - sample, -sign
    if sample <= 0 or good <= 0:
        return base
    if sample >= good + bad:
        return base + sign * good
    return base + sign * (int(rng.hypergeometric(good, bad, sample)) if bad else sample)


def communication_matrix(block_sizes: list[int], shard_sizes: list[int], seed: int = SEED) -> np.ndarray:
    """Counts block x shard with exact row and column sums."""
    rng = np.random.default_rng(seed)
    room = np.array(shard_sizes, np.int64)
    out = np.zeros((len(block_sizes), len(shard_sizes)), np.int64)
    for i, n in enumerate(block_sizes):
        rest = int(room.sum())
        for j in range(len(room)):
            if not n:
                break
            rest -= int(room[j])
            out[i, j] = hypergeometric(rng, int(room[j]), rest, n)
            n -= int(out[i, j])
        room -= out[i]
    return out


def _dealt(rows: DataFrame, counts: DataFrame, n: dict[str, str], seed: int, pieces: int) -> DataFrame:
    """Adds shard, the second permutation's key and its piece to (id, block, tie, salt) rows."""
    own = [F.col(n[c]) for c in ("id", "tie", "salt")]
    order = [F.xxhash64(F.lit(seed), F.lit(1), *own), *own]
    place = F.row_number().over(Window.partitionBy(n["block"]).orderBy(*order)) - 1
    d = rows.withColumn(n["at"], place).join(counts, F.col(n["block"]) == F.col(n["of"]))
    d = d.withColumn("shard", F.size(F.filter(n["below"], lambda c: c <= F.col(n["at"]))).cast("int"))
    again = (F.lit(seed), F.lit(2), F.col(n["id"]), F.col(n["block"]), F.col(n["at"]))
    return d.withColumn(n["key"], F.xxhash64(F.lit(3), *again)).withColumn(
        n["piece"], F.floor(unit_hash(*again) * pieces).cast("int")).drop(n["of"], n["below"])


def _told_apart(rows: DataFrame, n: dict[str, str], keep: list[str], most: int) -> DataFrame:
    """Adds ``tie``, a hash of the row where ids recur, and ``salt``, a number of their own
    for rows of which more than ``most`` are alike."""
    id_, tie, salt = n["id"], n["tie"], n["salt"]
    none = F.lit(None).cast("long")
    recurs = rows.groupBy(id_).count().agg(F.max("count")).first()[0] or 0
    if recurs < 2:
        return rows.withColumn(tie, none).withColumn(salt, none)
    rows = rows.withColumn(tie, content(rows, keep))
    if recurs <= most:
        return rows.withColumn(salt, none)
    alike = staged(rows.groupBy(id_, tie).count().where(F.col("count") > most).select(
        F.col(id_).alias(n["of"]), F.col(tie).alias(n["below"]), F.lit(True).alias(n["hot"])), "shard-alike")
    if is_empty(alike):
        return rows.withColumn(salt, none)
    same = F.col(id_).eqNullSafe(F.col(n["of"])) & F.col(tie).eqNullSafe(F.col(n["below"]))
    marked = rows.join(F.broadcast(alike), same, "left").drop(n["of"], n["below"])
    hot = numbered(marked.where(n["hot"]).drop(n["hot"]), [id_, tie], salt)
    cold = marked.where(F.col(n["hot"]).isNull()).drop(n["hot"]).withColumn(salt, none)
    return staged(hot.unionByName(cold), "shard-rows")


def shard(docs: DataFrame, shards: int = SHARDS, ident: str = "doc_id", seed: int = SEED,
          blocks: int = BLOCKS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in its shard)."""
    spark = docs.sparkSession
    working = ("id", "block", "at", "key", "piece", "tie", "salt", "of", "below", "hot", "of_shard", "of_piece", "start", "rank")
    n = dict(zip(working, fresh(docs, *working)))
    keep = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    d = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ident}`").alias(n["id"]))
    total = d.count()
    blocks = max(blocks, -(-total // block_rows))
    pieces = -(-blocks // shards)
    d = _told_apart(d, n, keep, max(1, -(-total // blocks)))
    # nulls leave the hash as it is without them
    of: Column = F.pmod(F.xxhash64(F.lit(seed), *[F.col(n[c]) for c in ("id", "tie", "salt")]), F.lit(blocks)).cast("int")
    d = d.withColumn(n["block"], of)
    sizes = dict(d.groupBy(n["block"]).count().collect())
    order = sorted(sizes)
    matrix = communication_matrix([sizes[b] for b in order],
                                  [total // shards + (j < total % shards) for j in range(shards)], seed)
    counts = spark.createDataFrame(
        [(b, [int(x) for x in np.cumsum(row)]) for b, row in zip(order, matrix)],
        f"{n['of']} int, {n['below']} array<bigint>")
    small = blocks * shards <= BROADCAST_COUNTS
    counts = F.broadcast(counts) if small else counts

    ids = _dealt(d.select(*[n[c] for c in ("id", "block", "tie", "salt")]), counts, n, seed, pieces)
    before = Window.partitionBy("shard").orderBy(n["piece"]).rowsBetween(Window.unboundedPreceding, -1)
    start = staged(ids.groupBy("shard", n["piece"]).count().withColumn(
        n["start"], F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count"), "shard-pieces")
    start = start.toDF(n["of_shard"], n["of_piece"], n["start"])

    out = _dealt(d, counts, n, seed, pieces)
    rank = F.row_number().over(Window.partitionBy("shard", n["piece"]).orderBy(n["key"], n["block"], n["at"])) - 1
    same = (F.col("shard") == F.col(n["of_shard"])) & (F.col(n["piece"]) == F.col(n["of_piece"]))
    out = out.withColumn(n["rank"], rank).join(F.broadcast(start) if small else start, same)
    return out.select(*[F.col(f"`{c}`") for c in keep], "shard",
                      (F.col(n["rank"]) + F.col(n["start"])).cast("long").alias("slot"))
