"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same number of copies,
target / source size.  The whole part is certain; the fraction is settled by
pairing: two documents with fractional copies exchange words (fraction times
document size) in a random direction, chosen so that each keeps its expected
copies, until one of the two is integral and leaves; the other goes on as the
residual.  Words are conserved in every exchange, so all that a source can miss
of its target is the rounding of its last residual.

A document of more than one part in 2 x ``fan`` of its source would leave too much
to the last residual.  Such documents, fewer than 2 x ``fan`` of a source, come
first, the largest ahead: each is settled in one exchange with all that follow,
whose common fraction takes up the difference (where they cannot, it goes to the
nearer whole).

The pairings form a reduction tree.  Documents fall into groups of about ``fan``
by a hash of their id; each group is folded to one residual, residuals of
``fan`` neighbouring groups meet on the next level, and so on to one residual
per source, which goes to the nearer whole: a source misses its target by half a
document at most.  A group pairs its largest documents first, so that the last
residual tends to be a small one.  A hot source only has more groups.  All
randomness is a hash of the seed and the ids in the pair, so reruns and retried
tasks agree whatever the partitioning.  DataFrame operations only.

Defined cases: a null text or one without words has size 0, counts nothing and
is copied round(target / source size) times; a null source is a source of its
own, ordered last; rows that agree in id, source and size form one unit whose
copies are dealt evenly among them; a source without words has target 0; an
empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, content, fresh, numbered, staged, unit_hash

WEIGHTS, LIMIT, FAN, SEED = (1, 2, 3), 3, 32, 42
#: Most sources whose table is broadcast (about 100 bytes each).
BROADCAST_ROWS = 100_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with its 0-based position in a total order, without a global sort task.

    Range partitions are numbered by a window of their own; offsets come from
    one count per partition.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = staged(df.repartitionByRange(n, *order).withColumn("__p", F.spark_partition_id()), "ranked")
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offset = d.groupBy("__p").count().withColumn(
        "__o", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    own = F.row_number().over(Window.partitionBy("__p").orderBy(*order)) - 1
    return d.withColumn("__n", own).join(F.broadcast(offset), "__p") \
        .withColumn(name, F.col("__n") + F.col("__o")).drop("__p", "__n", "__o")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT,
            share: float = 1.0) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources by code point, null last, take the weights in turn.  Targets share
    ``share`` of all sizes by weight; a target above ``limit`` times its
    source's size stops there and what it leaves is shared again, until none is
    above.
    """
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.col("rank") % len(weights) + 1).cast("int"))
    src = staged(ranked(src, [F.col("source").asc_nulls_last()]).withColumn("w", turn), "sources")
    cap = limit * F.col("source_size")
    goal = share * (src.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        full = cap <= level * F.col("w")
        held, open_w, n = src.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("w"))),
                                  F.count_if(full)).first()
        if not open_w or n == capped:
            break
        capped, level = n, (goal - (held or 0)) / open_w
    return src.select("source", "source_size", F.least(cap, level * F.col("w")).cast("double").alias("target"))


def _fold(seed: int, level: int) -> Column:
    """(done, carry) of the sorted array ``units`` by pairing along it."""
    def pair(state, x):
        def settle(v):
            c, x = v["c"], v["x"]
            into_c = F.least(c["size"] - c["mass"], x["mass"])
            into_x = F.least(x["size"] - x["mass"], c["mass"])
            up_c = v["u"] * (into_c + into_x) < into_x

            def result(leaves, up, stays, mass):
                return F.struct(
                    F.concat(state["done"], F.array(_decided(leaves, up))).alias("done"),
                    stays.withField("mass", mass).alias("carry"))

            return (F.when(up_c & (c["size"] - c["mass"] <= x["mass"]),
                           result(c, F.lit(1), x, x["mass"] - (c["size"] - c["mass"])))
                    .when(up_c, result(x, F.lit(0), c, c["mass"] + x["mass"]))
                    .when(x["size"] - x["mass"] <= c["mass"],
                          result(x, F.lit(1), c, c["mass"] - (x["size"] - x["mass"])))
                    .otherwise(result(c, F.lit(0), x, x["mass"] + c["mass"])))

        c = state["carry"]
        u = unit_hash(F.lit(seed), F.lit(level), c["ident"], c["size"], x["ident"], x["size"])
        bound = F.array(F.struct(c.alias("c"), x.alias("x"), u.alias("u")))
        return F.when(c.isNull(), F.struct(state["done"].alias("done"), x.alias("carry"))).otherwise(
            F.transform(bound, settle)[0])

    first = F.element_at("units", 1)
    empty = F.filter(F.array(_decided(first, F.lit(0))), lambda _: F.lit(False))
    nothing = F.when(F.lit(False), first)
    return F.aggregate("units", F.struct(empty.alias("done"), nothing.alias("carry")), pair)


def _decided(unit: Column, up: Column) -> Column:
    return F.struct(unit["ident"].alias("ident"), unit["size"].alias("size"), unit["m"].alias("m"),
                    unit["whole"].alias("whole"), up.alias("up"))


def _long_documents(unit: DataFrame, limit: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Decisions on the long units of each source, and (of_source, left, words):
    what they leave of the target for how many words of the other units."""
    order = F.xxhash64(F.lit(seed), "ident", "size")
    one = F.struct((-F.col("size")).alias("largest_first"), order.alias("order"), "ident", "size", "m")
    group = unit.groupBy("source").agg(F.first("target").alias("target"), F.first("source_size").alias("source_size"),
                                       F.sort_array(F.collect_list(one)).alias("units"))

    def settle(state, x):
        rate = F.greatest(F.lit(0.0), F.least(F.lit(float(limit)), state["left"] / state["words"]))

        def taken(v):
            whole = F.floor(v)
            # what the others could not take up if this one is rounded up, or down
            left = state["left"] - whole * x["size"]
            words = (state["words"] - x["m"] * x["size"]).cast("long")
            over, under = F.greatest(x["size"] - left, F.lit(0.0)), F.greatest(left - limit * words, F.lit(0.0))
            coin = unit_hash(F.lit(seed), F.lit(-2), x["ident"], x["size"]) < v - whole
            up = ((v > whole) & F.when((over == 0) & (under == 0), coin).otherwise(over <= under)).cast("long")
            done = F.struct(x["ident"].alias("ident"), x["size"].alias("size"), x["m"].alias("m"),
                            (whole + up).alias("copies"))
            return F.struct(F.concat(state["done"], F.array(done)).alias("done"),
                            (left - up * x["size"]).alias("left"), words.alias("words"))
        return F.transform(F.array(rate * x["m"]), taken)[0]

    first = F.element_at("units", 1)
    empty = F.filter(F.array(F.struct(first["ident"].alias("ident"), first["size"].alias("size"), first["m"].alias("m"),
                                      F.lit(0).cast("long").alias("copies"))), lambda _: F.lit(False))
    out = staged(group.select("source", F.aggregate(
        "units", F.struct(empty.alias("done"), F.col("target").alias("left"), F.col("source_size").cast("long").alias("words")),
        settle).alias("r")), "mix-long")
    decided = out.select("source", F.explode("r.done").alias("d")).select("d.ident", "source", "d.size", "d.m", "d.copies")
    return decided, out.select(F.col("source").alias("of_source"), "r.left", "r.words")


def decide(sizes: DataFrame, goal: DataFrame, limit: float = LIMIT, fan: int = FAN, seed: int = SEED) -> DataFrame:
    """(ident, source, size, m, copies): copies of each unit of m equal rows.

    ``sizes`` has ident, source and size; ``goal`` is from ``targets``.
    """
    if goal.count() <= BROADCAST_ROWS:
        goal = F.broadcast(goal)
    unit = sizes.groupBy("ident", "source", "size").agg(F.count("*").alias("m"))
    unit = unit.join(goal, unit.source.eqNullSafe(goal.source)).drop(goal.source)
    long = F.col("size") * (2 * fan) > F.col("source_size")
    unit = staged(unit.withColumn("long", long), "mix-units")
    settled, rest = _long_documents(unit.where("long"), limit, seed)
    settled = [settled]
    if rest.count() <= BROADCAST_ROWS:
        rest = F.broadcast(rest)
    unit = unit.where(~F.col("long")).join(rest, unit.source.eqNullSafe(F.col("of_source")), "left")
    left, words = F.coalesce("left", "target"), F.coalesce("words", "source_size")
    each = F.when(words > 0, F.greatest(F.lit(0.0), F.least(F.lit(float(limit)), left / words))).otherwise(F.lit(0.0))
    unit = unit.withColumn("all", F.col("m") * each).withColumn("whole", F.floor("all")).select(
        "ident", "source", "size", "m", "whole", (F.col("all") - F.col("whole")).alias("part"))
    open_ = (F.col("size") > 0) & (F.col("part") > 0)
    settled.append(unit.where(~open_).select(
        "ident", "source", "size", "m", (F.col("whole") + F.round("part").cast("long")).alias("copies")))

    live = unit.where(open_)
    per = live.groupBy("source").agg(F.ceil(F.count("*") / fan).alias("groups"))
    widest = per.agg(F.max("groups")).first()[0]
    if widest is None:
        return settled[0].union(settled[1])
    if per.count() <= BROADCAST_ROWS:
        per = F.broadcast(per)
    order = F.xxhash64(F.lit(seed), "ident", "size")
    rows = live.join(per, live.source.eqNullSafe(per.source)).drop(per.source).select(
        "source", F.pmod(F.shiftright(order, 20), F.col("groups")).alias("g"),
        F.struct((-F.col("size")).alias("largest_first"), order.alias("order"), "ident", "size", "m", "whole",
                 (F.col("part") * F.col("size")).alias("mass")).alias("unit"))
    levels = 1 + max(0, math.ceil(math.log(widest, fan) - 1e-12)) if widest > 1 else 1
    for level in range(levels):
        group = rows.groupBy("source", "g").agg(F.sort_array(F.collect_list("unit")).alias("units"))
        out = staged(group.select("source", "g", _fold(seed, level).alias("r"))
                     .select("source", "g", "r.done", "r.carry"), f"mix-level{level}")
        settled.append(out.select("source", F.explode("done").alias("d")).select(
            "d.ident", "source", "d.size", "d.m", (F.col("d.whole") + F.col("d.up")).alias("copies")))
        rows = out.select("source", F.floor(F.col("g") / fan).alias("g"), F.col("carry").alias("unit"))
    last = (2 * F.col("unit.mass") >= F.col("unit.size")).cast("long")
    settled.append(rows.select("unit.ident", "source", "unit.size", "unit.m",
                               (F.col("unit.whole") + last).alias("copies")))
    found = settled[0]
    for s in settled[1:]:
        found = found.union(s)
    return found


def mix(docs: DataFrame, ident: str = "doc_id", source: str = "source", text: str = "text",
        weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT, share: float = 1.0,
        fan: int = FAN, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all) of ``docs`` with size, source_size, target, copies and taken.

    Columns of ``docs`` of those five names are replaced.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    keep = [c for c in (keep or docs.columns) if c.lower() not in added]
    i, s, z, n = fresh(docs, "ident", "source", "size", "n")
    d = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ident}`").alias(i),
                    F.col(f"`{source}`").alias(s), word_count(F.col(f"`{text}`")).alias(z))
    sizes = staged(d.select(F.col(i).alias("ident"), F.col(s).alias("source"), F.col(z).alias("size")), "mix-sizes")
    if {ident, source} >= set(keep):
        # nothing but the measured columns is asked for: they need not be read again
        d = sizes.select(*[F.col("ident" if c == ident else "source").alias(c) for c in keep],
                         F.col("ident").alias(i), F.col("source").alias(s), F.col("size").alias(z))
    goal = staged(targets(sizes, weights, limit, share), "mix-targets")
    found = staged(decide(sizes, goal, limit, fan, seed), "mix-decided")
    alike = found.agg(F.max("m")).first()[0] or 1
    fi, fs, fz, fm, fk, gs, tie, place = fresh(docs, "of_ident", "of_source", "of_size", "m", "k", "goal_source", "tie", "place")
    found = found.toDF(fi, fs, fz, fm, fk)
    out = d.join(found, F.col(i).eqNullSafe(F.col(fi)) & F.col(s).eqNullSafe(F.col(fs)) & (F.col(z) == F.col(fz)))
    copies = F.col(fk)
    if alike > 1:
        # rows of one unit by a hash of their contents; equal ones are numbered as they come
        out = numbered(out.withColumn(tie, content(out.select(*[f"`{c}`" for c in keep]))), [i, s, z, tie], n)
        ahead = Window.partitionBy(i, s, z).orderBy(tie).rowsBetween(Window.unboundedPreceding, -1)
        starts = out.where(F.col(fm) > 1).groupBy(i, s, z, tie).count().withColumn(
            place, F.coalesce(F.sum("count").over(ahead), F.lit(0))).drop("count")
        ki, ks, kz, kt = fresh(out, "place_ident", "place_source", "place_size", "place_tie")
        starts = starts.toDF(ki, ks, kz, kt, place)
        same = F.col(i).eqNullSafe(F.col(ki)) & F.col(s).eqNullSafe(F.col(ks)) & (F.col(z) == F.col(kz)) & (F.col(tie) == F.col(kt))
        out = out.join(starts, same, "left")
        at = F.coalesce(F.col(place), F.lit(0)) + F.col(n)
        copies = F.floor(F.col(fk) / F.col(fm)) + (at < F.col(fk) % F.col(fm)).cast("long")
    goal = goal.toDF(gs, "source_size", "target")
    if goal.count() <= BROADCAST_ROWS:
        goal = F.broadcast(goal)
    out = out.withColumn("copies", copies).join(goal, F.col(s).eqNullSafe(F.col(gs)))
    return out.select(*[F.col(f"`{c}`") for c in keep], F.col(z).alias("size"), "source_size", "target",
                      "copies", (F.col("copies") * F.col(z)).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken."""
    copies = fresh(docs, "copies")[0]
    clash = [c for c in docs.columns if c.lower() in ("size", "source_size", "target", "copies", "taken")]
    own = dict(zip(clash, fresh(docs, *[f"own_{c}" for c in clash])))
    out = mix(docs.withColumnsRenamed(own), **options).withColumnRenamed("copies", copies)
    out = out.where(F.col(copies) > 0).withColumn(
        copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    return out.select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns])
