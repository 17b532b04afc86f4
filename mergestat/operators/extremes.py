"""k largest / j smallest values per key (T1, T2, and the batch form of T3).

Batch plan: ``row_number() over (partition by key order by value)`` filtered
to ``<= k``.  Catalyst turns the filter into a ``WindowGroupLimit`` that runs
*before* the shuffle, so each map task ships at most k rows per key — a key
holding a third of the table costs k rows per task, not a third of the table.

Semantics: a multiset (duplicates kept); NULL and NaN values never enter
(NaN sorts above every number in Spark, so it is filtered); fewer than k
values give fewer rows.  Ties are broken by the ``tiebreak`` columns so the
rank assignment is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergestat.sources.tables import key_names


def _clean(df: DataFrame, value: str) -> DataFrame:
    v = F.col(value)
    return df.where(v.isNotNull() & ~F.isnan(v))


def _ranked(df: DataFrame, keys, value: str, n: int, descending: bool,
            tiebreak: Sequence[str]) -> DataFrame:
    ks = key_names(keys)
    order = [F.col(value).desc() if descending else F.col(value).asc()]
    order += [F.col(c).asc() for c in tiebreak]
    w = Window.partitionBy(*ks).orderBy(*order)
    return (_clean(df.select(*ks, value, *tiebreak), value)
            .withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n)
            .select(*ks, F.col("rank").cast("bigint").alias("rank"), value))


def k_largest(df: DataFrame, keys, value: str, k: int = 4,
              tiebreak: Sequence[str] = ()) -> DataFrame:
    """Rows (key..., rank, value) for the k largest values per key."""
    return _ranked(df, keys, value, k, True, tiebreak)


def j_smallest(df: DataFrame, keys, value: str, j: int = 3,
               tiebreak: Sequence[str] = ()) -> DataFrame:
    """Rows (key..., rank, value) for the j smallest values per key."""
    return _ranked(df, keys, value, j, False, tiebreak)


def extremes(df: DataFrame, keys, value: str, k: int = 4, j: int = 3,
             tiebreak: Sequence[str] = ()) -> DataFrame:
    """Both lists in one long table: (key..., side, rank, value).

    One scan, one sort and one shuffle: every row stands once for either side,
    under its value or its negative, and the larger of the two limits applies
    before the shuffle.
    """
    ks = key_names(keys)
    v = F.col(value)
    if isinstance(df.schema[value].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        v = v.cast("decimal(20,0)")             # the smallest integer has no negative
    sides = F.explode(F.array(F.struct(F.lit("largest").alias("side"), (-v).alias("by")),
                              F.struct(F.lit("smallest").alias("side"), v.alias("by"))))
    both = _clean(df.select(*ks, value, *tiebreak), value).select("*", sides.alias("_s")).select("*", "_s.side", "_s.by")
    w = Window.partitionBy(*ks, "side").orderBy("by", *[F.col(c).asc() for c in tiebreak])
    limit = F.when(F.col("side") == "largest", k).otherwise(j)
    return (both.withColumn("rank", F.row_number().over(w))
                .where(F.col("rank") <= max(k, j)).where(F.col("rank") <= limit)
                .select(*ks, "side", F.col("rank").cast("bigint").alias("rank"), value))


def extremes_arrays(df: DataFrame, keys, value: str, k: int = 4, j: int = 3,
                    tiebreak: Sequence[str] = ()) -> DataFrame:
    """The state as arrays: per key, ``largest`` (descending, <= k)
    and ``smallest`` (ascending, <= j) arrays.  Built from the limited long
    form, so each collected list holds at most k or j values."""
    ks = key_names(keys)
    long = extremes(df, keys, value, k, j, tiebreak)
    pair = F.struct("rank", value)

    def side(name: str) -> Column:
        return F.transform(
            F.array_sort(F.collect_list(F.when(F.col("side") == name, pair))),
            lambda s: s[value])
    return long.groupBy(*ks).agg(side("largest").alias("largest"),
                                 side("smallest").alias("smallest"))
