"""Staging and typing helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: A run of characters other than space and the controls 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage: what lies above is not recomputed by later branches, and a
    lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_empty(df: DataFrame) -> bool:
    return not df.limit(1).count()


def unit_hash(*cols) -> F.Column:
    """A uniform number in [0, 1) fixed by the values of ``cols``."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) / F.lit(float(1 << 52))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working column names that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        name = f"__{n}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def content(df: DataFrame, columns=None) -> F.Column:
    """A hash of a row's values, of all columns that can be hashed."""
    def plain(kind):
        parts = [getattr(kind, a) for a in ("elementType", "valueType") if hasattr(kind, a)] + [f.dataType for f in getattr(kind, "fields", [])]
        return kind.typeName() not in ("map", "variant") and all(map(plain, parts))
    names = [f.name for f in df.schema.fields if plain(f.dataType) and (columns is None or f.name in columns)]
    return F.xxhash64(*[F.col(f"`{c}`") for c in names]) if names else F.lit(0).cast("long")


def numbered(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Numbers the rows of equal ``keys`` from 0, which of them gets which being open.

    Rows are staged and numbered within their partition, behind the counts of the
    partitions before it, so no group meets in one task.
    """
    part, own, start, *marks = fresh(df, "part", "own", "start", *[f"key{i}" for i in range(len(keys))])
    held = staged(df.withColumn(part, F.spark_partition_id()), "numbered")
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = held.groupBy(*keys, part).count().withColumn(start, F.coalesce(F.sum("count").over(before), F.lit(0)))
    other = fresh(df, "part_of")[0]
    starts = starts.select(*[F.col(k).alias(m) for k, m in zip(keys, marks)], F.col(part).alias(other), start)
    same = F.col(part) == F.col(other)
    for k, m in zip(keys, marks):
        same &= F.col(k).eqNullSafe(F.col(m))
    place = F.row_number().over(Window.partitionBy(*keys, part).orderBy(F.lit(0))) - 1
    return held.withColumn(own, place).join(starts, same).withColumn(name, F.col(own) + F.col(start)).drop(
        part, own, start, other, *marks)
