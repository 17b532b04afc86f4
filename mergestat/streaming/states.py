"""States read back from a query's checkpoint.

Spark's state data source reads the state store of any retained batch, so the
states of all keys after each batch need no second copy: keys that a batch did not
touch are there as they were.  ``state_of`` reads one batch; ``history_of`` puts the
batches of a run one below the other; ``changes`` reads what each batch changed, where
the store keeps a change log.

Buffers of native aggregations come as one struct in the order of the aggregate
functions; ``names`` gives its fields names of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _named(df: DataFrame, names: Sequence[str] | None) -> DataFrame:
    keys = df.schema["key"].dataType.names
    value = df.schema["value"].dataType
    if names:
        if len(names) != len(value.fields):
            raise ValueError(f"the state has {len(value.fields)} fields: {value.simpleString()}")
        value = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, value.fields)])
    return df.withColumn("value", F.col("value").cast(value)).select(
        *[c for c in df.columns if c not in ("key", "value", "partition_id")],
        *[F.col("key").getField(k).alias(k) for k in keys], "value.*")


def _reader(spark: SparkSession, variable: str | None, operator: int):
    r = spark.read.format("statestore").option("operatorId", operator)
    return r.option("stateVarName", variable) if variable else r


def batches_kept(spark: SparkSession, checkpoint: str, operator: int = 0) -> range:
    """Ids of the batches whose states the store still has."""
    row = spark.read.format("state-metadata").load(checkpoint).where(F.col("operatorId") == operator).first()
    return range(row["minBatchId"], row["maxBatchId"] + 1)


def state_of(spark: SparkSession, checkpoint: str, batch_id: int | None = None, variable: str | None = None,
             names: Sequence[str] | None = None, operator: int = 0) -> DataFrame:
    """(key..., state fields...) of all keys after a batch, by default the last one."""
    r = _reader(spark, variable, operator)
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    return _named(r.load(checkpoint), names)


def history_of(spark: SparkSession, checkpoint: str, batch_ids: Sequence[int], variable: str | None = None,
               names: Sequence[str] | None = None, operator: int = 0) -> DataFrame:
    """(batch_id, key..., state fields...) of all keys after each of the given batches."""
    return reduce(DataFrame.unionByName, (
        state_of(spark, checkpoint, n, variable, names, operator).withColumn("batch_id", F.lit(n).cast("long")) for n in batch_ids))


def changes(spark: SparkSession, checkpoint: str, first: int, last: int | None = None, variable: str | None = None,
            names: Sequence[str] | None = None, operator: int = 0) -> DataFrame:
    """(batch_id, change_type, key..., state fields...) of what batches ``first`` to ``last`` changed.

    Needs a query that ran with ``spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled``.
    """
    r = _reader(spark, variable, operator).option("readChangeFeed", "true").option("changeStartBatchId", first)
    if last is not None:
        r = r.option("changeEndBatchId", last)
    return _named(r.load(checkpoint), names)
