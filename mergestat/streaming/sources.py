"""Micro-batch sources.

The reference feeds a queue of in-memory datasets, one per batch.  Here there are two
ways to have a table in batches:

* ``write_batch_files`` — one Spark job, range-partitioned on (batch, order)
  so every file holds a contiguous slice of one batch, in a folder watched by
  Spark's file source.  File arrival order is not guaranteed, so this suits
  order-insensitive statistics (sums, moments, histograms, registers, extremes),
  with ``maxFilesPerTrigger`` cutting the folder into several micro-batches.
* ``batch_log`` — the batches of a table as ranges of its own files, one a
  trigger, in order, without a copy.  Order-sensitive state (Kalman, per-batch
  snapshots) needs this.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Least number of triggers of a folder, and the rows that a batch file has at least (but for
#: small tables) and about at most.
TRIGGERS, LEAST_ROWS, MOST_ROWS = 3, 20_000, 1_000_000


def write_batch_files(df: DataFrame, batch: str, path: str,
                      order: Sequence[str] = (), num_files: int | None = None) -> None:
    n = num_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, batch, *order)
       .write.mode("overwrite").parquet(path))


def batch_plan(rows: int, cores: int) -> tuple[int, int]:
    """(files, files per trigger) for a table of so many rows.

    A trigger takes a file for each core, and more triggers come only once files are full: triggers
    grow with the rows, whatever the session's shuffle partitions are.
    """
    at_once = max(1, min(cores, -(-rows // (TRIGGERS * LEAST_ROWS))))
    return max(TRIGGERS, -(-rows // (at_once * MOST_ROWS))) * at_once, at_once


def read_batches(spark: SparkSession, path: str, schema: StructType,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame over the batch folder."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)
