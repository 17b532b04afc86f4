"""Sinks, checkpoints and triggers.

* ``snapshot_writer`` (S4): ``foreachBatch`` writing each micro-batch's
  output to ``<path>/batch_id=<n>`` with overwrite, so a re-executed batch
  replaces its own output (idempotent) and the table holds the state history.
  In ``complete`` mode every batch holds all keys (the reference's printout);
  in ``update`` mode only keys that changed.
* ``latest_per_key`` puts together what an update-mode query last wrote for each
  key; ``states`` reads states from a query's checkpoint.
* ``run`` starts a query with its own checkpoint folder (S5), a trigger
  (S6): ``availableNow`` for tests and catalogue runs, ``processingTime`` for
  a live job, and a number of state partitions.
* ``console`` (S3): the reference's per-batch printout.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def snapshot_writer(path: str):
    def write(batch_df: DataFrame, batch_id: int) -> None:
        # batch_id comes back as a partition column when the table is read.
        batch_df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


PARTITIONS_KEY = "spark.sql.shuffle.partitions"


def state_partitions(spark: SparkSession) -> int:
    """Partitions for a state of rows reduced before their shuffle: one wave of tasks.

    Every trigger opens and commits every partition of the state, empty ones too, so the
    shuffle partitions of a large batch would cost each trigger more than its rows do.
    """
    return min(int(spark.conf.get(PARTITIONS_KEY)), spark.sparkContext.defaultParallelism)


@contextmanager
def _shuffled_into(spark: SparkSession, n: int | None) -> Iterator[None]:
    """The session with ``n`` shuffle partitions; a query takes its own copy of the settings when it starts."""
    was = spark.conf.get(PARTITIONS_KEY, None)
    if n:
        spark.conf.set(PARTITIONS_KEY, n)
    try:
        yield
    finally:
        if n:
            spark.conf.unset(PARTITIONS_KEY) if was is None else spark.conf.set(PARTITIONS_KEY, was)


def run(df: DataFrame, checkpoint: str, sink_path: str | None = None,
        mode: str = "update", processing_time: str | None = None,
        query_name: str | None = None, writer=None, partitions: int | None = None) -> StreamingQuery:
    """Start a streaming query with a checkpoint folder of its own.

    Output goes to the snapshot table at ``sink_path``, or to a custom
    ``foreachBatch`` ``writer``, or to the console.  With ``processing_time``
    unset it runs ``availableNow`` and returns after all available input was
    processed.  ``partitions`` cuts the state of a new query, and any shuffle of its
    triggers; unset, the session's shuffle partitions do.
    """
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if writer is not None:
        w = w.foreachBatch(writer)
    elif sink_path is not None:
        w = w.foreachBatch(snapshot_writer(sink_path))
    else:
        w = w.format("console").option("truncate", "false")
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    with _shuffled_into(df.sparkSession, partitions):
        q = w.start()
    if processing_time:
        return q
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return q


def console(df: DataFrame, checkpoint: str, mode: str = "update",
            processing_time: str = "1 second") -> StreamingQuery:
    """S3: print each batch's output (the reference's ``print()``)."""
    return run(df, checkpoint, None, mode, processing_time)


def snapshots(spark: SparkSession, sink_path: str) -> DataFrame:
    """The whole snapshot table: (batch_id, state columns...)."""
    return spark.read.parquet(sink_path)


def latest_per_key(spark: SparkSession, sink_path: str, keys: Sequence[str]) -> DataFrame:
    """The rows that an update-mode query last wrote for each key (top-k lists have several).

    Reads everything the sink wrote; ``states.state_of`` reads the current states of a
    long run from its checkpoint instead.
    """
    rows = spark.read.parquet(sink_path)
    last = F.max("batch_id").over(Window.partitionBy(*keys))
    return rows.withColumn("_last", last).where("batch_id = _last").drop("batch_id", "_last")


def last_batch(spark: SparkSession, sink_path: str) -> DataFrame:
    """Rows of the last micro-batch (for ``complete`` mode: every key)."""
    t = spark.read.parquet(sink_path)
    last = t.select(F.max("batch_id")).scalar()
    return t.where(F.col("batch_id") == last).drop("batch_id")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def batch_folders(spark: SparkSession, path: str) -> list[int]:
    """Ids of the completely written ``batch_id=<n>`` folders under ``path``,
    listed through the Hadoop file system of the path."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    ids = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("batch_id="):
            done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
            if fs.exists(done):
                ids.append(int(name.split("=", 1)[1]))
    return sorted(ids)
