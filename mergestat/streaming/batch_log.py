"""An ordered micro-batch source over a table's own files.

A batch log is a small table in the shared folder: for every batch, in order, the
files that hold its rows and the range of the order column it covers there.
``write_log`` builds it with one Spark job that reads the order column and file names
alone; no row is copied or moved.  ``read_log`` is a streaming DataFrame whose
offset is the number of batches taken: every trigger takes the next batch whole, however
many rows it has, in the order of the log, and an offset read again gives the
same rows.  Entries appended later (``append=True``) are picked up by running
queries.

The batch of a row is a non-decreasing function of one order column (its week, its
day); rows without one form the first batch.  A batch is read by one task per
file and ``STRIPE_ROWS`` rows, from the row groups that can hold its range.

Tasks read the files with pyarrow.  Where these lie in a store that only Spark can
open, ``write_log`` first writes the table once into the shared folder and logs
those files.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from mergestat.session import scratch_path

# The driver's worker for a Python source gets no shipped files: the reader travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
NAME = "mergestat_batch_log"
#: Rows that one task reads of one file.
STRIPE_ROWS = 4_000_000


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def _readable(uri: str) -> bool:
    try:
        fs, path = _open(uri)
        return fs.get_file_info(path).is_file
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False


def write_log(df: DataFrame, batch: Column, order: str, log: str | None = None, append: bool = False) -> str:
    """Log the batches of ``df``, a plain read of Parquet files; returns the log's path.

    With ``append`` the batches of ``df`` follow those the log already has.
    """
    spark = df.sparkSession
    log = log or scratch_path(spark, "batch-log")
    one = df.select("_metadata.file_path").limit(1).collect()
    if one and not _readable(one[0][0]):
        copy = f"{log}/files"
        df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), order).write.mode("append").parquet(copy)
        df = spark.read.schema(df.schema).parquet(copy)
    known = max(batch_values(spark, log), default=-1) + 1 if append else 0
    entries = df.select(batch.alias("batch"), F.col("_metadata.file_path").alias("file"), F.col(order).alias("o")) \
        .groupBy("batch", "file").agg(F.count(F.lit(1)).alias("rows"), F.min("o").alias("low"), F.max("o").alias("high"))
    # one row per batch and file of it: small enough to be numbered in one window
    number = (F.dense_rank().over(Window.orderBy("batch")) - 1 + known).cast("int")
    entries.withColumn("number", number).write.mode("append").partitionBy("number").parquet(f"{log}/entries")
    return log


def batch_values(spark: SparkSession, log: str) -> dict[int, object]:
    """The value of every batch by number: one row per batch."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{log}/entries")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return {}
    found = spark.read.parquet(f"{log}/entries").select("number", "batch").distinct().collect()
    return dict(sorted(((r["number"], r["batch"]) for r in found), key=lambda x: x[0]))


def batches_of(spark: SparkSession, log: str, checkpoint: str) -> DataFrame:
    """(batch_id, batch): the value of the batch that each trigger of a query took."""
    values = batch_values(spark, log)
    kind = spark.read.parquet(f"{log}/entries").schema["batch"].dataType
    at = {n: _offset(text) for n, text in _offsets(spark, checkpoint).items()}
    rows = [(n, values[k - 1]) for n, k in at.items() if k > at.get(n - 1, 0)]
    return spark.createDataFrame(rows, T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("batch", kind)]))


def _offsets(spark: SparkSession, checkpoint: str) -> dict[int, str]:
    """The planned offsets of every trigger, as the checkpoint has them."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder) or not any(s.getPath().getName().isdigit() for s in fs.listStatus(folder)):
        return {}
    found = spark.sparkContext.wholeTextFiles(f"{checkpoint}/offsets/[0-9]*").collect()      # 100 small files are kept
    return {int(name.rsplit("/", 1)[1]): text for name, text in found}


def _offset(text: str) -> int:
    return json.loads(text.strip().splitlines()[-1])["batches"]


def taken(spark: SparkSession, checkpoint: str) -> int:
    """Batches that a query has planned so far."""
    offsets = _offsets(spark, checkpoint)
    return _offset(offsets[max(offsets)]) if offsets else 0


def read_log(spark: SparkSession, log: str, schema: T.StructType, order: str, checkpoint: str | None = None,
             skip: int = 0) -> DataFrame:
    """A stream of the log's batches, one a trigger, behind the first ``skip``.

    ``checkpoint`` is that of the query it will feed; a query that goes on from one
    needs it here, so that the source knows which batches were taken.
    """
    spark.dataSource.register(BatchLogSource)
    after = max(skip, taken(spark, checkpoint) if checkpoint else 0)
    return spark.readStream.format(NAME).schema(schema).option("log", log).option("order", order).option("after", after).load()


class Stripe(InputPartition):
    """Row groups ``k``, ``k + of``, ... of a file, and the range of the order column."""

    def __init__(self, file: str, low, high, k: int, of: int):
        self.file, self.low, self.high, self.k, self.of = file, low, high, k, of


class BatchLogReader(DataSourceStreamReader):
    def __init__(self, log: str, order: str, after: int, schema: T.StructType):
        self.log, self.order, self.at = log, order, after
        self.names, self.arrow = schema.names, to_arrow_schema(schema)

    def _numbers(self) -> dict[int, str]:
        fs, path = _open(f"{self.log}/entries")
        found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        return {int(i.base_name.split("=")[1]): i.path for i in found if i.base_name.startswith("number=")}

    def initialOffset(self) -> dict:
        return {"batches": self.at}

    def latestOffset(self) -> dict:
        # the next batch only: it becomes the start once Spark has planned it
        return {"batches": min(self.at + 1, len(self._numbers()))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = max(self.at, end["batches"])
        fs, _ = _open(f"{self.log}/entries")
        folders, out = self._numbers(), []
        for n in range(start["batches"], end["batches"]):
            for info in fs.get_file_info(pafs.FileSelector(folders[n])):
                if info.base_name.endswith(".parquet") and info.size:
                    for r in pq.read_table(info.path, filesystem=fs, partitioning=None).to_pylist():
                        of = -(-r["rows"] // STRIPE_ROWS)
                        out += [Stripe(r["file"], r["low"], r["high"], k, of) for k in range(of)]
        return out or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, Stripe):
            return
        fs, path = _open(partition.file)
        with pq.ParquetFile(fs.open_input_file(path)) as file:
            place = file.schema_arrow.get_field_index(self.order)
            kind = file.schema_arrow.field(self.order).type
            low, high = (None if x is None else pa.scalar(x).cast(kind) for x in (partition.low, partition.high))
            groups = [g for g in range(partition.k, file.metadata.num_row_groups, partition.of)
                      if self._may_hold(file.metadata.row_group(g), place, low, high, kind)]
            if not groups:
                return
            for b in file.iter_batches(row_groups=groups, columns=self.names):
                o = b.column(self.names.index(self.order))
                inside = pc.is_null(o) if low is None else pc.and_(pc.greater_equal(o, low), pc.less_equal(o, high))
                b = b.filter(inside)
                if b.num_rows:
                    yield pa.RecordBatch.from_arrays([b.column(c).cast(f.type) for c, f in zip(self.names, self.arrow)], schema=self.arrow)

    @staticmethod
    def _may_hold(group, place: int, low, high, kind) -> bool:
        stats = group.column(place).statistics if not kind.num_fields else None
        if stats is None or low is None:
            return True
        if not stats.has_min_max:
            return stats.null_count != group.num_rows
        least, most = (pa.scalar(x).cast(kind) for x in (stats.min, stats.max))
        return not (pc.greater(least, high).as_py() or pc.less(most, low).as_py())


class BatchLogSource(DataSource):
    """Options: ``log``, ``order``, and ``after``, the batches already taken."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema: T.StructType) -> BatchLogReader:
        return BatchLogReader(self.options["log"], self.options["order"], int(self.options.get("after", 0)), schema)
