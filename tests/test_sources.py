"""Sources and sinks: keyed projections, key filter, console sink with a
processing-time trigger (S3, S6), snapshot table readers."""

import os

from pyspark.sql import functions as F

from mergestat.sources.tables import events_stream_view, keyed, keyed_event, only_key, table
from mergestat.streaming import queries as sq
from mergestat.streaming.sinks import batch_folders, console, last_batch, run, snapshots
from mergestat.streaming.sources import read_batches, write_batch_files
from tests.conftest import SF001


def test_keyed_projections(spark):
    ev = table(spark, SF001, "events")
    k = keyed(ev, "event_type", "value", extra=["ts"])
    assert k.columns == ["event_type", "ts", "value"]
    e = keyed_event(ev, "event_type", ["event_id", "value"])
    assert e.schema["event"].dataType.fieldNames() == ["event_id", "value"]
    assert only_key(ev, "event_type", "click").select("event_type").distinct().count() == 1
    v = events_stream_view(ev)
    assert set(v.columns) == {"label", "value", "ts", "event_id", "batch"}


def test_console_sink_processing_time(spark, tmp_dir):
    ev = table(spark, SF001, "events").withColumn("batch", F.to_date("ts"))
    folder = os.path.join(tmp_dir, "in")
    write_batch_files(ev, "batch", folder, num_files=2)
    s = read_batches(spark, folder, ev.schema, 1)
    q = console(sq.stream_sum(s, "event_type", "value"), os.path.join(tmp_dir, "ck"),
                processing_time="1 second")
    try:
        q.processAllAvailable()
        assert q.lastProgress is not None
    finally:
        q.stop()


def test_console_prints_each_batch(tmp_dir):
    """S3 prints from the JVM, so the test reads a process of its own."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from mergestat.session import get_session
from mergestat.streaming import queries as sq
from mergestat.streaming.sinks import run
spark = get_session("local[1]", shuffle_partitions=1)
spark.createDataFrame([("a", 1.5), ("a", 2.0)], "k string, v double").write.parquet({tmp_dir!r} + "/in")
s = spark.readStream.schema("k string, v double").parquet({tmp_dir!r} + "/in")
run(sq.stream_sum(s, "k", "v"), {tmp_dir!r} + "/ck", None, "complete")
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=200)
    assert "Batch: 0" in done.stdout and "|a  |3.5|" in done.stdout, done.stdout + done.stderr[-2000:]


def test_complete_mode_snapshots(spark, tmp_dir):
    ev = table(spark, SF001, "events").withColumn("batch", F.to_date("ts"))
    folder, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    write_batch_files(ev, "batch", folder, num_files=3)
    s = read_batches(spark, folder, ev.schema, 1)
    run(sq.stream_sum(s, "event_type", "value"), os.path.join(tmp_dir, "ck"), out, "complete")
    ids = batch_folders(spark, out)
    assert ids == [0, 1, 2]
    snap = snapshots(spark, out)
    # complete mode: every batch holds every key seen so far
    counts = [snap.where(F.col("batch_id") == i).count() for i in ids]
    assert counts == sorted(counts) and counts[-1] == 5
    assert last_batch(spark, out).count() == 5
