"""The ordered source: whole batches in order, replays, restarts, growth, odd files."""

import datetime as dt
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mergestat.streaming import batch_log as bl
from mergestat.streaming.sinks import run
from tests.conftest import SF001


T0 = dt.date(1970, 1, 1)


def reader(log, schema, order, after=0):
    return bl.BatchLogSource({"log": log, "order": order, "after": str(after)}).streamReader(schema)


def rows_of(r, start, end):
    parts = r.partitions({"batches": start}, {"batches": end})
    return sorted((tuple(x.values()) for p in parts for b in r.read(p) for x in b.to_pylist()), key=str)


def odd_table(spark, folder):
    """Four files that each hold several batches, without an order, with rows of no batch."""
    rows = [(i, None if i % 5 == 0 else dt.datetime(2024, 1, 1 + (i * 7) % 5, i % 24, 0, 0, i), None if i % 3 else f"t{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, ts timestamp, t string")
    df.repartition(4).write.parquet(folder)
    return spark.read.parquet(folder)


def test_batches_are_whole_and_replay_alike(spark, tmp_dir):
    df = odd_table(spark, tmp_dir + "/t")
    log = bl.write_log(df, F.to_date("ts"), "ts")
    values = bl.batch_values(spark, log)
    assert list(values.values()) == sorted(values.values(), key=lambda d: (d is not None, d or T0)) and values[0] is None
    r = reader(log, df.schema, "ts")
    whole = [rows_of(r, n, n + 1) for n in range(len(values))]
    assert whole == [rows_of(reader(log, df.schema, "ts"), n, n + 1) for n in range(len(values))]
    assert rows_of(r, 0, len(values)) == sorted((x for b in whole for x in b), key=str)
    for n, day in values.items():
        want = df.where(F.to_date("ts").eqNullSafe(F.lit(day))).select("id").collect()
        assert sorted(x[0] for x in whole[n]) == sorted(x[0] for x in want)
    assert r.partitions({"batches": 2}, {"batches": 2})[0].value is None and rows_of(r, 2, 2) == []


def test_stripes_share_a_file(spark, tmp_dir, monkeypatch):
    import pyarrow.parquet as pq
    os.makedirs(tmp_dir + "/t")
    table = pa.table({"id": pa.array(range(1000), pa.int64()), "b": pa.array([i // 300 for i in range(1000)], pa.int32())})
    pq.write_table(table, tmp_dir + "/t/part-0.parquet", row_group_size=100)
    df = spark.read.parquet(tmp_dir + "/t")
    log = bl.write_log(df, F.col("b"), "b")
    monkeypatch.setattr(bl, "STRIPE_ROWS", 70)
    r = reader(log, df.schema, "b")
    parts = r.partitions({"batches": 0}, {"batches": 1})
    assert len(parts) == 5 and [x[0] for x in sorted(rows_of(r, 0, 1))] == list(range(300))
    # row groups out of range are not read
    meta = pq.ParquetFile(tmp_dir + "/t/part-0.parquet").metadata
    held = [bl.BatchLogReader._may_hold(meta.row_group(g), 1, pa.scalar(0, pa.int32()), pa.scalar(0, pa.int32()), pa.int32()) for g in range(10)]
    assert held == [True] * 3 + [False] * 7


def test_one_batch_a_trigger_restarts_and_growth(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    week = F.to_date(F.date_trunc("week", "ts"))
    early = ev.where("ts < '2024-01-15'")
    early.write.parquet(tmp_dir + "/a")
    log = bl.write_log(spark.read.parquet(tmp_dir + "/a"), week, "ts")
    seen = []

    def go(fail_at=None):
        def writer(df, n):
            if n == fail_at:
                raise RuntimeError("lost")
            seen.append((n, sorted(r["event_id"] for r in df.select("event_id").collect())))
        s = bl.read_log(spark, log, ev.schema, "ts", tmp_dir + "/ck")
        q = run(s, tmp_dir + "/ck", None, "append", processing_time="0 seconds", writer=writer)
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    with pytest.raises(Exception):
        go(fail_at=1)
    go()                                     # trigger 1 again, with the same rows
    assert [n for n, _ in seen] == [0, 1] and bl.taken(spark, tmp_dir + "/ck") == 2
    ev.where("ts >= '2024-01-15'").write.parquet(tmp_dir + "/b")
    bl.write_log(spark.read.parquet(tmp_dir + "/b"), week, "ts", log, append=True)
    go()
    weeks = bl.batch_values(spark, log)
    assert list(weeks) == list(range(5)) and len(seen) == 5
    for (n, ids), value in zip(seen, weeks.values()):
        assert ids == sorted(r[0] for r in ev.where(week == F.lit(value)).select("event_id").collect())
    assert {r["batch_id"]: r["batch"] for r in bl.batches_of(spark, log, tmp_dir + "/ck").collect()} == dict(enumerate(weeks.values()))


def test_files_that_tasks_cannot_open_are_copied_once(spark, tmp_dir, monkeypatch):
    df = odd_table(spark, tmp_dir + "/t")
    monkeypatch.setattr(bl, "_readable", lambda uri: False)
    log = bl.write_log(df, F.to_date("ts"), "ts")
    assert os.path.isdir(log.replace("file://", "") + "/files")
    r = reader(log, df.schema, "ts")
    assert len(rows_of(r, 0, len(bl.batch_values(spark, log)))) == df.count()
