"""The reorder buffer: order, exact lateness, quiet keys, hot keys, large ids and NULLs."""

import datetime as dt
import os

from pyspark.sql import functions as F

from mergestat.streaming import batch_log, reorder
from mergestat.streaming.catalog import _drained

BIG = 2 ** 60
T0 = dt.datetime(2024, 1, 1)


def through(spark, tmp_dir, batches, delay, schema, order, salts=3):
    """Rows of each given batch through the buffer; what every trigger lets out."""
    rows = [(*r, n) for n, b in enumerate(batches) for r in b]
    spark.createDataFrame(rows, schema + ", arrival int").repartition(3).write.parquet(tmp_dir + "/t")
    df = spark.read.parquet(tmp_dir + "/t")
    log = batch_log.write_log(df, F.col("arrival"), "arrival")
    s = batch_log.read_log(spark, log, df.schema, "arrival")
    out = []
    _drained(spark, reorder.reordered(s, ["k"], order, delay, salts), os.path.join(tmp_dir, "ck"), tmp_dir + "/out", "append",
             lambda d, n: out.append([tuple(r) for r in d.collect()]), log)
    return out


def expected(batches, delay):
    """Late rows by definition: below the largest time of all earlier batches, less the delay."""
    late, seen = [], None
    for b in batches:
        late += [r for r in b if r[1] is None or (seen is not None and r[1] < seen - delay)]
        seen = max([seen, *(r[1] for r in b)], key=lambda t: (t is not None, t or T0)) if any(r[1] for r in b) else seen
    return late


def test_released_in_order_and_lateness_is_exact(spark, tmp_dir):
    hour = dt.timedelta(hours=1)
    batches = [[] for _ in range(5)]
    for i in range(200):
        ts = T0 + i * hour / 4 + dt.timedelta(microseconds=i)
        arrives = i * 0.25 + (i * 7919 % 11) * 0.5                         # up to five hours behind
        if i % 23 == 0:
            arrives += 25
        batches[min(4, int(arrives // 12))].append(((BIG, BIG + 1, None)[i % 3] if i % 7 else 5, ts, BIG + i if i % 5 else None, float(i)))
    batches[2].append((BIG, None, 1, 0.5))                                 # without a time
    batches.append([(None, T0 + dt.timedelta(days=400), -1, None)])        # heartbeat
    out = through(spark, tmp_dir, batches, "5 hours", "k long, ts timestamp, id long, v double", ["ts", "id"])
    late = sorted((r[:4] for b in out for r in b if r[-1]), key=str)
    assert late == sorted(expected(batches, 5 * hour), key=str) and len(late) > 3
    everything = sorted((r[:4] for b in out for r in b), key=str)
    assert everything == sorted((r for b in batches[:-1] for r in b), key=str)
    last = None
    for b in out:
        ready = [r[1] for r in b if not r[-1]]
        if ready:
            assert last is None or min(ready) > last
            last = max(ready)


def test_keys_that_go_quiet_are_released_by_timers(spark, tmp_dir):
    day = dt.timedelta(days=1)
    batches = [[("quiet", T0, 1), ("busy", T0, 2)], [("busy", T0 + 10 * day, 3)], [("busy", T0 + 20 * day, 4)]]
    out = through(spark, tmp_dir, batches, "1 day", "k string, ts timestamp, id int", ["ts", "id"], salts=1)
    flat = [r[0] for b in out for r in b if not r[-1]]
    assert sorted(flat) == ["busy", "busy", "quiet"]                       # the last row waits
