"""Session construction and shared scratch locations.

On a cluster the operator names a shared, fault-tolerant folder in
``spark.checkpoint.dir``; every job here that must cut lineage or stage data
writes under that folder.  Only in local mode, with the setting absent, do we
pick a fresh local folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def get_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "mergestat",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings this library assumes.

    ``master`` is only applied when given (a cluster launcher sets it).  AQE is
    on so shuffle partition counts and skewed partitions are re-planned at run
    time; the UI is off because nothing here serves pages.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # transformWithState (running top-k, streaming Kalman) needs RocksDB.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Reads ``spark.checkpoint.dir`` (or the SparkContext's checkpoint dir).  When
    neither is configured, sets a fresh local folder in local mode and refuses
    on a cluster, where executors could not see it.
    """
    sc = spark.sparkContext
    root = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not root:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            root = current.get()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CKPT_KEY} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="mergestat-ckpt-")
        try:
            spark.conf.set(_CKPT_KEY, root)
        except Exception:  # noqa: BLE001 - some deployments refuse core confs at runtime
            pass
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(root)
    return root


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers then import it wherever the driver was started from.  The zip lies
    in the driver's own temporary folder; Spark's file server hands it out.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="mergestat-py-"), "mergestat.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}{name}-{uuid.uuid4().hex[:12]}"
