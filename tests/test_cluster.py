"""The library away from its own folder and on a cluster."""

import os
import subprocess
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", {entry!r})
E = importlib.util.module_from_spec(spec)
spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2")
         .config("spark.ui.enabled", "false").getOrCreate())
for name in {names!r}:
    print(name, E.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_find_the_package_from_another_folder():
    names = ["kalman_final", "stream_extremes", "stream_kalman"]
    code = SCRIPT.format(entry=f"{ROOT}/__spark_entry__.py", names=names)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(prefix="mergestat-t-"), env=env,
                          capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.split()[:1] and line.split()[0] in names] == names


def test_a_cluster_needs_a_shared_folder():
    from mergestat import session

    class Undefined:
        def isDefined(self):
            return False

    class Anything:
        master, conf = "spark://host:7077", {}

        def getConf(self):
            return {}

        @property
        def _jsc(self):
            return self

        def sc(self):
            return self

        def getCheckpointDir(self):
            return Undefined()

    class Session:
        sparkContext, conf = Anything(), {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
