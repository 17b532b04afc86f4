"""mergestat — mergeable running statistics over keyed data, on Spark.

Every statistic is split into a mergeable *state* (aggregation buffers that
Spark combines map-side, across batches, and across streaming triggers) and a
*finish* step that is a pure projection of that state.  The same functions
accept a static DataFrame (``spark.read``) or a streaming one
(``spark.readStream``).

Sub-packages:

* ``sources``   — table loading, keyed projection, batch files for streams
* ``functions`` — column-expression building blocks (hashing, binning,
                  moment merging, Kalman algebra, array scans)
* ``operators`` — the statistics: moments, extremes, distinct, histogram,
                  Kalman, per-batch history
* ``streaming`` — Structured Streaming queries, sinks and stateful processors
* ``plans``     — the query catalogue, its SQL oracle, plan inspection
"""

from mergestat.session import checkpoint_root, get_session, scratch_path

__all__ = ["checkpoint_root", "get_session", "scratch_path"]
