"""Connected components of an edge table by alternating star contractions.

Both contractions are a minimum per node (combined before the shuffle) and a
join on the node, so a node that touches a third of all edges is split by the
skew join and never gathered in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def spanning_stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes of some edges.

    At most one row per node that is not its component's smallest, however
    many edges came in.
    """
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            break
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of (u, v) edges with u > v; returns such edges again."""
    if large:
        arcs = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        arcs = edges
    low = arcs.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    out = arcs.join(low, "u")
    if large:
        out = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) that is not its root.

    Root is the smallest node of the component.  Ends when a pair of
    contractions leaves the edge set as it was.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) \
        .where("u <> v").distinct()
    before = None
    while True:
        e = staged(_stars(_stars(e, True), False), "stars")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
