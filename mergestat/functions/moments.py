"""Mergeable moment states as column expressions.

A moment state is ``struct(n BIGINT, mean DOUBLE, m2 DOUBLE)`` with
``m2 = sum((v - mean)^2)``; population variance is ``m2 / n``.  Two states
merge with Chan et al.'s pairwise rule, which is what Spark's own
``var_pop`` buffer does internally; we expose it for states that outlive one
aggregation (per-batch partials, stream snapshots).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment_state(n: Column, mean: Column, m2: Column) -> Column:
    return F.struct(n.cast("bigint").alias("n"), mean.cast("double").alias("mean"),
                    m2.cast("double").alias("m2"))


def merge_moments(a: Column, b: Column) -> Column:
    """Chan's pairwise merge of two moment structs.

    With p = n_a / n, the merged variance is p*v_a + (1-p)*v_b +
    p*(1-p)*(mean_a - mean_b)^2; written on m2 that is
    m2_a + m2_b + delta^2 * n_a * n_b / n.  An empty side is the identity.
    """
    na, nb = a["n"].cast("double"), b["n"].cast("double")
    n = na + nb
    delta = b["mean"] - a["mean"]
    mean = F.when(a["n"] == 0, b["mean"]).when(b["n"] == 0, a["mean"]) \
        .otherwise(a["mean"] + delta * nb / n)
    m2 = F.when(a["n"] == 0, b["m2"]).when(b["n"] == 0, a["m2"]) \
        .otherwise(a["m2"] + b["m2"] + delta * delta * na * nb / n)
    return moment_state(a["n"] + b["n"], mean, m2)


def variance_of(state: Column) -> Column:
    """Population variance of a state; NULL when n = 0."""
    return F.when(state["n"] > 0, state["m2"] / state["n"])


# ---------------------------------------------------------------- third and fourth moments

HIGHER = ("n", "mean", "m2", "m3", "m4")


def higher_state(n: Column, mean: Column, m2: Column, m3: Column, m4: Column) -> Column:
    """``m_p = sum((v - mean)^p)``; all but n are NULL for n = 0."""
    return F.struct(n.cast("bigint").alias("n"), *[
        F.when(n > 0, c.cast("double")).alias(name) for c, name in zip((mean, m2, m3, m4), HIGHER[1:])])


def higher_of(v: Column) -> Column:
    """State of the values of a group, from Spark's own one-pass buffers.

    Those give skewness and excess kurtosis; both are undone here.  Without
    spread (m2 = 0) third and fourth moment are 0.
    """
    n, m2 = F.count(v).cast("double"), F.var_pop(v) * F.count(v)
    flat = m2 == 0
    m3 = F.when(flat, 0.0).otherwise(F.skewness(v) * F.pow(m2, 1.5) / F.sqrt(n))
    m4 = F.when(flat, 0.0).otherwise((F.kurtosis(v) + 3) * m2 * m2 / n)
    return higher_state(F.count(v), F.avg(v), m2, m3, m4)


def merge_higher(a: Column, b: Column) -> Column:
    """Pairwise merge of two states up to the fourth moment (A7 for A10).

    With d the difference of the means, each side's powers about its own mean are
    written about the common one.  An empty side is the identity.
    """
    na, nb = a["n"].cast("double"), b["n"].cast("double")
    n, d = na + nb, b["mean"] - a["mean"]
    r = d / n
    mean = a["mean"] + r * nb
    m2 = a["m2"] + b["m2"] + d * r * na * nb
    m3 = a["m3"] + b["m3"] + d * r * r * na * nb * (na - nb) + 3 * r * (na * b["m2"] - nb * a["m2"])
    m4 = (a["m4"] + b["m4"] + d * r * r * r * na * nb * (na * na - na * nb + nb * nb)
          + 6 * r * r * (na * na * b["m2"] + nb * nb * a["m2"]) + 4 * r * (na * b["m3"] - nb * a["m3"]))
    both = higher_state(a["n"] + b["n"], mean, m2, m3, m4)
    return F.when(a["n"] == 0, b).when(b["n"] == 0, a).otherwise(both)


def power_sums(n: Column, mean: Column, m2: Column, m3: Column, m4: Column, shift: Column) -> tuple[Column, ...]:
    """Sums of (v - shift)^p for p = 1 to 4 of a group, from its state.  They add up over groups."""
    d = mean - shift
    return (n * d, m2 + n * d * d, m3 + 3 * d * m2 + n * d * d * d,
            m4 + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d)


def centred(n: Column, s1: Column, s2: Column, s3: Column, s4: Column) -> tuple[Column, Column, Column]:
    """m2, m3 and m4 of power sums about any shift: the k-way form of the merge."""
    e = s1 / n
    return (s2 - n * e * e, s3 - 3 * e * s2 + 2 * n * e * e * e,
            s4 - 4 * e * s3 + 6 * e * e * s2 - 3 * n * e * e * e * e)


def shape_of(n: Column, m2: Column, m3: Column, m4: Column) -> tuple[Column, Column, Column]:
    """Population variance, skewness and excess kurtosis; the last two NULL without spread."""
    spread = (n > 0) & (m2 > 0)
    return (F.when(n > 0, m2 / n), F.when(spread, F.sqrt(n.cast("double")) * m3 / F.pow(m2, 1.5)),
            F.when(spread, n * m4 / (m2 * m2) - 3))
