"""Independent SQL for every checked query (DuckDB dialect, ANSI where it can).

The SQL is written from the definitions, not from our Spark plans: direct
aggregates over raw rows where Spark merges partial states, a join of every
batch with all earlier rows where Spark uses running window sums, and a
recursive CTE where Spark runs the segmented Kalman scan.  Fixed parameters
(bins, edges, Kalman constants) are rendered from the same Python values the
queries use, so both sides compute with identical literals.
"""

from __future__ import annotations

from mergestat.functions.hashing import alpha
from mergestat.functions.kalman_math import KalmanParams
from mergestat.plans.catalog import (ACCTBAL_BINS, EVENT_BINS, HLL_M, J_SMALLEST, K_LARGEST, NOISE,
                                     QUANTITY_EDGES)
from mergestat.operators.histogram import Bins

EV = ("ev AS (SELECT event_type AS label, value, ts, event_id, user_id, "
      "CAST(ts AS DATE) AS batch FROM events)")


def _lit(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _slot_sql(v: str, bins: Bins) -> str:
    if bins.equal:
        lo, hi, nb = bins.equal
        w = (hi - lo) / nb
        return (f"CASE WHEN {v} IS NULL OR isnan({v}) THEN NULL "
                f"WHEN {v} < {_lit(lo)} THEN 0 WHEN {v} >= {_lit(hi)} THEN {nb + 1} "
                f"ELSE least(CAST(floor(({v} - {_lit(lo)}) / {_lit(w)}) AS INTEGER) + 1, {nb}) END")
    terms = " + ".join(f"(CASE WHEN {v} >= {_lit(e)} THEN 1 ELSE 0 END)" for e in bins.edges)
    return f"CASE WHEN {v} IS NULL OR isnan({v}) THEN NULL ELSE {terms} END"


def _mid_sql(slot: str, bins: Bins) -> str:
    e = bins.edges
    whens = " ".join(f"WHEN {i + 1} THEN {_lit((e[i] + e[i + 1]) / 2)}" for i in range(bins.nbins))
    return f"CASE {slot} {whens} ELSE NULL END"


def _hash_sql(v: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({v} AS VARCHAR)), 1, 8)) AS BIGINT)"


def _registers_sql(src: str, key: str, value: str, m: int) -> str:
    p = m.bit_length() - 1
    return (f"SELECT {key}, register, CAST(max(CASE WHEN w = 0 THEN {32 - p + 1} "
            f"ELSE bit_count((w & (-w)) - 1) + 1 END) AS BIGINT) AS rank, count(*) AS n "
            f"FROM (SELECT {key}, h & {m - 1} AS register, h >> {p} AS w "
            f"FROM (SELECT {key}, {_hash_sql(value)} AS h FROM {src} WHERE {value} IS NOT NULL)) "
            f"GROUP BY {key}, register")


def _corrected_sql(sums: str, m: int) -> str:
    """CTEs ``e`` and ``f``: estimates from the CTE ``sums`` with n, z, empty_registers."""
    two32 = float(2 ** 32)
    return f"""e AS (SELECT *, {_lit(alpha(m) * m * m)} / z AS raw_estimate FROM {sums}),
f AS (SELECT *, CASE WHEN raw_estimate <= {_lit(2.5 * m)} AND empty_registers > 0
                     THEN {_lit(float(m))} * ln({_lit(float(m))} / empty_registers)
                     WHEN raw_estimate <= {_lit(two32 / 30)} THEN raw_estimate
                     ELSE -{_lit(two32)} * ln(1 - least(raw_estimate, {_lit(two32 - 1)}) / {_lit(two32)}) END AS estimate
      FROM e)
"""


def _estimate_sql(src: str, key: str, value: str, m: int) -> str:
    return f"""
WITH r AS ({_registers_sql(src, key, value, m)}),
z AS (SELECT {key}, CAST(sum(n) AS BIGINT) AS n,
             sum(pow(2.0, -rank)) + ({m} - count(*)) AS z,
             CAST({m} - count(*) AS BIGINT) AS empty_registers
      FROM r GROUP BY {key}),
{_corrected_sql("z", m)}"""


_EST = ("n, empty_registers, round(raw_estimate, 6) AS raw_estimate, "
        "round(estimate, 6) AS estimate, CAST(round(estimate) AS BIGINT) AS estimate_rounded")


def _extremes_sql(tbl: str, key: str, value: str, tie: str) -> str:
    def side(name, direction, n):
        return (f"SELECT {key}, '{name}' AS side, rank, round({value}, 6) AS {value} FROM "
                f"(SELECT {key}, {value}, row_number() OVER (PARTITION BY {key} ORDER BY "
                f"{value} {direction}, {tie}) AS rank FROM {tbl} WHERE {value} IS NOT NULL "
                f"AND NOT isnan({value})) WHERE rank <= {n}")
    return side("largest", "DESC", K_LARGEST) + " UNION ALL " + side("smallest", "ASC", J_SMALLEST)


# How rows fall into batches: the batch of a row, and the step between batches.
DAILY = ("CAST(ts AS DATE)", "INTERVAL 1 DAY")
WEEKLY = ("CAST(date_trunc('week', ts) AS DATE)", "INTERVAL 7 DAY")


def _grid(every=DAILY, src: str = "events", key: str = "event_type") -> str:
    """CTEs ``ev`` (label, batch, ...) and ``g``: every key with every batch from its
    first on; rows without a batch come before the table's first batch."""
    batch, step = every
    return (f"ev AS (SELECT *, {key} AS label, {batch} AS batch FROM {src}), "
            f"born AS (SELECT label, CASE WHEN count(*) > count(batch) THEN (SELECT min(batch) FROM ev) "
            f"ELSE min(batch) END AS first FROM ev GROUP BY label), "
            f"g AS (SELECT label, CAST(unnest(generate_series(first, (SELECT max(batch) FROM ev), {step})) "
            f"AS DATE) AS batch FROM born UNION ALL SELECT DISTINCT label, NULL FROM ev WHERE batch IS NULL)")


_UPTO = ("g JOIN ev e ON e.label IS NOT DISTINCT FROM g.label "
         "AND (e.batch IS NULL OR e.batch <= g.batch)")


def history_sum_sql(every=DAILY, key: str = "event_type", name: str = "label") -> str:
    return (f"WITH {_grid(every, key=key)} SELECT g.label AS {name}, g.batch, count(e.value) AS n, "
            f"round(sum(e.value), 6) AS sum FROM {_UPTO} GROUP BY g.label, g.batch")


def history_mean_sql(every=DAILY) -> str:
    return (f"WITH {_grid(every)} SELECT g.label, g.batch, count(e.value) AS n, round(avg(e.value), 6) AS mean "
            f"FROM {_UPTO} GROUP BY g.label, g.batch")


def history_variance_sql(every=DAILY, stddev: bool = False, squares: bool = False) -> str:
    return (f"WITH {_grid(every)} SELECT g.label, g.batch, count(e.value) AS n, round(avg(e.value), 6) AS mean, "
            f"round(var_pop(e.value), 6) AS variance"
            + (", round(stddev_pop(e.value), 6) AS stddev" if stddev else "")
            + (", round(avg(e.value * e.value) - avg(e.value) * avg(e.value), 6) AS variance_sum_squares" if squares else "")
            + f" FROM {_UPTO} GROUP BY g.label, g.batch")


def _shape_sql(rows: str, keys: str) -> str:
    """Moments of ``value`` in the CTE ``rows`` about each group's own mean."""
    same = " AND ".join(f"x.{k} IS NOT DISTINCT FROM m.{k}" for k in keys.split(", "))
    grouped = ", ".join(f"x.{k}" for k in keys.split(", "))

    def power(p):
        return f"avg(power(value - mu, {p}))"
    spread = "CASE WHEN var_pop(value) > 0 THEN"
    return (f"m AS (SELECT {keys}, avg(value) AS mu FROM {rows} GROUP BY {keys}) "
            f"SELECT {grouped}, count(value) AS n, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS variance, "
            f"round({spread} {power(3)} / power({power(2)}, 1.5) END, 6) AS skewness, "
            f"round({spread} {power(4)} / power({power(2)}, 2) - 3 END, 6) AS kurtosis "
            f"FROM {rows} x JOIN m ON {same} GROUP BY {grouped}")


def history_higher_sql(every=DAILY) -> str:
    return (f"WITH {_grid(every)}, upto AS (SELECT g.label, g.batch, e.value FROM {_UPTO}), "
            + _shape_sql("upto", "label, batch"))


#: Exact sums: doubles times this power of two are integers in the checked tables.
FIXED_POINT = 66


def exact_sum_sql(keys: str, mean: bool) -> str:
    """Sums in 128-bit integers, rounded once, half to even, by integer division."""
    total = f"sum(CAST(value * power(2::DOUBLE, {FIXED_POINT}) AS HUGEINT))::HUGEINT"

    def nearest(whole: str, parts: str) -> str:
        # the quotient's size to within one place, then 54 or 55 bits of it, a sticky bit, and one rounding
        size = f"CAST(floor(log2(greatest(abs({whole}::DOUBLE), 1::DOUBLE) / ({parts})::DOUBLE)) AS INTEGER)"
        unit = f"CAST(power(2::DOUBLE, greatest({size} - 54, 0)) AS HUGEINT)"
        q, r = f"(abs({whole}) // (({parts}) * {unit}))", f"(abs({whole}) % (({parts}) * {unit}))"
        half = f"CASE WHEN {q} >= 18014398509481984::HUGEINT THEN 4::HUGEINT ELSE 2::HUGEINT END"
        rounded = (f"(CASE WHEN {q} < 9007199254740992::HUGEINT THEN {q} ELSE "
                   f"(CASE WHEN ({q} % ({half})) * 2 > ({half}) OR (({q} % ({half})) * 2 = ({half}) AND ({r} > 0 OR "
                   f"({q} // ({half})) % 2 = 1)) THEN {q} // ({half}) + 1 ELSE {q} // ({half}) END) * ({half}) END)")
        return f"sign({whole}) * ({rounded})::DOUBLE * {unit}::DOUBLE / power(2::DOUBLE, {FIXED_POINT})"
    return (f"WITH {EV}, t AS (SELECT {keys}, count(value) AS n, {total} AS total FROM ev GROUP BY {keys}) "
            f"SELECT {keys}, n, {nearest('total', '1')} AS sum"
            + (f", {nearest('total', 'n')} AS mean" if mean else "") + " FROM t")


def median_sql(table: str, key: str, value: str) -> str:
    """The value of rank n div 2, counted from 0."""
    return (f"SELECT {key}, CAST(max(c) AS BIGINT) AS n, max(CASE WHEN i = c // 2 THEN {value} END) AS median FROM "
            f"(SELECT {key}, {value}, row_number() OVER (PARTITION BY {key} ORDER BY {value}) - 1 AS i, "
            f"count(*) OVER (PARTITION BY {key}) AS c FROM {table} "
            f"WHERE {value} IS NOT NULL AND NOT isnan({value})) GROUP BY {key}")


def history_histogram_sql(every=DAILY) -> str:
    b = EVENT_BINS
    slots = ", ".join(f"count(CASE WHEN slot = {i} THEN 1 END)" for i in range(b.nslots))
    return (
        f"WITH {_grid(every)}, s AS (SELECT g.label, g.batch, e.value, {_slot_sql('e.value', b)} AS slot FROM {_UPTO}), "
        f"run AS (SELECT label, batch, slot, count(slot) AS c FROM s GROUP BY label, batch, slot), "
        f"cum AS (SELECT label, batch, slot, sum(c) OVER (PARTITION BY label, batch ORDER BY slot NULLS FIRST "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum, "
        f"sum(c) OVER (PARTITION BY label, batch) AS n FROM run), "
        f"m AS (SELECT label, batch, CAST(max(n) AS BIGINT) AS n, "
        f"min(CASE WHEN cum > floor(n / 2) THEN slot END) AS ms FROM cum GROUP BY label, batch), "
        f"h AS (SELECT label, batch, round(avg(value) FILTER (slot IS NOT NULL), 6) AS mean, "
        f"array_to_string([{slots}], ',') AS counts FROM s GROUP BY label, batch) "
        f"SELECT m.label, m.batch, m.n, h.mean, h.counts, {_mid_sql('m.ms', b)} AS median_estimate "
        f"FROM m JOIN h ON h.label IS NOT DISTINCT FROM m.label AND h.batch IS NOT DISTINCT FROM m.batch")


def history_hll_sql(every=DAILY, m: int = HLL_M) -> str:
    p = m.bit_length() - 1
    return f"""
WITH {_grid(every)},
h AS (SELECT label, batch, {_hash_sql("user_id")} AS h FROM ev WHERE user_id IS NOT NULL),
x AS (SELECT label, batch, h & {m - 1} AS register, CASE WHEN h >> {p} = 0 THEN {32 - p + 1}
        ELSE bit_count(((h >> {p}) & -(h >> {p})) - 1) + 1 END AS rank FROM h),
r AS (SELECT g.label, g.batch, e.register, max(e.rank) AS rank, count(e.register) AS n
      FROM g LEFT JOIN x e ON e.label IS NOT DISTINCT FROM g.label AND (e.batch IS NULL OR e.batch <= g.batch)
      GROUP BY g.label, g.batch, e.register),
z AS (SELECT label, batch, CAST(sum(n) AS BIGINT) AS n,
             coalesce(sum(pow(2.0, -rank)), 0) + ({m} - count(register)) AS z,
             CAST({m} - count(register) AS BIGINT) AS empty_registers
      FROM r GROUP BY label, batch),
{_corrected_sql("z", m)} SELECT label, batch, {_EST} FROM f"""


def history_extremes_sql(every=DAILY) -> str:
    def side(name, direction, n):
        return (f"SELECT label, batch, '{name}' AS side, rank, round(value, 6) AS value FROM (SELECT g.label, g.batch, "
                f"e.value, row_number() OVER (PARTITION BY g.label, g.batch ORDER BY e.value {direction}) AS rank "
                f"FROM {_UPTO} WHERE e.value IS NOT NULL AND NOT isnan(e.value)) WHERE rank <= {n}")
    return (f"WITH {_grid(every)} " + side("largest", "DESC", K_LARGEST) + " UNION ALL "
            + side("smallest", "ASC", J_SMALLEST))


def _kalman_sql(key_expr: str, key: str, final: bool, prm: KalmanParams = KalmanParams(), weekly: bool = False,
                z: str = "value") -> str:
    dt = _lit(prm.dt)
    ga0, ga1 = (_lit(x) for x in prm.ga)
    q00, q01, q10, q11 = (_lit(x) for x in prm.q)
    x0, x1 = (_lit(x) for x in prm.x_init)
    p = [_lit(x) for x in prm.p_init]
    r = _lit(prm.r)
    body = f"""
WITH RECURSIVE o AS (
  SELECT {key_expr} AS {key}, event_id, {z} AS z,
         row_number() OVER (PARTITION BY {key_expr} ORDER BY ts, event_id) AS step
  FROM events WHERE {z} IS NOT NULL),
k({key}, event_id, step, z, x0, x1, p00, p01, p10, p11) AS (
  SELECT DISTINCT {key}, CAST(NULL AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS DOUBLE),
         {x0}, {x1}, {p[0]}, {p[1]}, {p[2]}, {p[3]} FROM o
  UNION ALL
  SELECT {key}, event_id, step, z, x0p + k0 * (z - x0p), x1p + k1 * (z - x0p),
         (1 - k0) * pp00, (1 - k0) * pp01, pp10 - k1 * pp00, pp11 - k1 * pp01
  FROM (SELECT *, pp00 / (pp00 + {r}) AS k0, pp10 / (pp00 + {r}) AS k1
        FROM (SELECT k.{key}, o.event_id, o.step, o.z,
                     k.x0 + {dt} * k.x1 + {ga0} AS x0p, k.x1 + {ga1} AS x1p,
                     (k.p00 + {dt} * k.p10) + {dt} * (k.p01 + {dt} * k.p11) + {q00} AS pp00,
                     (k.p01 + {dt} * k.p11) + {q01} AS pp01,
                     k.p10 + {dt} * k.p11 + {q10} AS pp10,
                     k.p11 + {q11} AS pp11
              FROM k JOIN o ON o.{key} = k.{key} AND o.step = k.step + 1)))
"""
    rnd = ", ".join(f"round({c}, 6) AS {c}" for c in ("x0", "x1", "p00", "p01", "p10", "p11"))
    if weekly:
        week = "CAST(date_trunc('week', ts) AS DATE)"
        return body + (f", w AS (SELECT DISTINCT {week} AS batch FROM events), "
                       f"s AS (SELECT k.{key}, w.batch, max(k.step) AS step FROM k JOIN events e ON e.event_id = k.event_id "
                       f"JOIN w ON {week} <= w.batch GROUP BY ALL) SELECT s.{key}, s.batch, s.step AS n, {rnd} "
                       f"FROM s JOIN k ON k.{key} = s.{key} AND k.step = s.step")
    if final:
        return body + (f"SELECT {key}, step AS n, {rnd} FROM k WHERE step > 0 AND step = "
                       f"(SELECT max(step) FROM k k2 WHERE k2.{key} = k.{key})")
    return body + f"SELECT {key}, event_id, step, round(z, 6) AS z, {rnd} FROM k WHERE step > 0"


def kalman_weekly_sql() -> str:
    """The filter state of every key after every week."""
    return _kalman_sql("event_type", "label", final=False, weekly=True)


def kalman_errors_sql() -> str:
    seen = f"(value + (event_id * 7919 % 1001 - 500) / 500.0::DOUBLE * {_lit(NOISE)})"
    trace = _kalman_sql("event_type", "label", final=False, z=seen).rsplit("SELECT label, event_id, step", 1)[0]
    return trace + ("SELECT k.label, count(value) AS n, round(sqrt(avg((k.z - value) * (k.z - value))), 6) AS rmse_observed, "
                    "round(sqrt(avg((k.x0 - value) * (k.x0 - value))), 6) AS rmse_estimate, round(avg(k.x0 - value), 6) AS mean_error, "
                    "round(max(abs(k.x0 - value)), 6) AS worst_error FROM k JOIN events e ON e.event_id = k.event_id "
                    "WHERE k.step > 0 AND value IS NOT NULL GROUP BY k.label")


def hll_registers_history_sql(every, m: int = HLL_M) -> str:
    """All registers of every key after every batch, as text."""
    p = m.bit_length() - 1
    slots = ", ".join(f"coalesce(max(rank) FILTER (register = {i}), 0)" for i in range(m))
    return (f"WITH {_grid(every)}, h AS (SELECT label, batch, {_hash_sql('user_id')} AS h FROM ev WHERE user_id IS NOT NULL), "
            f"x AS (SELECT label, batch, h & {m - 1} AS register, CASE WHEN h >> {p} = 0 THEN {32 - p + 1} "
            f"ELSE bit_count(((h >> {p}) & -(h >> {p})) - 1) + 1 END AS rank FROM h) "
            f"SELECT g.label, g.batch, count(e.register) AS n, array_to_string([{slots}], ',') AS registers "
            f"FROM g LEFT JOIN x e ON e.label IS NOT DISTINCT FROM g.label AND (e.batch IS NULL OR e.batch <= g.batch) "
            f"GROUP BY g.label, g.batch")


def kalman_irregular_sql(prm: KalmanParams = KalmanParams()) -> str:
    """Steps as long as the hours since the key's row before; rows without a value are predicted only."""
    a0, a1 = (_lit(x) for x in prm.accel)
    x0, x1 = (_lit(x) for x in prm.x_init)
    p, r, s = [_lit(x) for x in prm.p_init], _lit(prm.r), _lit(prm.sigma)
    return f"""
WITH RECURSIVE o AS (
  SELECT event_type AS label, event_id, CASE WHEN event_id % 10 <> 0 THEN value END AS z,
    coalesce((epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 3.6e9, {_lit(prm.dt)}) AS dt, row_number() OVER w AS step
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
k(label, event_id, step, dt, z, x0, x1, p00, p01, p10, p11) AS (
  SELECT DISTINCT label, CAST(NULL AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
    {x0}, {x1}, {p[0]}, {p[1]}, {p[2]}, {p[3]} FROM o
  UNION ALL
  SELECT label, event_id, step, dt, z, x0p + k0 * y, x1p + k1 * y,
    (1 - k0) * pp00, (1 - k0) * pp01, pp10 - k1 * pp00, pp11 - k1 * pp01
  FROM (SELECT *, CASE WHEN z IS NULL THEN 0.0::DOUBLE ELSE pp00 / (pp00 + {r}) END AS k0,
          CASE WHEN z IS NULL THEN 0.0::DOUBLE ELSE pp10 / (pp00 + {r}) END AS k1, coalesce(z - x0p, 0.0::DOUBLE) AS y
        FROM (SELECT k.label, o.event_id, o.step, o.dt, o.z,
                k.x0 + o.dt * k.x1 + o.dt * o.dt / 2 * {a0} AS x0p, k.x1 + o.dt * {a1} AS x1p,
                (k.p00 + o.dt * k.p10) + o.dt * (k.p01 + o.dt * k.p11) + {s} * power(o.dt, 4) / 4 AS pp00,
                (k.p01 + o.dt * k.p11) + {s} * power(o.dt, 3) / 2 AS pp01,
                k.p10 + o.dt * k.p11 + {s} * power(o.dt, 3) / 2 AS pp10,
                k.p11 + {s} * o.dt * o.dt AS pp11
              FROM k JOIN o ON o.label = k.label AND o.step = k.step + 1)))
SELECT label, event_id, {", ".join(f"round({c}, 4) AS {c}" for c in ("dt", "z", "x0", "x1", "p00", "p01", "p10", "p11"))}
FROM k WHERE step > 0
"""


def likelihood_sql(src: str, key: str, value: str, m: int) -> str:
    """The same secant steps on the numbers of registers per rank, written out."""
    from mergestat.operators.distinct import SECANTS
    top = 32 - (m.bit_length() - 1) + 1
    steps, last = [], "s0"
    for i in range(1, SECANTS + 1):
        steps.append(f"""f{i} AS (SELECT s.{key}, any_value(s.x0) AS x0, any_value(s.f0) AS f0, any_value(s.x) AS x,
  any_value(s.x) * any_value(s.weight) + sum(CASE WHEN c.rank IS NULL THEN 0.0::DOUBLE ELSE c.c * CASE WHEN s.x * c.w < 1e-5 THEN s.x * c.w / 2 - s.x * c.w * s.x * c.w / 12
    WHEN s.x * c.w > 700 THEN 1.0 ELSE 1 - s.x * c.w / (exp(s.x * c.w) - 1) END END) - any_value(s.filled) AS f,
  any_value(s.weight) AS weight, any_value(s.filled) AS filled FROM {last} s LEFT JOIN c ON c.{key} = s.{key} GROUP BY s.{key})""")
        steps.append(f"s{i} AS (SELECT {key}, x AS x0, f AS f0, x + CASE WHEN f = f0 OR f >= 0 THEN 0.0 "
                     f"ELSE -f * (x - x0) / (f - f0) END AS x, weight, filled FROM f{i})")
        last = f"s{i}"
    return f"""
WITH r AS ({_registers_sql(src, key, value, m)}),
c AS (SELECT {key}, rank, count(*) AS c, power(2.0::DOUBLE, -least(rank, {top - 1})) AS w FROM r GROUP BY {key}, rank),
z AS (SELECT {key}, CAST(sum(n) AS BIGINT) AS n, {m} - count(*) AS empty,
  {m} - count(*) + sum(CASE WHEN rank < {top} THEN power(2.0::DOUBLE, -rank) ELSE 0 END) AS weight,
  sum(power(2.0::DOUBLE, -least(rank, {top - 1}))) AS tail, count(*)::DOUBLE AS filled FROM r GROUP BY {key}),
s0 AS (SELECT {key}, 0.0::DOUBLE AS x0, -filled AS f0, filled / (weight + tail / 2) AS x, weight, filled FROM z),
{", ".join(steps)}
SELECT z.{key}, z.n, CAST(z.empty AS BIGINT) AS empty_registers, round(s.x * {m}, 6) AS estimate,
  CAST(round(s.x * {m}) AS BIGINT) AS estimate_rounded FROM z JOIN {last} s ON s.{key} = z.{key}"""


def running_distinct_sql(batch: str, key: str, value: str) -> str:
    """Rows and distinct values of every key up to each of its batches."""
    return (f"WITH e AS (SELECT {key}, {value} AS v, {batch} AS batch FROM events), "
            f"b AS (SELECT label, batch, count(v) AS c FROM e GROUP BY label, batch), "
            f"f AS (SELECT label, v, min(batch) AS batch FROM e WHERE v IS NOT NULL GROUP BY label, v) "
            f"SELECT b.label, b.batch, CAST(sum(b.c) OVER w AS BIGINT) AS n, CAST(sum(coalesce(g.c, 0)) OVER w AS BIGINT) AS exact, "
            f"true AS sketch_in_bounds FROM b LEFT JOIN (SELECT label, batch, count(*) AS c FROM f GROUP BY label, batch) g "
            f"ON g.label = b.label AND g.batch = b.batch WINDOW w AS (PARTITION BY b.label ORDER BY b.batch)")


def build() -> dict[str, str]:
    b = EVENT_BINS
    nb = b.nbins
    slot = _slot_sql("value", b)
    q: dict[str, str] = {}
    q["keyed_projection"] = "SELECT event_type AS label, round(value, 6) AS value FROM events"
    mom = ("count(value) AS n, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS variance, "
           "round(stddev_pop(value), 6) AS stddev")
    q["filtered_variance"] = (f"SELECT event_type AS label, {mom} FROM events "
                              f"WHERE event_type = 'click' GROUP BY event_type")
    q["batch_sum"] = (f"WITH {EV} SELECT batch, label, count(value) AS n, "
                      f"round(sum(value), 6) AS sum FROM ev GROUP BY batch, label")
    q["running_sum"] = f"WITH {EV} SELECT label, round(sum(value), 6) AS sum FROM ev GROUP BY label"
    q["running_count"] = f"WITH {EV} SELECT label, count(value) AS n FROM ev GROUP BY label"
    q["running_mean"] = (f"WITH {EV} SELECT label, count(value) AS n, round(avg(value), 6) AS mean "
                         f"FROM ev GROUP BY label")
    q["running_variance"] = f"WITH {EV} SELECT label, {mom} FROM ev GROUP BY label"
    q["running_stddev"] = (f"WITH {EV} SELECT label, round(stddev_pop(value), 6) AS stddev "
                           f"FROM ev GROUP BY label")
    q["variance_sum_squares"] = (
        f"WITH {EV} SELECT label, count(value) AS n, "
        f"round(avg(value * value) - avg(value) * avg(value), 6) AS variance_sum_squares, "
        f"round(var_pop(value), 6) AS variance FROM ev GROUP BY label")
    q["variance_lineitem"] = (
        "SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n, "
        "round(avg(l_extendedprice), 6) AS mean, round(var_pop(l_extendedprice), 0) AS variance, "
        "round(stddev_pop(l_extendedprice), 6) AS stddev FROM lineitem "
        "GROUP BY l_returnflag, l_linestatus")
    q["variance_merge_partials"] = (f"WITH {EV} SELECT label, count(value) AS n, round(avg(value), 6) "
                                    f"AS mean, round(var_pop(value), 6) AS variance FROM ev "
                                    f"GROUP BY label")
    q["variance_pairwise_merge"] = (
        "SELECT l_returnflag, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, "
        "round(var_pop(l_quantity), 6) AS variance FROM lineitem GROUP BY l_returnflag")
    q["higher_moments"] = (
        f"WITH {EV}, m AS (SELECT label, avg(value) AS mu FROM ev GROUP BY label) "
        f"SELECT ev.label, count(value) AS n, "
        f"round(avg(power(value - mu, 3)) / power(avg(power(value - mu, 2)), 1.5), 6) AS skewness, "
        f"round(avg(power(value - mu, 4)) / power(avg(power(value - mu, 2)), 2) - 3, 6) AS kurtosis "
        f"FROM ev JOIN m ON ev.label = m.label GROUP BY ev.label")
    q["higher_moments_merge_partials"] = f"WITH {EV}, " + _shape_sql("ev", "label")
    q["higher_moments_pairwise_merge"] = (
        "WITH li AS (SELECT l_returnflag, l_quantity AS value FROM lineitem), " + _shape_sql("li", "l_returnflag"))
    q["history_higher_moments"] = history_higher_sql()
    q["hll_likelihood"] = likelihood_sql("(SELECT *, event_type AS label FROM events)", "label", "user_id", HLL_M)
    q["hll_likelihood_lineitem"] = likelihood_sql("lineitem", "l_returnflag", "l_partkey", HLL_M)
    q["running_sketches"] = running_distinct_sql("CAST(ts AS DATE)", "event_type AS label", "user_id")
    q["kalman_irregular"] = kalman_irregular_sql()
    q["kalman_errors"] = kalman_errors_sql()
    q["exact_sum"] = exact_sum_sql("label", mean=True)
    q["exact_batch_sum"] = exact_sum_sql("batch, label", mean=False)
    q["exact_median_lineitem"] = median_sql("lineitem", "l_returnflag", "l_extendedprice")
    q["exact_median_by_user"] = median_sql("events", "user_id", "value")
    for name, direction, n in (("k_largest", "DESC", K_LARGEST), ("j_smallest", "ASC", J_SMALLEST)):
        q[name] = (f"WITH {EV} SELECT label, rank, round(value, 6) AS value FROM "
                   f"(SELECT label, value, row_number() OVER (PARTITION BY label ORDER BY value "
                   f"{direction}, event_id) AS rank FROM ev WHERE value IS NOT NULL "
                   f"AND NOT isnan(value)) WHERE rank <= {n}")
    q["extremes_acctbal"] = _extremes_sql("customer", "c_mktsegment", "c_acctbal", "c_custkey")
    q["extremes_totalprice"] = _extremes_sql("orders", "o_orderpriority", "o_totalprice",
                                             "o_orderkey")
    evl = "(SELECT event_type AS label, user_id FROM events)"
    q["hll_registers"] = _registers_sql(evl, "label", "user_id", HLL_M)
    q["hll_estimate"] = _estimate_sql(evl, "label", "user_id", HLL_M) + \
        f"SELECT label, {_EST} FROM f"
    q["hll_lineitem"] = _estimate_sql("lineitem", "l_returnflag", "l_partkey", HLL_M) + \
        f"SELECT l_returnflag, {_EST} FROM f"
    q["hll_error_report"] = _estimate_sql(evl, "label", "user_id", HLL_M) + (
        ", x AS (SELECT event_type AS label, count(DISTINCT user_id) AS exact FROM events "
        "GROUP BY event_type) "
        "SELECT f.label, n, exact, round(estimate, 6) AS estimate, "
        "round((estimate - exact) / exact, 6) AS rel_error FROM f JOIN x ON f.label IS NOT DISTINCT FROM x.label")
    hist_body = (f"SELECT label, CAST(slot AS BIGINT) AS slot, count(*) AS count FROM "
                 f"(SELECT label, {slot} AS slot FROM ev) WHERE slot IS NOT NULL "
                 f"GROUP BY label, slot")
    hist = f"WITH {EV} {hist_body}"
    q["histogram"] = hist
    qb = Bins(edges=QUANTITY_EDGES)
    q["histogram_custom_edges"] = (
        f"SELECT l_returnflag, CAST(slot AS BIGINT) AS slot, count(*) AS count FROM "
        f"(SELECT l_returnflag, {_slot_sql('l_quantity', qb)} AS slot FROM lineitem) "
        f"WHERE slot IS NOT NULL GROUP BY l_returnflag, slot")
    q["histogram_cumulative"] = (
        f"WITH {EV}, h AS ({hist_body}) SELECT label, slot, count, CAST(sum(count) OVER (PARTITION BY label "
        f"ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative "
        f"FROM h")
    med = (f"WITH {EV}, h AS ({hist_body}), c AS (SELECT label, slot, sum(count) OVER (PARTITION BY label "
           f"ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum, "
           f"sum(count) OVER (PARTITION BY label) AS n FROM h), "
           f"m AS (SELECT label, CAST(max(n) AS BIGINT) AS n, "
           f"min(CASE WHEN cum > floor(n / 2) THEN slot END) AS ms FROM c GROUP BY label) ")
    q["histogram_median"] = med + f"SELECT label, n, {_mid_sql('ms', b)} AS median_estimate FROM m"
    q["running_histogram_median"] = (
        med + ", ids AS (SELECT DISTINCT label FROM ev), "
        f"dense AS (SELECT ids.label, r.slot, coalesce(h.count, 0) AS cnt FROM ids "
        f"CROSS JOIN (SELECT range AS slot FROM range(0, {nb + 2})) r "
        f"LEFT JOIN h ON h.label = ids.label AND h.slot = r.slot), "
        f"cs AS (SELECT label, string_agg(CAST(cnt AS VARCHAR), ',' ORDER BY slot) AS counts "
        f"FROM dense GROUP BY label), "
        f"mv AS (SELECT label, count(value) AS n, round(avg(value), 6) AS mean FROM ev "
        f"WHERE NOT isnan(value) GROUP BY label) "
        f"SELECT mv.label, mv.n, mv.mean, cs.counts, {_mid_sql('m.ms', b)} AS median_estimate "
        f"FROM mv JOIN cs ON cs.label = mv.label LEFT JOIN m ON m.label = mv.label"
    )
    q["mean_vs_median"] = (
        med + ", mv AS (SELECT label, count(value) AS n, round(avg(value), 6) AS mean FROM ev "
        "WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY label) "
        f"SELECT mv.label, mv.n, mv.mean, {_mid_sql('m.ms', b)} AS median_estimate "
        f"FROM mv LEFT JOIN m ON m.label = mv.label")
    q["exact_median"] = (
        med + f", em AS ({median_sql('ev', 'label', 'value')}), mv AS (SELECT label, avg(value) AS mean FROM ev "
        "WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY label) "
        f"SELECT em.label, em.n, round(mv.mean, 6) AS mean, round(em.median, 6) AS median, {_mid_sql('m.ms', b)} "
        f"AS median_estimate FROM em JOIN mv ON mv.label = em.label LEFT JOIN m ON m.label = em.label")
    q["history_sum"] = history_sum_sql()
    q["history_mean"] = history_mean_sql()
    q["history_variance"] = history_variance_sql(stddev=True, squares=True)
    q["history_histogram_median"] = history_histogram_sql()
    q["history_extremes"] = history_extremes_sql()
    q["history_hll"] = history_hll_sql()
    q["history_by_user"] = history_sum_sql(key="user_id", name="user_id")
    exact = "SELECT l_returnflag, count(l_partkey) AS n, count(DISTINCT l_partkey) AS exact, "
    q["distinct_sketch"] = exact + ("true AS approx_in_bounds, true AS sketch_in_bounds "
                                    "FROM lineitem GROUP BY l_returnflag")
    q["distinct_sketch_merged"] = exact + "true AS sketch_in_bounds FROM lineitem GROUP BY l_returnflag"
    ab = ACCTBAL_BINS
    acct = (f"SELECT c_mktsegment, CAST(slot AS BIGINT) AS slot, count(*) AS count FROM "
            f"(SELECT c_mktsegment, {_slot_sql('c_acctbal', ab)} AS slot FROM customer) "
            f"WHERE slot IS NOT NULL GROUP BY c_mktsegment, slot")
    q["histogram_acctbal"] = acct
    q["histogram_median_acctbal"] = (
        f"WITH h AS ({acct}), c AS (SELECT c_mktsegment, slot, sum(count) OVER (PARTITION BY "
        f"c_mktsegment ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum, "
        f"sum(count) OVER (PARTITION BY c_mktsegment) AS n FROM h), "
        f"m AS (SELECT c_mktsegment, CAST(max(n) AS BIGINT) AS n, "
        f"min(CASE WHEN cum > floor(n / 2) THEN slot END) AS ms FROM c GROUP BY c_mktsegment) "
        f"SELECT c_mktsegment, n, {_mid_sql('ms', ab)} AS median_estimate FROM m")
    q["history_orders_monthly"] = (
        "WITH od AS (SELECT o_orderpriority, o_totalprice, "
        "CAST(date_trunc('month', o_orderdate) AS DATE) AS batch FROM orders), "
        "f AS (SELECT o_orderpriority, min(batch) AS first FROM od GROUP BY o_orderpriority), "
        "g AS (SELECT o_orderpriority, CAST(unnest(generate_series(first, "
        "(SELECT max(batch) FROM od), INTERVAL 1 MONTH)) AS DATE) AS batch FROM f) "
        "SELECT g.o_orderpriority, g.batch, count(o.o_totalprice) AS n, "
        "round(avg(o.o_totalprice), 6) AS mean, round(stddev_pop(o.o_totalprice), 6) AS stddev, "
        "round(var_pop(o.o_totalprice), -2) AS variance "
        "FROM g JOIN od o ON o.o_orderpriority = g.o_orderpriority AND o.batch <= g.batch "
        "GROUP BY g.o_orderpriority, g.batch")
    q["variance_by_user"] = ("SELECT user_id, " + mom + " FROM events GROUP BY user_id")
    q["k_largest_by_user"] = (
        f"SELECT user_id, rank, round(value, 6) AS value FROM (SELECT user_id, value, "
        f"row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank "
        f"FROM events WHERE value IS NOT NULL AND NOT isnan(value)) WHERE rank <= {K_LARGEST}")
    q["kalman_final"] = _kalman_sql("event_type", "label", final=True)
    q["kalman_trace"] = _kalman_sql("event_type", "label", final=False)
    q["kalman_by_user"] = _kalman_sql("user_id", "user_id", final=True)
    return q
