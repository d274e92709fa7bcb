"""Catalog: ordered fills on events (Q27-Q31)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lacuna.operators.ordered import ForwardBackwardFillImputer, InterpolationImputer
from lacuna.plans.common import masked, masked_sql
from lacuna.plans.registry import query

EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
EV_MASKS = {"value": (31, 250), "event_type": (32, 250)}
ORDER = ["ts", "event_id"]


def _ev(spark, sf):
    return masked(spark, sf, "events", "event_id", EV_MASKS).select("event_id", "ts", "user_id", "event_type", "value")


M_SQL = f"m AS ({masked_sql('events', EV_COLS, 'event_id', EV_MASKS)})"


def _win(part: bool, frame: str) -> str:
    p = "PARTITION BY user_id " if part else ""
    return f"OVER ({p}ORDER BY ts, event_id ROWS BETWEEN {frame})"


def _ctx_sql(c: str, part: bool = True) -> str:
    """prev/next observed value, position and key of column c, as SQL."""
    p = "PARTITION BY user_id " if part else ""
    up = _win(part, "UNBOUNDED PRECEDING AND CURRENT ROW")
    dn = _win(part, "CURRENT ROW AND UNBOUNDED FOLLOWING")
    return f"""SELECT *, last_value({c} IGNORE NULLS) {up} AS pv,
      last_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) {up} AS pp,
      last_value(CASE WHEN {c} IS NOT NULL THEN k END IGNORE NULLS) {up} AS pk,
      first_value({c} IGNORE NULLS) {dn} AS nv,
      first_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) {dn} AS np,
      first_value(CASE WHEN {c} IS NOT NULL THEN k END IGNORE NULLS) {dn} AS nk
    FROM (SELECT *, row_number() OVER ({p}ORDER BY ts, event_id) AS rn,
                 CAST(epoch_us(ts) AS DOUBLE) AS k FROM m) r"""


# ------------------------------------------------------------------ Q27 ffill per user
def q27(spark, sf):
    out = ForwardBackwardFillImputer("ffill", ORDER, "user_id", columns=["value", "event_type"]).fit_transform(_ev(spark, sf))
    return out.select("event_id", "user_id", "event_type", F.round("value", 8).alias("value"))


Q27_SQL = f"""WITH {M_SQL}
SELECT event_id, user_id,
  coalesce(event_type, last_value(event_type IGNORE NULLS) {_win(True, 'UNBOUNDED PRECEDING AND CURRENT ROW')}) AS event_type,
  round(coalesce(value, last_value(value IGNORE NULLS) {_win(True, 'UNBOUNDED PRECEDING AND CURRENT ROW')}), 8) AS value
FROM m"""
query("q27_ffill_per_user", Q27_SQL)(q27)


# ------------------------------------------------------------------ Q28 bfill with limit, ffill with limit
def q28(spark, sf):
    ev = _ev(spark, sf)
    b = ForwardBackwardFillImputer("bfill", ORDER, "user_id", limit=2, columns=["value"]).fit_transform(ev)
    f = ForwardBackwardFillImputer("ffill", ORDER, "user_id", limit=1, columns=["value"]).fit_transform(ev)
    return (b.select("event_id", "user_id", F.round("value", 8).alias("value_bfill2"))
            .join(f.select("event_id", F.round("value", 8).alias("value_ffill1")), "event_id"))


Q28_SQL = f"""WITH {M_SQL}
SELECT event_id, user_id,
  round(coalesce(value, first_value(value IGNORE NULLS) {_win(True, 'CURRENT ROW AND 2 FOLLOWING')}), 8) AS value_bfill2,
  round(coalesce(value, last_value(value IGNORE NULLS) {_win(True, '1 PRECEDING AND CURRENT ROW')}), 8) AS value_ffill1
FROM m"""
query("q28_bfill_limit", Q28_SQL)(q28)


# ------------------------------------------------------------------ Q29 global ffill (no series key)
def q29(spark, sf):
    ev = _ev(spark, sf)
    a = ForwardBackwardFillImputer("ffill", ORDER, columns=["value"]).fit_transform(ev)
    b = ForwardBackwardFillImputer("ffill", ORDER, limit=3, columns=["value"]).fit_transform(ev)
    c = ForwardBackwardFillImputer("bfill", ORDER, columns=["value"]).fit_transform(ev)
    return (a.select("event_id", F.round("value", 8).alias("value_ffill"))
            .join(b.select("event_id", F.round("value", 8).alias("value_ffill3")), "event_id")
            .join(c.select("event_id", F.round("value", 8).alias("value_bfill")), "event_id"))


Q29_SQL = f"""WITH {M_SQL}
SELECT event_id,
  round(coalesce(value, last_value(value IGNORE NULLS) {_win(False, 'UNBOUNDED PRECEDING AND CURRENT ROW')}), 8) AS value_ffill,
  round(coalesce(value, last_value(value IGNORE NULLS) {_win(False, '3 PRECEDING AND CURRENT ROW')}), 8) AS value_ffill3,
  round(coalesce(value, first_value(value IGNORE NULLS) {_win(False, 'CURRENT ROW AND UNBOUNDED FOLLOWING')}), 8) AS value_bfill
FROM m"""
query("q29_ffill_global", Q29_SQL)(q29)


# ------------------------------------------------------------------ Q30 linear interpolation
def q30(spark, sf):
    ev = _ev(spark, sf)
    a = InterpolationImputer("linear", ORDER, "user_id", columns=["value"]).fit_transform(ev)
    g = InterpolationImputer("linear", ORDER, columns=["value"]).fit_transform(ev)
    return (a.select("event_id", "user_id", F.round("value", 8).alias("value_linear"))
            .join(g.select("event_id", F.round("value", 8).alias("value_linear_global")), "event_id"))


def _linear(x: str, a: str, b: str) -> str:
    return (f"CASE WHEN value IS NOT NULL THEN value WHEN pv IS NOT NULL AND nv IS NOT NULL "
            f"THEN pv + (nv - pv) * ({x} - {a}) / ({b} - {a}) WHEN pv IS NOT NULL THEN pv END")


Q30_SQL = f"""WITH {M_SQL},
c1 AS ({_ctx_sql('value', True)}),
c2 AS ({_ctx_sql('value', False)})
SELECT c1.event_id, c1.user_id, round({_linear('c1.rn', 'c1.pp', 'c1.np').replace('value', 'c1.value').replace('pv', 'c1.pv').replace('nv', 'c1.nv')}, 8) AS value_linear,
       round({_linear('c2.rn', 'c2.pp', 'c2.np').replace('value', 'c2.value').replace('pv', 'c2.pv').replace('nv', 'c2.nv')}, 8) AS value_linear_global
FROM c1 JOIN c2 ON c1.event_id = c2.event_id"""
query("q30_linear_interpolation", Q30_SQL)(q30)


# ------------------------------------------------------------------ Q31 time, nearest, zero
def q31(spark, sf):
    ev = _ev(spark, sf)
    outs = {}
    for meth in ("time", "nearest", "zero"):
        outs[meth] = InterpolationImputer(meth, ORDER, "user_id", columns=["value"]).fit_transform(ev)
    return (outs["time"].select("event_id", "user_id", F.round("value", 8).alias("value_time"))
            .join(outs["nearest"].select("event_id", F.round("value", 8).alias("value_nearest")), "event_id")
            .join(outs["zero"].select("event_id", F.round("value", 8).alias("value_zero")), "event_id"))


Q31_SQL = f"""WITH {M_SQL},
c AS ({_ctx_sql('value', True)})
SELECT event_id, user_id, round({_linear('k', 'pk', 'nk')}, 8) AS value_time,
  round(CASE WHEN value IS NOT NULL THEN value WHEN pv IS NOT NULL AND nv IS NOT NULL
             THEN CASE WHEN rn - pp <= np - rn THEN pv ELSE nv END END, 8) AS value_nearest,
  round(CASE WHEN value IS NOT NULL THEN value WHEN pv IS NOT NULL AND nv IS NOT NULL THEN pv END, 8) AS value_zero
FROM c"""
query("q31_time_nearest_zero", Q31_SQL)(q31)


# ------------------------------------------------------------------ Q32 polynomial and spline
from lacuna.operators.curves import CurveInterpolationImputer  # noqa: E402


def q32(spark, sf):
    ev = _ev(spark, sf)
    p = CurveInterpolationImputer("polynomial", 2, ORDER, "user_id", "value").fit_transform(ev)
    s = CurveInterpolationImputer("spline", 3, ORDER, "user_id", "value").fit_transform(ev)
    return (p.select("event_id", "user_id", F.round("value", 4).alias("value_poly2"))
            .join(s.select("event_id", F.round("value", 4).alias("value_spline3")), "event_id"))


# The splines in SQL: a tridiagonal system per series (second derivatives for the cubic, values at
# the knots midway between observations for the quadratic), solved by elimination in two
# recursions, then evaluated between observations.
def _solve_sql(eq: str, name: str) -> str:
    return f"""
{name}_f AS (SELECT user_id, i, n, c / b AS cp, d / b AS dp FROM {eq} WHERE i = 1
  UNION ALL SELECT e.user_id, e.i, e.n, e.c / (e.b - e.a * f.cp), (e.d - e.a * f.dp) / (e.b - e.a * f.cp)
  FROM {name}_f f JOIN {eq} e ON e.user_id = f.user_id AND e.i = f.i + 1),
{name}_s AS (SELECT user_id, i, dp AS s FROM {name}_f WHERE i = n
  UNION ALL SELECT f.user_id, f.i, f.dp - f.cp * t.s FROM {name}_s t JOIN {name}_f f ON f.user_id = t.user_id AND f.i = t.i - 1)"""


def _three_sql(x: str, p: str, q: str, r: str, fp: str, fq: str, fr: str) -> str:
    """The parabola through three points."""
    return (f"({fp} * ({x} - {q}) * ({x} - {r}) / (({p} - {q}) * ({p} - {r})) + {fq} * ({x} - {p}) * ({x} - {r}) / (({q} - {p}) * ({q} - {r}))"
            f" + {fr} * ({x} - {p}) * ({x} - {q}) / (({r} - {p}) * ({r} - {q})))")


def _slope_sql(p: str, q: str, t: str) -> str:
    """Weight of the value at p in the slope at t of the parabola through p, q and t."""
    return f"(({t} - {q}) / (({p} - {q}) * ({p} - {t})))"


Q32_SQL = f"""WITH RECURSIVE {M_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::DOUBLE AS rn FROM m),
o AS (SELECT user_id, rn AS x, value AS y, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n,
        lag(rn) OVER w AS x0, lag(value) OVER w AS y0, lead(rn) OVER w AS x1, lead(value) OVER w AS y1,
        lag(rn, 2) OVER w AS xb, lead(rn, 2) OVER w AS xa, lag(value, 2) OVER w AS yb, lead(value, 2) OVER w AS ya
      FROM r WHERE value IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY rn)),
c0 AS (SELECT user_id, i, n - 2 AS n, x - x0 AS g, x1 - x AS h, x0 - xb AS gb, xa - x1 AS ha,
         6 * ((y1 - y) / (x1 - x) - (y - y0) / (x - x0)) / (x1 - x0) AS d FROM o WHERE n >= 4 AND i BETWEEN 1 AND n - 2),
c1 AS (SELECT user_id, i, n, d,
         CASE WHEN i = 1 THEN 0 WHEN i = n THEN g / (g + h) - h / (g + h) * h / g ELSE g / (g + h) END AS a,
         2 + CASE WHEN i = 1 THEN g / (g + h) * (1 + g / h) ELSE 0 END + CASE WHEN i = n THEN h / (g + h) * (1 + h / g) ELSE 0 END AS b,
         CASE WHEN i = n THEN 0 WHEN i = 1 THEN h / (g + h) - g / (g + h) * g / h ELSE h / (g + h) END AS c FROM c0),
{_solve_sql('c1', 'c')},
c2 AS (SELECT o.user_id, o.i, CASE WHEN o.i = 0 THEN (1 + (x1 - x) / (xa - x1)) * u.s - (x1 - x) / (xa - x1) * v.s
         WHEN o.i = o.n - 1 THEN (1 + (x - x0) / (x0 - xb)) * u.s - (x - x0) / (x0 - xb) * v.s ELSE k.s END AS s
       FROM o LEFT JOIN c_s k ON k.user_id = o.user_id AND k.i = o.i
       LEFT JOIN c_s u ON u.user_id = o.user_id AND u.i = CASE WHEN o.i = 0 THEN 1 ELSE o.n - 2 END
       LEFT JOIN c_s v ON v.user_id = o.user_id AND v.i = CASE WHEN o.i = 0 THEN 2 ELSE o.n - 3 END WHERE o.n >= 4),
k0 AS (SELECT user_id, i, n - 3 AS n, (x + x1) / 2 AS t, x AS ql, y AS yl, x1 AS qr, y1 AS yr, y0 AS yp, ya AS yq,
         CASE WHEN i = 1 THEN x0 ELSE (x0 + x) / 2 END AS pl, CASE WHEN i = n - 3 THEN xa ELSE (x1 + xa) / 2 END AS pr
       FROM o WHERE n >= 4 AND i BETWEEN 1 AND n - 3),
k1 AS (SELECT user_id, i, n, CASE WHEN i = 1 THEN 0 ELSE {_slope_sql('pl', 'ql', 't')} END AS a,
         1 / (t - pl) + 1 / (t - ql) - 1 / (t - pr) - 1 / (t - qr) AS b,
         CASE WHEN i = n THEN 0 ELSE -{_slope_sql('pr', 'qr', 't')} END AS c,
         yr * {_slope_sql('qr', 'pr', 't')} + CASE WHEN i = n THEN yq * {_slope_sql('pr', 'qr', 't')} ELSE 0 END
         - yl * {_slope_sql('ql', 'pl', 't')} - CASE WHEN i = 1 THEN yp * {_slope_sql('pl', 'ql', 't')} ELSE 0 END AS d FROM k0),
{_solve_sql('k1', 'k')},
q AS (SELECT o.user_id, o.i, o.n, x AS q, y AS fq, CASE WHEN o.i = 1 THEN x0 ELSE (x0 + x) / 2 END AS p, CASE WHEN o.i = 1 THEN y0 ELSE l.s END AS fp,
        CASE WHEN o.i = o.n - 2 THEN x1 ELSE (x + x1) / 2 END AS r, CASE WHEN o.i = o.n - 2 THEN y1 ELSE u.s END AS fr
      FROM o LEFT JOIN k_s l ON l.user_id = o.user_id AND l.i = o.i - 1 LEFT JOIN k_s u ON u.user_id = o.user_id AND u.i = o.i
      WHERE o.n >= 3 AND o.i BETWEEN 1 AND o.n - 2),
h AS (SELECT r.user_id, r.event_id, r.rn, r.value, cnt.n, coalesce(p.i, -1) AS before
      FROM (SELECT *, last_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS)
                        OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp FROM r) r
      LEFT JOIN o p ON p.user_id = r.user_id AND p.x = r.pp LEFT JOIN (SELECT DISTINCT user_id, n FROM o) cnt ON cnt.user_id = r.user_id),
e AS (SELECT h.*, a.x AS xl, a.y AS yl, a.x1 AS xr, a.y1 AS yr, s.s AS sl, t.s AS sr, z.x AS zx, z.y AS zy, z.x1, z.y1, z.xa, z.ya,
        j.p, j.q, j.r, j.fp, j.fq, j.fr
      FROM h LEFT JOIN o a ON a.user_id = h.user_id AND a.i = greatest(0, least(h.before, h.n - 2))
      LEFT JOIN c2 s ON s.user_id = a.user_id AND s.i = a.i LEFT JOIN c2 t ON t.user_id = a.user_id AND t.i = a.i + 1
      LEFT JOIN o z ON z.user_id = h.user_id AND z.i = 0
      LEFT JOIN q j ON j.user_id = h.user_id AND j.i = greatest(1, least(h.n - 2, a.i + CASE WHEN h.rn <= (a.x + a.x1) / 2 THEN 0 ELSE 1 END)))
SELECT event_id, user_id,
  round(CASE WHEN value IS NOT NULL THEN value WHEN before < 0 OR before >= n - 1 THEN NULL
        WHEN n = 2 THEN yl + (yr - yl) * (rn - xl) / (xr - xl) ELSE {_three_sql('rn', 'p', 'q', 'r', 'fp', 'fq', 'fr')} END, 4) AS value_poly2,
  round(CASE WHEN value IS NOT NULL THEN value WHEN n = 1 THEN zy WHEN n = 2 THEN yl + (yr - yl) * (rn - xl) / (xr - xl)
        WHEN n = 3 THEN {_three_sql('rn', 'zx', 'x1', 'xa', 'zy', 'y1', 'ya')}
        ELSE (sl * (xr - rn) * (xr - rn) * (xr - rn) + sr * (rn - xl) * (rn - xl) * (rn - xl)) / (6 * (xr - xl))
             + (yl / (xr - xl) - sl * (xr - xl) / 6) * (xr - rn) + (yr / (xr - xl) - sr * (xr - xl) / 6) * (rn - xl) END, 4) AS value_spline3
FROM e"""
query("q32_polynomial_and_spline", Q32_SQL)(q32)


def q32b(spark, sf):
    """Order-1 polynomial equals linear interpolation inside the observed range."""
    ev = _ev(spark, sf)
    p = CurveInterpolationImputer("polynomial", 1, ORDER, "user_id", "value").fit_transform(ev)
    return p.select("event_id", "user_id", F.round("value", 8).alias("value"))


Q32B_SQL = f"""WITH {M_SQL},
c AS ({_ctx_sql('value', True)})
SELECT event_id, user_id, round(CASE WHEN value IS NOT NULL THEN value WHEN pv IS NOT NULL AND nv IS NOT NULL
             THEN pv + (nv - pv) * (rn - pp) / (np - pp) END, 8) AS value
FROM c"""
query("q32b_polynomial_order1", Q32B_SQL)(q32b)


# ------------------------------------------------------------------ forced multi-bucket plans
# The default bucket count follows the longest series, so at small scale every
# series is one chunk.  These variants force many buckets to exercise the
# cross-bucket carry (and the halo of the curve fill) on the same oracles.

def q29b(spark, sf):
    ev = _ev(spark, sf)
    a = ForwardBackwardFillImputer("ffill", ORDER, columns=["value"], buckets=16).fit_transform(ev)
    b = ForwardBackwardFillImputer("ffill", ORDER, limit=3, columns=["value"], buckets=16).fit_transform(ev)
    c = ForwardBackwardFillImputer("bfill", ORDER, columns=["value"], buckets=16).fit_transform(ev)
    return (a.select("event_id", F.round("value", 8).alias("value_ffill"))
            .join(b.select("event_id", F.round("value", 8).alias("value_ffill3")), "event_id")
            .join(c.select("event_id", F.round("value", 8).alias("value_bfill")), "event_id"))


query("q29b_ffill_global_bucketed", Q29_SQL)(q29b)


def q30b(spark, sf):
    ev = _ev(spark, sf)
    a = InterpolationImputer("linear", ORDER, "user_id", columns=["value"], buckets=16).fit_transform(ev)
    g = InterpolationImputer("linear", ORDER, columns=["value"], buckets=16).fit_transform(ev)
    return (a.select("event_id", "user_id", F.round("value", 8).alias("value_linear"))
            .join(g.select("event_id", F.round("value", 8).alias("value_linear_global")), "event_id"))


query("q30b_linear_interpolation_bucketed", Q30_SQL)(q30b)


def q32c(spark, sf):
    ev = _ev(spark, sf)
    p = CurveInterpolationImputer("polynomial", 1, ORDER, "user_id", "value", buckets=16).fit_transform(ev)
    return p.select("event_id", "user_id", F.round("value", 8).alias("value"))


query("q32c_polynomial_order1_bucketed", Q32B_SQL)(q32c)


# ------------------------------------------------------------------ null series keys, null order keys
def q29c(spark, sf):
    """Series and order keys with holes: null users are one series, null times come first, and
    the number of chunks doesn't matter."""
    ev = masked(spark, sf, "events", "event_id", {**EV_MASKS, "user_id": (33, 300), "ts": (34, 200)})
    ev = ev.select("event_id", "ts", "user_id", "value")
    a = ForwardBackwardFillImputer("ffill", ORDER, "user_id", columns=["value"], buckets=16).fit_transform(ev)
    b = ForwardBackwardFillImputer("bfill", ORDER, "user_id", limit=2, columns=["value"], buckets=5).fit_transform(ev)
    c = InterpolationImputer("linear", ORDER, "user_id", columns=["value"]).fit_transform(ev)
    return (a.select("event_id", F.round("value", 8).alias("value_ffill"))
            .join(b.select("event_id", F.round("value", 8).alias("value_bfill2")), "event_id")
            .join(c.select("event_id", F.round("value", 8).alias("value_linear")), "event_id"))


def _q29c_sql() -> str:
    m = masked_sql("events", EV_COLS, "event_id", {**EV_MASKS, "user_id": (33, 300), "ts": (34, 200)})
    w = "PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id"
    up, down = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW", "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    return f"""WITH m AS ({m}),
r AS (SELECT *, row_number() OVER ({w}) AS rn FROM m),
c AS (SELECT event_id, value, rn, last_value(value IGNORE NULLS) OVER ({w} {up}) AS pv, first_value(value IGNORE NULLS) OVER ({w} {down}) AS nv,
        last_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER ({w} {up}) AS pp,
        first_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER ({w} {down}) AS np FROM r)
SELECT event_id, round(coalesce(value, pv), 8) AS value_ffill,
       round(coalesce(value, CASE WHEN np - rn <= 2 THEN nv END), 8) AS value_bfill2,
       round(CASE WHEN value IS NOT NULL THEN value WHEN pv IS NOT NULL AND nv IS NOT NULL THEN pv + (nv - pv) * (rn - pp) / (np - pp)
                  WHEN pv IS NOT NULL THEN pv END, 8) AS value_linear
FROM c"""


query("q29c_fills_with_null_keys", _q29c_sql())(q29c)
