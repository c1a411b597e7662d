"""Queries of running regression.

The SQL twins compute Student's probability from its finite series for whole
degrees of freedom, independently of the library's incomplete beta function.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.operators import regression as G
from tidemark.operators import select as sel
from tidemark.plans.registry import query

KEY = ["user_id"]


def points(t):
    """y depends on x (the number in ``props``), so that some coefficients are significant."""
    k = F.get_json_object("props", "$.k").cast("double")
    return t.events.select("event_id", "ts", "seq", "user_id", "event_type", k.alias("x"), (k * 2 + F.col("value")).alias("y"))


POINTS = """(SELECT event_id, epoch_us(ts) AS us, user_id, event_type, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS x,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) * 2 + value AS y FROM events)"""


def _inside(t: str, df: str) -> str:
    """P(|T| < |t|) by the finite series."""
    theta = f"atan(abs({t}) / sqrt({df}))"
    even = f"sin({theta}) * list_sum(list_transform(range(0, CAST({df} AS BIGINT) // 2), lambda i: exp(lgamma(i + 0.5) - lgamma(i + 1.0)) / sqrt(pi()) * pow(cos({theta}), 2 * i)))"
    odd = f"2 / pi() * ({theta} + sin({theta}) * cos({theta}) * coalesce(list_sum(list_transform(range(0, (CAST({df} AS BIGINT) - 1) // 2), lambda i: sqrt(pi()) / 2 * exp(lgamma(i + 1.0) - lgamma(i + 1.5)) * pow(cos({theta}), 2 * i))), 0))"
    return f"(CASE WHEN CAST({df} AS BIGINT) % 2 = 0 THEN {even} ELSE {odd} END)"


def _simple_sql(frame: str, source: str = POINTS, partition: str = "PARTITION BY user_id") -> str:
    return f"""s AS (SELECT *, count(*) OVER w AS n, avg(x) OVER w AS mx, avg(y) OVER w AS my, var_pop(x) OVER w * count(*) OVER w AS sxx,
      var_pop(y) OVER w * count(*) OVER w AS syy, covar_pop(y, x) OVER w * count(*) OVER w AS sxy, sum(x * x) OVER w AS qx, row_number() OVER (PARTITION BY user_id ORDER BY us) AS rn
      FROM {source} WINDOW w AS ({partition} ORDER BY us {frame})),
    f AS (SELECT *, sxy / sxx AS b1, my - sxy / sxx * mx AS b0, sqrt(greatest(syy - sxy * sxy / sxx, 0) / (n - 2)) AS se FROM s WHERE n > 2),
    p AS (SELECT *, b1 / (se / sqrt(sxx)) AS t1, b0 / (se * sqrt(qx / (n * sxx))) AS t0, n - 2 AS df FROM f),
    r AS (SELECT event_id, se, CASE WHEN 1 - {_inside('t0', 'df')} > 0.05 THEN 0 ELSE b0 END AS b0, CASE WHEN 1 - {_inside('t1', 'df')} > 0.05 THEN 0 ELSE b1 END AS b1 FROM p),
    fit AS (SELECT s.*, coalesce(r.se, 0) AS se, coalesce(r.b0, 0) AS b0, coalesce(r.b1, 0) AS b1 FROM s LEFT JOIN r ON s.event_id = r.event_id)"""


def _rounded(df, *names):
    return df.select("event_id", *[F.round(c, 5).alias(c) for c in names])


@query(
    "ts_regress_simple",
    f"WITH {_simple_sql('ROWS UNBOUNDED PRECEDING')} SELECT event_id, round(se, 5) AS \"stdError\", round(b0, 5) AS beta0, round(b1, 5) AS beta1 FROM fit",
)
def ts_regress_simple(t):
    return _rounded(G.regress(points(t), "y", ["x"], keys=KEY), "stdError", "beta0", "beta1")


@query(
    "ts_regress_batch",
    f"""WITH {_simple_sql('ROWS BETWEEN 19 PRECEDING AND CURRENT ROW')}, k AS (SELECT *, rn - rn % 3 AS at FROM fit)
    SELECT a.event_id, round(b.se, 5) AS "stdError", round(b.b0, 5) AS beta0, round(b.b1, 5) AS beta1 FROM k a LEFT JOIN k b ON a.user_id = b.user_id AND b.rn = a.at""",
)
def ts_regress_batch(t):
    return _rounded(G.regress(points(t), "y", ["x"], interval=3, batch=20, keys=KEY), "stdError", "beta0", "beta1")


@query(
    "ts_forecast",
    f"WITH {_simple_sql('ROWS UNBOUNDED PRECEDING')} SELECT event_id, round(b0 + b1 * (x + 2), 4) AS \"forecastY\" FROM fit",
)
def ts_forecast(t):
    out = G.forecast(points(t), F.col("x") + 2, "y", "x", keys=KEY)
    return out.select("event_id", F.round("forecastY", 4).alias("forecastY"))


@query(
    "ts_outlier",
    f"""WITH {_simple_sql('ROWS UNBOUNDED PRECEDING')}, q AS (SELECT *, lag(se) OVER w AS ps, lag(b0) OVER w AS p0, lag(b1) OVER w AS p1 FROM fit WINDOW w AS (PARTITION BY user_id ORDER BY us))
    SELECT event_id, CASE WHEN rn > 3 THEN y < p0 + p1 * x - 2 * ps OR y > p0 + p1 * x + 2 * ps END AS outlier FROM q""",
)
def ts_outlier(t):
    return G.outlier(points(t), 2.0, "y", "x", keys=KEY).select("event_id", "outlier")


@query(
    "ts_season_disc",
    f"""WITH {_simple_sql('ROWS UNBOUNDED PRECEDING', "(SELECT event_id, us, user_id, y, CASE WHEN strftime(make_timestamp(us), '%d') LIKE '%1%' THEN 1.0 ELSE 0.0 END AS x FROM " + POINTS + ")")}
    SELECT event_id, round(b0 + 0.0000013, 5) AS beta0 FROM fit WHERE n > 2 AND sxx > 1e-9""",
)
def ts_season_disc(t):
    p = points(t).withColumn("ms", F.unix_millis("ts"))
    day = S.convert(p, "ms", "string", "dd")
    split = p.withColumn("part", day)
    one = split.filter(F.contains("part", F.lit("1"))).withColumn("dum", F.lit(1.0))
    zero = split.filter(~F.contains("part", F.lit("1"))).withColumn("dum", F.lit(0.0))
    fit = G.regress(sel.merge(one, zero), "y", ["dum"], keys=KEY)
    both = fit.filter(F.col("stdError") > 0)
    # Means of 2, 4, 8, ... cents fall exactly between two roundings; both sides are moved off that edge.
    return _rounded(both.withColumn("beta0", F.col("beta0") + 0.0000013), "beta0")


# Seconds since 1970 as x; the twin shifts them by whole seconds, which keeps its own sums exact.
EPOCH = "(SELECT event_id, epoch_us(ts) AS us, user_id, (epoch_us(ts) // 1000000 - 1704067200) / 60.0 AS x, value + ((epoch_us(ts) // 1000000 - 1704067200) / 3600.0) AS y FROM events)"


@query(
    "ts_regress_epoch",
    f"""WITH {_simple_sql('ROWS BETWEEN 29 PRECEDING AND CURRENT ROW', EPOCH)}
    SELECT event_id, round(se, 5) AS "stdError", round(b1 / 60 * 1e6, 4) AS slope FROM fit""",
)
def ts_regress_epoch(t):
    seconds = F.unix_seconds("ts")
    p = t.events.select("event_id", "ts", "seq", "user_id", seconds.alias("x"), (F.col("value") + (seconds - 1_704_067_200) / 3600.0).alias("y"))
    fit = G.regress(p, "y", ["x"], batch=30, keys=KEY)
    return fit.select("event_id", F.round("stdError", 5).alias("stdError"), F.round(F.col("beta1") * 1e6, 4).alias("slope"))


MULTI = """s AS (SELECT *, count(*) OVER w AS n, avg(x) OVER w AS mx, avg(z) OVER w AS mz, avg(y) OVER w AS my, var_pop(x) OVER w * count(*) OVER w AS sxx, var_pop(z) OVER w * count(*) OVER w AS szz,
      var_pop(y) OVER w * count(*) OVER w AS syy, covar_pop(x, z) OVER w * count(*) OVER w AS sxz, covar_pop(x, y) OVER w * count(*) OVER w AS sxy, covar_pop(z, y) OVER w * count(*) OVER w AS szy
      FROM (SELECT *, %s AS z FROM """ + POINTS + """) WINDOW w AS (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING)),
    d AS (SELECT *, sxx * szz - sxz * sxz AS det FROM s WHERE n > 5),
    b AS (SELECT *, (sxy * szz - szy * sxz) / det AS b1, (szy * sxx - sxy * sxz) / det AS b2 FROM d),
    f AS (SELECT *, my - b1 * mx - b2 * mz AS b0, greatest(syy - b1 * sxy - b2 * szy, 0) / (n - 3) AS mse, n - 3 AS df FROM b),
    p AS (SELECT *, b0 / sqrt(mse * (1.0 / n + (mx * mx * szz - 2 * mx * mz * sxz + mz * mz * sxx) / det)) AS t0, b1 / sqrt(mse * szz / det) AS t1, b2 / sqrt(mse * sxx / det) AS t2 FROM f)"""


def _multi_select() -> str:
    parts = [f"round(CASE WHEN 1 - {_inside(f't{i}', 'df')} > 0.05 THEN 0 ELSE b{i} END, 4) AS beta{i}" for i in range(3)]
    return f"SELECT event_id, round(sqrt(mse), 4) AS \"stdError\", {', '.join(parts)} FROM p"


def _multi(df):
    # Fits of the first few rows of a key are exact or singular; the comparison starts after them.
    from tidemark.operators.aggregates import with_positions

    fit = G.regress(with_positions(df, keys=KEY, name="place"), "y", ["x", "z"], keys=KEY)
    later = fit.filter(F.col("place") > 5)
    return later.select("event_id", *[F.round(c, 4).alias(c) for c in ("stdError", "beta0", "beta1", "beta2")])


@query("ts_regress_multi", f"WITH {MULTI % 'CAST(event_id % 13 AS DOUBLE)'} {_multi_select()}")
def ts_regress_multi(t):
    return _multi(points(t).withColumn("z", (F.col("event_id") % 13).cast("double")))


@query("ts_season_cont", f"WITH {MULTI % 'sin(x)'} {_multi_select()}")
def ts_season_cont(t):
    return _multi(points(t).withColumn("z", S.sine(F.col("x"))))
