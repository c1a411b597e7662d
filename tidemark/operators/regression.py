"""Running regression, forecast and outlier checks.

A fit depends on the window only through its count, means and co-moments. Sums of products are taken about an origin close
to the data (the first row of the key, or of the cell of the window) and never subtracted; two parts of a window are merged
as centred moments. So an offset in x, such as seconds since 1970, costs no digits. The linear algebra and the
significance test work on Arrow batches of those sums.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import ARRIVAL_ORDER, arrivals
from tidemark.ordering import Run, neighbour, plan_split, positions, running


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 400):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + term / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            step = c * d
            h = h * step
        if np.all(np.abs(step - 1.0) < 1e-15):
            break
    return h


def two_sided_p(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| > |t|) of Student's distribution."""
    t, df = np.abs(np.asarray(t, float)), np.asarray(df, float)
    out = np.full(t.shape, np.nan)
    out[np.isinf(t) & (df > 0)] = 0.0
    ok = np.isfinite(t) & (df > 0)
    if ok.any():
        tt, dd = t[ok], df[ok]
        x, a, b = dd / (dd + tt * tt), dd / 2.0, np.full(dd.shape, 0.5)
        lgamma = np.vectorize(math.lgamma, otypes=[float])
        with np.errstate(divide="ignore", invalid="ignore"):
            front = np.exp(
                lgamma(a + b) - lgamma(a) - lgamma(b) + a * np.log(x) + b * np.log1p(-np.minimum(x, 1.0))
            )
            direct = x < (a + 1.0) / (a + b + 2.0)
            low = front * _beta_fraction(a, b, np.where(direct, x, 0.5)) / a
            high = 1.0 - front * _beta_fraction(b, a, np.where(direct, 0.5, 1.0 - x)) / b
        p = np.where(direct, low, high)
        out[ok] = np.where(tt == 0, 1.0, p)
    return out


def _width(predictors: int) -> int:
    d = predictors + 1
    return 1 + d + d * (d + 1) // 2 + d


def _moments(block: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Count, mean about the origin, centred co-moments and origin from rows of sums."""
    n, sums, origin = block[:, 0], block[:, 1 : 1 + d], block[:, -d:]
    products = np.zeros((len(block), d, d))
    upper = np.triu_indices(d)
    products[:, upper[0], upper[1]] = block[:, 1 + d : -d]
    products[:, upper[1], upper[0]] = block[:, 1 + d : -d]
    mean = sums / np.maximum(n, 1.0)[:, None]
    return n, mean, products - mean[:, :, None] * sums[:, None, :], origin


def _merge(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Moments of two parts together, about the origin of the first that has rows."""
    origin = np.where(a[0][:, None] > 0, a[3], b[3])
    means = [(part[3] - origin) * (part[0][:, None] > 0) + part[1] for part in (a, b)]
    n = a[0] + b[0]
    apart = means[1] - means[0]
    share = b[0] / np.maximum(n, 1.0)
    mean = means[0] + apart * share[:, None]
    mean = np.where(a[0][:, None] > 0, mean, means[1])
    between = apart[:, :, None] * apart[:, None, :] * (a[0] * share)[:, None, None]
    return n, mean, a[2] + b[2] + between, origin


def fit_from_moments(parts: np.ndarray, predictors: int, ci: float) -> np.ndarray:
    """Rows of [stdError, beta0, beta1, ...] from one or two parts of sums side by side.

    Coefficients that are not significant at ``ci`` become 0; a window too small
    or singular gives zeros.
    """
    k, width = predictors, _width(predictors)
    known = np.isfinite(parts).all(axis=1)
    parts = np.where(known[:, None], parts, 0.0)
    held = [_moments(parts[:, at : at + width], k + 1) for at in range(0, parts.shape[1], width)]
    n, mean, spread, origin = held[0] if len(held) == 1 else _merge(*held)
    out = np.zeros((len(parts), k + 2))
    free = n - k - 1
    with np.errstate(all="ignore"):
        own = np.einsum("rii->ri", spread[:, :k, :k])
        usable = known & (free > 0) & (own > 4e-13 * (own + n[:, None] * mean[:, :k] ** 2)).all(axis=1)
        scale = np.sqrt(np.where(own > 0, own, 1.0))
        scaled = spread[:, :k, :k] / (scale[:, :, None] * scale[:, None, :])
        condition = np.full(len(parts), np.inf)
        if usable.any():
            condition[usable] = np.linalg.cond(scaled[usable])
        usable &= condition < 1e13
        if usable.any():
            u = usable
            inverse = np.linalg.inv(scaled[u]) / (scale[u][:, :, None] * scale[u][:, None, :])
            slopes = np.einsum("rij,rj->ri", inverse, spread[u, :k, k])
            mse = np.maximum(spread[u, k, k] - np.einsum("ri,ri->r", slopes, spread[u, :k, k]), 0.0) / free[u]
            centre = origin[u] + mean[u]
            start = centre[:, k] - np.einsum("ri,ri->r", slopes, centre[:, :k])
            start_error = 1.0 / n[u] + np.einsum("ri,rij,rj->r", centre[:, :k], inverse, centre[:, :k])
            errors = np.concatenate([start_error[:, None], np.einsum("rii->ri", inverse)], 1)
            betas = np.concatenate([start[:, None], slopes], 1)
            p = two_sided_p(betas / np.sqrt(np.maximum(errors, 0.0) * mse[:, None]), np.repeat(free[u][:, None], k + 1, axis=1))
            out[u, 0] = np.sqrt(mse)
            out[u, 1:] = np.where(p > 1 - ci, 0.0, betas)
    return out


def _fit_column(predictors: int, ci: float):
    @F.pandas_udf("array<double>")
    def fit(sums: pd.Series) -> pd.Series:
        known = sums.notna()
        out = pd.Series([None] * len(sums), dtype=object)
        if known.any():
            block = np.array(sums[known].tolist(), dtype=float)
            out[known] = pd.Series(list(fit_from_moments(block, predictors, ci)), index=sums.index[known])
        return out

    return fit


def _products(values: Sequence[Column], origin: Column) -> list[Column]:
    """Count, sums and products about the origin; a row with a null counts for nothing."""
    whole = F.lit(True)
    for v in values:
        whole = whole & v.isNotNull()
    moved = [v - F.get(origin, F.lit(i)) for i, v in enumerate(values)]
    square = [moved[i] * moved[j] for i in range(len(moved)) for j in range(i, len(moved))]
    return [F.when(whole, c).otherwise(0.0) for c in (F.lit(1.0), *moved, *square)]


def _window_sums(df, y, xs, interval, batch, keys, ts, seq) -> DataFrame:
    """Sums about an origin over the last ``batch`` rows, in one or two parts, refreshed every ``interval`` rows."""
    base = arrivals(df, ts, seq)
    split = plan_split(base, keys, ARRIVAL_ORDER)
    numbered = positions(base, keys, ARRIVAL_ORDER, "_rn", split=split)
    values = [F.col(c).cast("double") for c in (*xs, y)]
    point = F.array(*values)
    whole = F.when(~F.exists(point, lambda v: v.isNull()), point)
    nothing = F.array(*[F.lit(0.0)] * len(values))
    size = _width(len(xs)) - len(values)
    if batch is None:
        place = F.when(whole.isNotNull(), F.struct(*ARRIVAL_ORDER))
        first = base.groupBy(*keys).agg(F.min_by(whole, place).alias("_origin"))
        if keys:
            right = first.select(*[F.col(k).alias(f"_ok{i}") for i, k in enumerate(keys)], "_origin")
            same = F.lit(True)
            for i, k in enumerate(keys):
                same = same & F.col(k).eqNullSafe(F.col(f"_ok{i}"))
            placed = numbered.join(right, same, "left").select(*numbered.columns, "_origin")
        else:
            placed = numbered.withColumn("_origin", first.scalar())
        placed = placed.withColumn("_origin", F.coalesce("_origin", nothing))
        runs = {f"_p{i}": Run("sum", v) for i, v in enumerate(_products(values, F.col("_origin")))}
        summed = running(placed, keys, ARRIVAL_ORDER, runs, split=split)
        packed = summed.withColumn("_sums", F.concat(F.array(*[f"_p{i}" for i in range(size)]), "_origin"))
    else:
        # Cells of ``batch`` rows: a window is the end of one cell and the begin of the next, each about its own origin.
        cell = numbered.withColumn("_cell", F.floor((F.col("_rn") - 1) / batch))
        members = Window.partitionBy(*keys, "_cell")
        placed = cell.withColumn("_origin", F.coalesce(F.first(whole, ignorenulls=True).over(
            members.orderBy("_rn").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), nothing))
        products = _products(values, F.col("_origin"))
        placed = placed.withColumns({f"_p{i}": v for i, v in enumerate(products)})
        so_far = members.orderBy("_rn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        after = members.orderBy(F.col("_rn").desc()).rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumns(
            {
                "_here": F.concat(F.array(*[F.sum(f"_p{i}").over(so_far) for i in range(size)]), "_origin"),
                "_rest": F.concat(F.array(*[F.coalesce(F.sum(f"_p{i}").over(after), F.lit(0.0)) for i in range(size)]), "_origin"),
            }
        )
        placed = placed.withColumnRenamed("_rn", "_n")  # the neighbour numbers rows itself where a key is cut
        met = neighbour(placed, keys, ARRIVAL_ORDER, -batch, {"_before": F.col("_rest")}, split=split).withColumnRenamed("_n", "_rn")
        none = F.array(*[F.lit(0.0)] * _width(len(xs)))
        packed = met.withColumn("_sums", F.concat(F.coalesce("_before", none), "_here"))
    if interval > 1:
        due = F.when(F.col("_rn") % interval == 0, F.col("_sums"))
        packed = running(packed, keys, ARRIVAL_ORDER, {"_kept": Run("last", due)}, split=split).withColumn("_sums", F.col("_kept"))
    return packed.select(*df.columns, "_t", "_s", "_rn", "_sums")


def _fitted(df, y, xs, interval, batch, ci, keys, ts, seq) -> DataFrame:
    sums = _window_sums(df, y, xs, interval, batch, keys, ts, seq)
    return sums.withColumn("_fit", _fit_column(len(xs), ci)("_sums")).drop("_sums")


def regress(
    df: DataFrame,
    y: str,
    xs: Sequence[str],
    *,
    interval: int = 1,
    batch: int | None = None,
    ci: float = 0.95,
    keys: Sequence[str] = (),
    ts="ts",
    seq="seq",
) -> DataFrame:
    """``regress([interval, batch, ci,] y, x, ...)``: ``stdError``, ``beta0``, ``beta1``, ... per event.

    The fit covers the last ``batch`` events (all of them without one) and is repeated until the next
    multiple of ``interval``; before the first one it is null.
    """
    out = _fitted(df, y, xs, interval, batch, ci, keys, ts, seq)
    names = ["stdError", *[f"beta{i}" for i in range(len(xs) + 1)]]
    return out.select(*df.columns, *[F.get("_fit", F.lit(i)).alias(n) for i, n in enumerate(names)])


def forecast(df, expression: Column, y: str, x: str, **options) -> DataFrame:
    """``forecast(..., expression, y, x)``: the fitted value at ``expression``."""
    out = regress(df, y, [x], **options)
    return out.withColumn("forecastY", F.col("beta0") + F.col("beta1") * expression.cast("double"))


def outlier(
    df: DataFrame, spread: float, y: str, x: str, *, interval: int = 1, batch: int | None = None,
    ci: float = 0.95, keys: Sequence[str] = (), ts="ts", seq="seq",
) -> DataFrame:
    """``outlier(..., range, y, x)``: is ``y`` outside the previous fit by ``range`` standard errors.

    Null until more than three events (and more than ``interval``) are seen.
    """
    fits = _fitted(df, y, [x], interval, batch, ci, keys, ts, seq)
    split = plan_split(arrivals(df, ts, seq), keys, ARRIVAL_ORDER)
    before = neighbour(fits, keys, ARRIVAL_ORDER, -1, {"_prev": F.col("_fit")}, split=split)
    ready = F.col("_rn") > max(3, interval)
    at = lambda a, i: F.get(a, F.lit(i))
    centre = at("_prev", 1) + at("_prev", 2) * F.col(x)
    reach = at("_prev", 0) * F.lit(float(spread))
    off = (F.col(y) < centre - reach) | (F.col(y) > centre + reach)
    names = ("stdError", "beta0", "beta1")
    return before.select(
        *df.columns,
        F.when(ready, off).alias("outlier"),
        *[F.when(ready, at("_fit", i)).alias(n) for i, n in enumerate(names)],
    )
