"""Aggregates over change streams, batches and whole streams."""

from __future__ import annotations

import inspect
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import intervals
from tidemark.operators.windows import ARRIVAL_ORDER, CHANGE_ORDER, CHANGED_ROWS_PER_RANGE, arrivals
from tidemark.ordering import Run, Split, plan_split, positions, running


def checked_sum(df: DataFrame, name: str) -> Column:
    """``sum``: integers give BIGINT, fractions give DOUBLE, nothing gives 0."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.IntegerType, T.LongType, T.ShortType)):
        return F.coalesce(F.sum(F.col(name).cast("bigint")), F.lit(0).cast("bigint"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.coalesce(F.sum(F.col(name).cast("double")), F.lit(0.0))
    raise TypeError(f"sum needs a number, {name} is {kind.simpleString()}")


def average(value: Column) -> Column:
    """``avg``: DOUBLE, 0 over nothing."""
    return F.coalesce(F.avg(value.cast("double")), F.lit(0.0))


def count_rows() -> Column:
    """``count``: rows, null arguments included."""
    return F.count(F.lit(1))


def over_changes(
    changes: DataFrame,
    group: Sequence[str] = (),
    *,
    sums: dict[str, str] | None = None,
    averages: dict[str, str] | None = None,
    count: str | None = None,
    lows: dict[str, str] | None = None,
    highs: dict[str, str] | None = None,
    split: Split | None = None,
) -> DataFrame:
    """Window aggregates after each change, by adding current and subtracting expired rows.

    The cost per row does not depend on how many rows are live. ``lows`` and ``highs`` are extremes over any kind of
    window; they cannot be subtracted and come from the pieces of live intervals.
    """
    sums, averages = sums or {}, averages or {}
    runs = {"_n": Run("sum", F.col("_sign").cast("bigint"))}
    if lows or highs:
        runs["_pos"] = Run("count")
    for out, col in {**sums, **averages}.items():
        runs[f"_s_{out}"] = Run("sum", F.col("_sign") * F.col(col))
        runs[f"_n_{out}"] = Run("sum", F.when(F.col(col).isNotNull(), F.col("_sign")).otherwise(0).cast("bigint"))
    out = running(changes, tuple(group), CHANGE_ORDER, runs, split=split)
    cols = {o: F.when(F.col(f"_n_{o}") == 0, F.lit(0)).otherwise(F.col(f"_s_{o}")) for o in sums}
    cols |= {
        o: F.when(F.col(f"_n_{o}") == 0, F.lit(0.0)).otherwise(F.col(f"_s_{o}") / F.col(f"_n_{o}"))
        for o in averages
    }
    if count:
        cols[count] = F.col("_n")
    if lows or highs:
        out = intervals.extremes(out, group, lows=lows, highs=highs)
    return out.withColumns(cols).drop(*runs)


def over_window(
    df: DataFrame,
    window,
    *args,
    keys: Sequence[str] = (),
    group: Sequence[str] | None = None,
    ts="ts",
    seq="seq",
    sums: dict[str, str] | None = None,
    averages: dict[str, str] | None = None,
    count: str | None = None,
    lows: dict[str, str] | None = None,
    highs: dict[str, str] | None = None,
    split: Split | None = None,
    **options,
) -> DataFrame:
    """Window aggregates in one call: ``window`` is a function of ``operators.windows``.

    Ranges are planned once, on the key and order columns of the input, and used
    for the window as well as for the aggregates over its changes.
    """
    group = tuple(keys if group is None else group)
    base = arrivals(df, ts, seq)
    split = split or plan_split(base, keys, ARRIVAL_ORDER, rows_per_range=CHANGED_ROWS_PER_RANGE)
    if "split" in inspect.signature(window).parameters:
        options |= {"keys": keys, "split": split}
    changes = window(df, *args, ts=ts, seq=seq, **options)
    ranges = split
    if group != tuple(keys):
        ranges = plan_split(base, group, ARRIVAL_ORDER, rows_per_range=CHANGED_ROWS_PER_RANGE)
    return over_changes(
        changes, group, sums=sums, averages=averages, count=count, lows=lows, highs=highs, split=ranges.on(*CHANGE_ORDER)
    )


def sliding_extreme(
    df: DataFrame,
    kind: str,
    value: str,
    out: str,
    *,
    axis: str,
    span: int,
    keys: Sequence[str] = (),
    tie: str,
    closed: bool = False,
) -> DataFrame:
    """``min`` or ``max`` over the live rows of a first-in-first-out window.

    ``axis`` is a number that grows with arrival (time in microseconds, or the
    row position); a row is live while ``now - axis < span`` (``<=`` if
    ``closed``). The axis is cut into cells of one span, so a window is a suffix
    of the previous cell plus a prefix of its own: two running extremes, with a
    cost per row that does not depend on the window size.
    """
    cell = F.floor(F.col(axis) / F.lit(span)).cast("bigint")
    cols = df.columns
    based = df.withColumn("_cell", cell)
    prefix = running(based, (*keys, "_cell"), (axis, tie), {"_pre": Run(kind, F.col(value))})
    probe_side = 2 if not closed else 0
    both = F.array(
        F.struct(F.col("_cell").alias("_c"), F.col(axis).alias("_x"), F.lit(1).alias("_o"),
                 F.col(value).alias("_v"), F.lit(False).alias("_probe")),
        F.struct((F.col("_cell") - 1).alias("_c"), (F.col(axis) - span).alias("_x"), F.lit(probe_side).alias("_o"),
                 F.lit(None).cast(df.schema[value].dataType).alias("_v"), F.lit(True).alias("_probe")),
    )

    def probed(rows: DataFrame, *extra: str) -> DataFrame:
        return rows.select(*cols, *extra, F.explode(both).alias("_m")).select(*cols, *extra, "_m.*")

    order = ("_x", "_o", tie)
    split = plan_split(probed(based), (*keys, "_c"), order)
    suffix = running(
        probed(prefix, "_pre"), (*keys, "_c"), order, {"_suf": Run(kind, F.col("_v"))}, reverse=True, split=split
    ).filter("_probe")
    pick = F.least if kind == "min" else F.greatest
    return suffix.select(*cols, pick("_pre", "_suf").alias(out))


def running_stream(
    df: DataFrame,
    runs: dict[str, Run],
    *,
    group: Sequence[str] = (),
    ts="ts",
    seq="seq",
    split: Split | None = None,
) -> DataFrame:
    """No window: aggregates over everything so far, one output row per event."""
    return running(arrivals(df, ts, seq), group, ARRIVAL_ORDER, runs, split=split).drop("_t", "_s")


def batch_rows(
    batches: DataFrame, aggs: dict[str, Column], plain: Sequence[str], group: Sequence[str] = (),
    keys: Sequence[str] = (),
) -> DataFrame:
    """One row per batch (per group in it): aggregates plus the last event's plain columns."""
    place = F.struct("_t", "_s")
    by = list(dict.fromkeys([*keys, "_batch", *group]))
    last = [F.max_by(c, place).alias(c) for c in plain if c not in by]
    return batches.groupBy(*by).agg(*last, *[a.alias(n) for n, a in aggs.items()])


def with_positions(df, *, keys=(), ts="ts", seq="seq", name="_rn", split=None) -> DataFrame:
    """Arrival position per key as a column, for position-based windows."""
    return positions(arrivals(df, ts, seq), keys, ARRIVAL_ORDER, name, split=split)
