"""Ordered computation per key (or over a whole stream) without one task per key.

Spark runs ``Window.partitionBy(key).orderBy(t)`` with all rows of a key in one
task, and an unkeyed window in a single task. Both fail when one key, or the
stream itself, is most of the data. The functions here cut such a *hot* group
into consecutive ranges of its own order and combine the ranges exactly:

1. ``plan_split`` finds the hot groups and their range boundaries. It looks at
   the key and order columns only, and brings back a bounded sample.
2. rows are shuffled by ``(key, range)``; groups that are not hot have range 0,
   so for them the plan is the ordinary window plan.
3. the total of each range of a hot group is prefix-combined and broadcast back as
   the carry-in of the range. There are about ``MAX_RANGES`` ranges at most, or two
   for each hot group where that is more.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_RANGE = 2_000_000
MAX_RANGES = 16_384
SAMPLES_PER_RANGE = 24
COMPARED_CUTS = 32
RANGE = "_range"
_HOT = "_hot"


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since the epoch of a timestamp column, or the number itself.

    Zone-less timestamps are read as UTC: run with ``spark.sql.session.timeZone=UTC``.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    return F.col(name).cast("bigint")


@dataclass(frozen=True)
class Split:
    """How the groups of a stream are cut into ranges; ``cuts`` is bounded."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: tuple[tuple, ...] | None = None
    hot: DataFrame | None = None
    widest: int = 0
    cut_type: T.DataType | None = None

    @property
    def active(self) -> bool:
        return self.cuts is not None or self.hot is not None

    def on(self, *order: str) -> "Split":
        """The same ranges for rows that carry the order under other names, with more
        columns behind it (a change stream of the planned stream, for one)."""
        return replace(self, order=order)

    def assign(self, df: DataFrame) -> DataFrame:
        """Add ``_range`` (0 for groups that are not hot) and ``_hot``."""
        if not self.active:
            return df.withColumn(RANGE, F.lit(0)).withColumn(_HOT, F.lit(False))
        width = len(self.cut_type.fields)
        place = [F.col(c) for c in self.order[:width]]
        here = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(place)])
        if self.cuts is not None:
            return df.withColumn(RANGE, self._literal(place, here)).withColumn(_HOT, F.lit(True))
        hot = F.broadcast(self.hot)
        same = [F.col(k).eqNullSafe(F.col(f"_hk{i}")) for i, k in enumerate(self.keys)]
        joined = df.join(hot, _all(same), "left")
        return (
            joined.withColumn(_HOT, F.col("_cuts").isNotNull())
            .withColumn(RANGE, F.coalesce(self._search(F.col("_cuts"), here), F.lit(0)))
            .select(*df.columns, RANGE, _HOT)
        )

    def _literal(self, place: list[Column], here: Column) -> Column:
        """Range of a stream without a key: few cuts are compared one by one in generated
        code, many are searched in one constant array."""
        if len(self.cuts) > COMPARED_CUTS:
            text = json.dumps([{f"o{i}": v for i, v in enumerate(c)} for c in self.cuts])
            return self._search(F.from_json(F.lit(text), T.ArrayType(self.cut_type)), here)
        out = F.lit(0)
        for cut in self.cuts:
            reached = F.lit(True)
            for column, value in reversed(list(zip(place, cut))):
                reached = (column > F.lit(value)) | ((column == F.lit(value)) & reached)
            out = out + reached.cast("int")
        return out

    def _search(self, cuts: Column, here: Column) -> Column:
        """Number of cuts at or before ``here``, by binary descent."""
        steps = [1 << b for b in range(max(self.widest, 1).bit_length() - 1, -1, -1)]
        return F.aggregate(
            F.array(*[F.lit(s) for s in steps]),
            F.lit(0),
            lambda pos, step: F.when(F.get(cuts, pos + step - 1) <= here, pos + step).otherwise(pos),
        )


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _cuts(sample: list[tuple], ranges: int) -> list[list]:
    ordered = sorted(sample)
    picks = [ordered[len(ordered) * i // ranges] for i in range(1, ranges)] if ordered else []
    return [list(p) for p in sorted(set(picks))]


def plan_split(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    rows_per_range: int = ROWS_PER_RANGE,
) -> Split:
    """Find hot groups and their range boundaries.

    A keyed stream costs one aggregation over the key columns; the sample is
    drawn only when some key exceeds ``rows_per_range``. An unkeyed stream is
    always cut, into at least as many ranges as the session has cores. The
    sample decides only where ranges begin; results do not depend on it.
    """
    keys, order = tuple(keys), tuple(order)
    cut_type = T.StructType(
        [T.StructField(f"o{i}", df.schema[c].dataType) for i, c in enumerate(order)]
    )
    spark = df.sparkSession
    if not keys:
        total = df.count()
        floor = min(spark.sparkContext.defaultParallelism, max(total, 1))
        ranges = min(max(math.ceil(total / rows_per_range), floor, 2), MAX_RANGES)
        fraction = min(1.0, ranges * SAMPLES_PER_RANGE / max(total, 1))
        sample = [tuple(r) for r in df.select(*order).sample(fraction=fraction, seed=7).collect()]
        cuts = _cuts(sample, ranges)
        return Split(keys, order, cuts=tuple(map(tuple, cuts)), widest=len(cuts), cut_type=cut_type)

    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # At most one key per ``rows_per_range`` rows of the stream; every one of them is cut.
    heavy = sizes.filter(F.col("_n") > rows_per_range).collect()
    if not heavy:
        return Split(keys, order)
    step = max(rows_per_range, sum(r["_n"] for r in heavy) * 2 // MAX_RANGES)
    plan = [(*[r[k] for k in keys], r["_n"], max(2, math.ceil(r["_n"] / step))) for r in heavy]
    key_fields = [T.StructField(f"_hk{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    heads = spark.createDataFrame(
        [(*p[:-2], float(p[-1] * SAMPLES_PER_RANGE) / p[-2]) for p in plan],
        T.StructType([*key_fields, T.StructField("_f", T.DoubleType())]),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_hk{i}")) for i, k in enumerate(keys)]
    drawn = (
        df.select(*dict.fromkeys((*keys, *order)))
        .join(F.broadcast(heads), _all(same))
        .filter(F.rand(7) < F.col("_f"))
        .select(*[f"_hk{i}" for i in range(len(keys))], *order)
        .collect()
    )
    samples: dict[tuple, list[tuple]] = {}
    for r in drawn:
        samples.setdefault(tuple(r[: len(keys)]), []).append(tuple(r[len(keys) :]))
    rows = [(*p[:-2], _cuts(samples.get(tuple(p[:-2]), []), p[-1])) for p in plan]
    hot = spark.createDataFrame(
        rows, T.StructType([*key_fields, T.StructField("_cuts", T.ArrayType(cut_type))])
    )
    return Split(keys, order, hot=hot, widest=max(len(r[-1]) for r in rows), cut_type=cut_type)


@dataclass(frozen=True)
class Run:
    """One running aggregate: ``kind`` is sum, count, min, max or last (skips nulls)."""

    kind: str
    value: Column | None = None


def _in_range(run: Run, column: Column, window) -> Column:
    if run.kind == "sum":
        return F.coalesce(F.sum(column).over(window), F.lit(0))
    if run.kind == "count":
        return F.count(column).over(window)
    if run.kind == "last":
        return F.last(column, ignorenulls=True).over(window)
    return getattr(F, run.kind)(column).over(window)


def _range_total(run: Run, column: Column, order: Sequence[str], reverse: bool) -> Column:
    if run.kind == "last":
        place = F.when(column.isNotNull(), F.struct(*order))
        return (F.min_by if reverse else F.max_by)(column, place)
    return getattr(F, run.kind)(column)


def _combine(run: Run, carry: Column, here: Column) -> Column:
    if run.kind in ("sum", "count"):
        return F.coalesce(carry, F.lit(0)) + here
    if run.kind == "min":
        return F.least(carry, here)
    if run.kind == "max":
        return F.greatest(carry, here)
    return F.coalesce(here, carry)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    runs: dict[str, Run],
    *,
    reverse: bool = False,
    inclusive: bool = True,
    split: Split | None = None,
) -> DataFrame:
    """Running aggregates in order per key (``reverse``: from the end backwards)."""
    keys, order = tuple(keys), tuple(order)
    split = split or plan_split(df, keys, order)
    inputs = {n: f"_in_{n}" for n in runs}
    ranged = split.assign(
        df.withColumns(
            {inputs[n]: r.value if r.value is not None else F.lit(1) for n, r in runs.items()}
        )
    )
    direction = [F.col(c).desc() if reverse else F.col(c).asc() for c in order]
    window = (
        Window.partitionBy(*keys, RANGE)
        .orderBy(*direction)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    )
    here = ranged.select(
        *ranged.columns, *[_in_range(r, F.col(inputs[n]), window).alias(f"_w_{n}") for n, r in runs.items()]
    )
    if not split.active:
        return here.select(*df.columns, *[F.col(f"_w_{n}").alias(n) for n in runs])
    totals = (
        ranged.filter(_HOT)
        .groupBy(*keys, RANGE)
        .agg(*[_range_total(r, F.col(inputs[n]), order, reverse).alias(n) for n, r in runs.items()])
    )
    before = (
        Window.partitionBy(*(keys or (F.lit(0),)))
        .orderBy(F.col(RANGE).desc() if reverse else F.col(RANGE).asc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    fold = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    carry = totals.select(
        *[F.col(k).alias(f"_ck{i}") for i, k in enumerate(keys)],
        F.col(RANGE).alias("_cr"),
        *[
            (
                F.last(n, ignorenulls=True) if r.kind == "last" else fold[r.kind](n)
            ).over(before).alias(f"_c_{n}")
            for n, r in runs.items()
        ],
    )
    same = [F.col(k).eqNullSafe(F.col(f"_ck{i}")) for i, k in enumerate(keys)]
    joined = here.join(F.broadcast(carry), _all([*same, F.col(RANGE) == F.col("_cr")]), "left")
    return joined.select(
        *df.columns,
        *[_combine(r, F.col(f"_c_{n}"), F.col(f"_w_{n}")).alias(n) for n, r in runs.items()],
    )


def positions(df, keys, order, name: str = "_rn", *, split: Split | None = None) -> DataFrame:
    """1-based arrival position per key."""
    return running(df, keys, order, {name: Run("count")}, split=split)


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    offset: int,
    values: dict[str, Column],
    *,
    split: Split | None = None,
    block_rows: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Values of the row ``offset`` places away per key (negative looks back)."""
    keys, order = tuple(keys), tuple(order)
    split = split or plan_split(df, keys, order)
    packed = F.struct(*[v.alias(n) for n, v in values.items()])
    if not split.active:
        window = Window.partitionBy(*keys).orderBy(*order)
        out = df.withColumn("_nb", F.lead(packed, offset).over(window))
    elif abs(offset) == 1:
        out = running(
            df, keys, order, {"_nb": Run("last", packed)},
            reverse=offset > 0, inclusive=False, split=split,
        )
    else:
        # Blocks of consecutive positions, each with the rows just outside that it looks at.
        reach = abs(offset)
        block = max(block_rows, reach)
        at = F.col("_rn") - 1
        own = F.floor(at / block).cast("bigint")
        inside = at % block
        borrowed = inside < reach if offset > 0 else inside >= block - reach
        other = own - 1 if offset > 0 else own + 1
        window = Window.partitionBy(*keys, "_block").orderBy("_rn")
        numbered = positions(df, keys, order, "_rn", split=split)
        copies = F.when(borrowed, F.array(own, other)).otherwise(F.array(own))
        out = (
            numbered.withColumn("_block", F.explode(copies))
            .withColumn("_nb", F.lead(packed, offset).over(window))
            .filter(F.col("_block") == own)
        )
    return out.select(*df.columns, *[F.col(f"_nb.{n}").alias(n) for n in values])
