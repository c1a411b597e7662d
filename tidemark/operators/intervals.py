"""Aggregates over the live rows of any window, without taking values away again.

Sums can subtract a row that leaves; extremes and user aggregates cannot. Here the changes of a group are numbered, so a
row is live over an interval of numbers, from its current change up to its expired one. The interval is cut into
dyadic pieces (level, index), two a level at most; the values of each piece are combined once, whatever the rows; and after
a change everything live lies in the pieces on the way up from its number, one a level. Cost per row grows with the
logarithm of how long rows stay, and pieces of one group spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.windows import CHANGE_ORDER
from tidemark.ordering import Run, Split, running

STATE = T.ArrayType(T.DoubleType())


class Mergeable:
    """A user aggregate. States are rows of ``width`` numbers; merging is associative and commutative.

    ``lift`` makes states of values, ``merge`` combines two blocks of states row by row and ``finish`` gives the
    results. Null values are left out; of nothing the result is null.
    """

    width = 1

    def lift(self, values: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def finish(self, states: np.ndarray) -> np.ndarray:
        return states[:, 0]


def _same(keys: Sequence[str], other: str = "__k") -> Column:
    out = F.lit(True)
    for i, k in enumerate(keys):
        out = out & F.col(k).eqNullSafe(F.col(f"{other}{i}"))
    return out


def _renamed(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]


def numbered(changes: DataFrame, group: Sequence[str] = (), *, split: Split | None = None) -> DataFrame:
    """Changes with their number ``_pos`` in the group, from 1."""
    return running(changes, tuple(group), CHANGE_ORDER, {"_pos": Run("count")}, split=split)


def _levels(rows: DataFrame, group: Sequence[str]) -> Column:
    """0, 1, ... up to the level of which one piece holds all numbers of the largest group."""
    most = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(1)).alias("n")).scalar()
    return F.sequence(F.lit(0), F.ceil(F.log2(most + F.lit(2))).cast("int"))


def _shift(name: str, value: Column, by: Column) -> Column:
    return F.call_function(name, value, by)


def pieces(rows: DataFrame, group: Sequence[str], values: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Numbered changes as pieces (group, ``_l``, ``_i``, values) of live intervals, and as probes (group, ``_pos``, ``_l``, ``_i``).

    The sequence number names a row inside its group.
    """
    levels = _levels(rows, group)
    current = F.col("_sign") > 0
    live = rows.groupBy(*group, "_seq").agg(
        F.min(F.when(current, F.col("_pos"))).alias("_a"),
        F.min(F.when(~current, F.col("_pos"))).alias("_b"),
        *[F.first(v).alias(n) for n, v in values.items()],
    ).filter(F.col("_a").isNotNull()).withColumn("_levels", levels)
    levels = F.col("_levels")
    one = F.lit(1).cast("bigint")
    widest = _shift("shiftleft", one, F.element_at(levels, -1))
    end = F.coalesce("_b", widest)

    def at(level: Column) -> Column:
        first = _shift("shiftright", F.col("_a") + _shift("shiftleft", one, level) - 1, level)
        last = _shift("shiftright", end, level)
        inside = first < last
        return F.array(
            F.struct(level.alias("l"), F.when(inside & (first % 2 == 1), first).alias("i")),
            F.struct(level.alias("l"), F.when(inside & (last % 2 == 1), last - 1).alias("i")),
        )

    cut = F.filter(F.flatten(F.transform(levels, at)), lambda p: p["i"].isNotNull())
    held = live.select(*group, *values, F.explode(cut).alias("_p")).select(*group, *values, F.col("_p.l").alias("_l"), F.col("_p.i").alias("_i"))
    probes = rows.withColumn("_levels", _levels(rows, group)).select(*group, "_pos", F.explode("_levels").alias("_l")).withColumn("_i", _shift("shiftright", F.col("_pos"), F.col("_l")))
    return held, probes


# Pieces and probes are many more than the rows of the file from which Spark guesses their size, so the joins below are never
# left to become broadcasts through the driver.


def _met(probes: DataFrame, nodes: DataFrame, group: Sequence[str], values: Sequence[str]) -> DataFrame:
    right = nodes.select(*_renamed(group), F.col("_l").alias("__l"), F.col("_i").alias("__i"), *values).hint("merge")
    same = _same(group) & (F.col("_l") == F.col("__l")) & (F.col("_i") == F.col("__i"))
    return probes.join(right, same).select(*group, "_pos", *values)


def _back(rows: DataFrame, found: DataFrame, group: Sequence[str], values: Sequence[str]) -> DataFrame:
    right = found.select(*_renamed(group), F.col("_pos").alias("__pos"), *values).hint("merge")
    return rows.join(right, _same(group) & (F.col("_pos") == F.col("__pos")), "left").select(*rows.columns, *values)


def extremes(
    rows: DataFrame, group: Sequence[str] = (), *, lows: dict[str, str] | None = None, highs: dict[str, str] | None = None
) -> DataFrame:
    """Numbered changes with the smallest and largest values that are live after each; null over nothing."""
    lows, highs, group = lows or {}, highs or {}, tuple(group)
    folds = {**dict.fromkeys(lows, F.min), **dict.fromkeys(highs, F.max)}
    values = {o: F.col(c) for o, c in {**lows, **highs}.items()}
    held, probes = pieces(rows, group, {f"_v_{o}": v for o, v in values.items()})
    nodes = held.groupBy(*group, "_l", "_i").agg(*[fold(f"_v_{o}").alias(f"_v_{o}") for o, fold in folds.items()])
    met = _met(probes, nodes, group, [f"_v_{o}" for o in folds])
    found = met.groupBy(*group, "_pos").agg(*[fold(f"_v_{o}").alias(o) for o, fold in folds.items()])
    return _back(rows, found, group, list(folds))


# --- user aggregates --------------------------------------------------------------------------


def merge_segments(states: np.ndarray, first: np.ndarray, merge) -> np.ndarray:
    """One state per run of rows; ``first`` marks where a run begins."""
    run = np.cumsum(first) - 1
    while len(states) > run[-1] + 1:
        place = np.arange(len(run)) - np.flatnonzero(np.diff(run, prepend=-1))[run]
        odd = np.flatnonzero(place % 2 == 1)
        states[odd - 1] = merge(states[odd - 1], states[odd])
        keep = place % 2 == 0
        states, run = states[keep], run[keep]
    return states


def _block(batch: pa.RecordBatch, width: int) -> np.ndarray:
    flat = batch.column(batch.num_columns - 1).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, width).copy()


def _firsts(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    """Where the leading key columns change, nulls being equal."""
    first = np.zeros(batch.num_rows, bool)
    first[:1] = True
    for column in batch.columns[:keys]:
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        first[1:] |= codes[1:] != codes[:-1]
    return first


def _merged(by: Sequence[str], width: int, merge):
    """Sorted Arrow batches (keys, state) to one row per key; what is held is one batch and one state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if kept is not None:
                batch = pa.Table.from_batches([kept, batch.cast(kept.schema)]).combine_chunks().to_batches()[0]
            first = _firsts(batch, len(by))
            states = merge_segments(_block(batch, width), first, merge)
            places = np.flatnonzero(first)
            offsets = pa.array(np.arange(len(places) + 1, dtype=np.int32) * width)
            lists = pa.ListArray.from_arrays(offsets, pa.array(states.ravel()))
            keys = [c.take(pa.array(places)) for c in batch.columns[: len(by)]]
            out = pa.RecordBatch.from_arrays([*keys, lists], names=[*by, "_state"])
            kept = out.slice(len(places) - 1)
            yield out.slice(0, len(places) - 1)
        if kept is not None:
            yield kept

    return run


def combined(rows: DataFrame, by: Sequence[str], aggregate: Mergeable) -> DataFrame:
    """(by, ``_state``) rows merged to one per ``by``: inside every task first, then across them."""
    by = list(by)
    schema = T.StructType([*[rows.schema[k] for k in by], T.StructField("_state", STATE)])
    step = _merged(by, aggregate.width, aggregate.merge)
    part = rows.select(*by, "_state")
    if not by:
        return part.mapInArrow(step, schema).repartition(1).mapInArrow(step, schema)
    here = part.sortWithinPartitions(*by).mapInArrow(step, schema)
    return here.repartition(*by).sortWithinPartitions(*by).mapInArrow(step, schema)


def _lifted(rows: DataFrame, keep: Sequence[str], column: str, aggregate: Mergeable) -> DataFrame:
    @F.pandas_udf(STATE)
    def lift(values: pd.Series) -> pd.Series:
        return pd.Series(list(aggregate.lift(values.to_numpy(float))), index=values.index, dtype=object)

    return rows.filter(F.col(column).isNotNull()).select(*keep, lift(F.col(column).cast("double")).alias("_state"))


def _finished(rows: DataFrame, keep: Sequence[str], out: str, aggregate: Mergeable) -> DataFrame:
    @F.pandas_udf("double")
    def finish(states: pd.Series) -> pd.Series:
        return pd.Series(aggregate.finish(np.stack(states.to_numpy())) if len(states) else [], dtype=float)

    return rows.select(*keep, finish("_state").alias(out))


def user_aggregate(df: DataFrame, group: Sequence[str], column: str, out: str, aggregate: Mergeable) -> DataFrame:
    """A user aggregate per group; groups without a value are left out."""
    states = combined(_lifted(df, list(group), column, aggregate), group, aggregate)
    return _finished(states, list(group), out, aggregate)


def user_over_changes(
    changes: DataFrame, group: Sequence[str], column: str, out: str, aggregate: Mergeable, *, split: Split | None = None
) -> DataFrame:
    """A user aggregate over what is live after each change."""
    group = tuple(group)
    rows = numbered(changes, group, split=split)
    held, probes = pieces(rows, group, {"_v": F.col(column)})
    nodes = combined(_lifted(held, [*group, "_l", "_i"], "_v", aggregate), [*group, "_l", "_i"], aggregate)
    met = _met(probes, nodes, group, ["_state"])
    found = _finished(combined(met, [*group, "_pos"], aggregate), [*group, "_pos"], out, aggregate)
    return _back(rows, found, group, [out]).drop("_pos")
