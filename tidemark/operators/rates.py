"""Output rate limits: every n events, every t, and snapshots at a tick."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.windows import ARRIVAL_ORDER, arrivals
from tidemark.ordering import Split, micros, neighbour, plan_split, positions


def _slots(df, n: int, keys, ts, seq, split) -> DataFrame:
    numbered = positions(arrivals(df, ts, seq), keys, ARRIVAL_ORDER, "_rn", split=split)
    return numbered.withColumn("_slot", F.floor((F.col("_rn") - 1) / n).cast("bigint"))


def every_events(
    df: DataFrame, n: int, what: str = "all", *, keys: Sequence[str] = (), ts="ts", seq="seq", split: Split | None = None
) -> DataFrame:
    """``output [all|first|last] every n events``. ``first`` comes at once; ``last`` and
    ``all`` wait for a full slot, so an incomplete tail is not emitted."""
    slots = _slots(df, n, keys, ts, seq, split)
    place = F.pmod(F.col("_rn") - 1, F.lit(n))
    if what == "first":
        return slots.filter(place == 0).select(*df.columns, "_slot")
    if what == "last":
        return slots.filter(place == n - 1).select(*df.columns, "_slot")
    if keys:
        total = slots.groupBy(*[F.col(k).alias(f"_tk{i}") for i, k in enumerate(keys)]).agg(F.max("_rn").alias("_total"))
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_tk{i}"))
        whole = slots.join(total, same).filter((F.col("_slot") + 1) * n <= F.col("_total"))
    else:
        total = df.agg(F.count(F.lit(1))).scalar()
        whole = slots.filter((F.col("_slot") + 1) * n <= total)
    return whole.select(*df.columns, "_slot")


def every_events_grouped(
    df: DataFrame, n: int, what: str, group: Sequence[str], *, ts="ts", seq="seq", split=None
) -> DataFrame:
    """First (last) event of each group inside each slot of ``n`` events."""
    slots = _slots(df, n, (), ts, seq, split)
    if what == "last":
        total = df.agg(F.count(F.lit(1))).scalar()
        slots = slots.filter((F.col("_slot") + 1) * n <= total)
    return _pick(slots, df.columns, ["_slot", *group], what)


def _pick(rows: DataFrame, columns: Sequence[str], by: Sequence[str], what: str) -> DataFrame:
    """One row per ``by``: partial extremes are combined before the shuffle."""
    rest = [c for c in columns if c not in by]
    choose = F.min_by if what == "first" else F.max_by
    best = choose(F.struct(*rest), F.struct(*ARRIVAL_ORDER)).alias("_r")
    extra = [c for c in by if c not in columns]
    return rows.groupBy(*by).agg(best).select(*by, "_r.*").select(*columns, *extra)


def _ticks(df, millis: int, ts, seq) -> DataFrame:
    """Index of the tick (grid of ``millis``) that ends the row's period."""
    a = arrivals(df, ts, seq)
    return a.withColumn("_tick", F.floor(F.col("_t") / F.lit(millis * 1000)).cast("bigint") + 1)


def every_time(df: DataFrame, millis: int, what: str = "all", *, ts="ts", seq="seq") -> DataFrame:
    """``output [all|first|last] every t``: ``_tick`` times ``t`` is the emission time."""
    ticks = _ticks(df, millis, ts, seq)
    if what == "all":
        return ticks.select(*df.columns, "_tick")
    return _pick(ticks, df.columns, ["_tick"], what)


def every_time_grouped(
    df: DataFrame, millis: int, what: str, group: Sequence[str], *, ts="ts", seq="seq"
) -> DataFrame:
    """First (last) event of each group inside each period."""
    return _pick(_ticks(df, millis, ts, seq), df.columns, ["_tick", *group], what)


# --- snapshots --------------------------------------------------------------------------------


def _first_tick(at: Column, width: int) -> Column:
    """First tick at or after a time."""
    return F.ceil(at / F.lit(width)).cast("bigint")


def last_event(df: DataFrame, millis: int, *, group: Sequence[str] = (), ts="ts", seq="seq") -> DataFrame:
    """``output snapshot every t`` without a window: the last event (per group) at each tick.

    Rows are first reduced to one per period (and group), then each is repeated
    until the period of its successor; the last one is repeated to the end.
    """
    width = millis * 1000
    a = arrivals(df, ts, seq).withColumn("_tick", _first_tick(F.col("_t"), width))
    picked = _pick(a, df.columns, ["_tick", *group], "last")
    end = a.agg(F.max("_tick")).scalar()
    nxt = neighbour(picked, tuple(group), ("_tick",), 1, {"_until": F.col("_tick")})
    until = F.coalesce(F.col("_until") - 1, end)
    return nxt.withColumn("_tick", F.explode(F.sequence(F.col("_tick"), until))).select(*df.columns, "_tick")


def live_time(df: DataFrame, window_ms: int, *, ts="ts", seq="seq") -> DataFrame:
    """Live interval ``[_from, _to)`` of each row of a time window."""
    a = arrivals(df, ts, seq)
    return a.withColumns({"_from": F.col("_t"), "_to": F.col("_t") + window_ms * 1000})


def live_length(df: DataFrame, n: int, *, keys=(), ts="ts", seq="seq", split=None) -> DataFrame:
    """Live interval of each row of a length window; rows never evicted have no end."""
    a = arrivals(df, ts, seq)
    split = split or plan_split(a, keys, ARRIVAL_ORDER)
    return neighbour(a, keys, ARRIVAL_ORDER, n, {"_to": F.col("_t")}, split=split).withColumn("_from", F.col("_t"))


def _live_ticks(live: DataFrame, millis: int, ts_end: Column) -> DataFrame:
    """First and last tick at which each row is live; rows between ticks drop out."""
    width = millis * 1000
    first = _first_tick(F.col("_from"), width)
    last = F.coalesce(_first_tick(F.col("_to"), width) - 1, ts_end)
    return live.withColumns({"_first": first, "_last": F.least(last, ts_end)}).filter(F.col("_first") <= F.col("_last"))


def _end(source: DataFrame, millis: int, ts: str) -> Column:
    """Tick after the last arrival of the source stream."""
    return source.agg(_first_tick(F.max(micros(source, ts)), millis * 1000)).scalar()


def window_content(
    live: DataFrame, millis: int, columns: Sequence[str], *, source: DataFrame | None = None, ts="ts"
) -> DataFrame:
    """Live rows at each tick up to the tick after the last arrival. ``source`` is the stream
    the live intervals were made from, if finding its end there is cheaper."""
    end = _end(live if source is None else source, millis, ts)
    ticks = _live_ticks(live, millis, end)
    return ticks.withColumn("_tick", F.explode(F.sequence("_first", "_last"))).select(*columns, "_tick")


def window_aggregates(
    live: DataFrame,
    millis: int,
    *,
    sums: dict[str, str] | None = None,
    low: dict[str, str] | None = None,
    high: dict[str, str] | None = None,
    count: str | None = None,
    group: Sequence[str] = (),
    source: DataFrame | None = None,
    ts="ts",
) -> DataFrame:
    """Aggregates over the live rows at each tick (per group).

    Rows with the same first and last tick are combined before they are repeated
    per tick, so the repeated data does not grow with the event rate.
    """
    end = _end(live if source is None else source, millis, ts)
    ticks = _live_ticks(live, millis, end)
    part = [F.count(F.lit(1)).alias("_n")]
    merge = []
    for names, fn in ((sums or {}, F.sum), (low or {}, F.min), (high or {}, F.max)):
        for out, col in names.items():
            part.append(fn(col).alias(out))
            merge.append(fn(out).alias(out))
    if count:
        merge.append(F.sum("_n").alias(count))
    spans = ticks.groupBy(*group, "_first", "_last").agg(*part)
    each = spans.withColumn("_tick", F.explode(F.sequence("_first", "_last")))
    return each.groupBy("_tick", *group).agg(*merge)


def window_rows_with_aggregates(
    live: DataFrame, millis: int, columns: Sequence[str], group: Sequence[str] = (), **aggregates
) -> DataFrame:
    """Live rows at each tick, each with the aggregates of its tick (and group)."""
    rows = window_content(live, millis, columns, source=aggregates.get("source"))
    totals = window_aggregates(live, millis, group=group, **aggregates)
    return rows.join(totals, ["_tick", *group])

