"""Windows, joins, lookups, patterns and movement over streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import patterns as P
from tidemark.operators import records as R
from tidemark.operators.windows import arrivals
from tidemark.streaming.state import keyed_scan, timed

#: Rows that travel as text keep their microseconds.
MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def time_batches(
    df: DataFrame, millis: int, aggs: dict[str, Column], group: Sequence[str] = (), *, ts="ts", delay="1 hour"
) -> DataFrame:
    """Tumbling batches, each emitted once the watermark passes its end."""
    width = F.window(F.col(ts), f"{millis} milliseconds").alias("_w")
    grouped = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).groupBy(width, *group)
    out = grouped.agg(*[a.alias(n) for n, a in aggs.items()])
    batch = F.floor(F.unix_millis("_w.start") / millis).alias("_batch")
    return out.select(batch, *group, *aggs)


def first_unique(df: DataFrame, attrs: Sequence[str], *, ts="ts", delay: str | None = None) -> DataFrame:
    """First row of each attribute value. With ``delay`` values are forgotten after it."""
    if delay is None:
        return df.dropDuplicates(list(attrs))
    stamped = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return stamped.dropDuplicatesWithinWatermark(list(attrs))


def time_join(
    left: DataFrame,
    right: DataFrame,
    left_ms: int,
    right_ms: int,
    equal: Sequence[tuple[str, str]],
    *,
    ts="ts",
    delay="1 hour",
    how: str = "inner",
) -> DataFrame:
    """Window join of two streams; both sides' state is bounded by watermark and range."""
    l = left.select(*[F.col(c).alias(f"l_{c}") for c in left.columns])
    r = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    lt, rt = f"l_{ts}", f"r_{ts}"
    l = l.withColumn(lt, F.col(lt).cast("timestamp")).withWatermark(lt, delay)
    r = r.withColumn(rt, F.col(rt).cast("timestamp")).withWatermark(rt, delay)
    condition = F.expr(
        f"{rt} > {lt} - make_dt_interval(0, 0, 0, {right_ms / 1000}) "
        f"AND {rt} < {lt} + make_dt_interval(0, 0, 0, {left_ms / 1000})"
    )
    for a, b in equal:
        condition = condition & (F.col(f"l_{a}") == F.col(f"r_{b}"))
    return l.join(r, condition, how)


def lookup(
    df: DataFrame,
    state: DataFrame,
    key: str,
    state_key: str,
    fields: Sequence[str],
    *,
    ttl_ms: int = 3_600_000,
    ts="ts",
    seq="seq",
    delay="1 hour",
    ordered: bool = False,
) -> DataFrame:
    """Last-known-value lookup over streams: one keyed state per key with a time to live.

    Rows with a null key find nothing and take no state. ``ordered`` here and below: rows wait for the watermark and are
    read in event-time order across micro-batches, see ``keyed_scan``.
    """
    fields, cols = list(fields), list(df.columns)
    row_type = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    left = df.select(
        F.col(key).alias("_key"), F.col(ts).cast("timestamp").alias("_time"), F.col(seq).alias("_s"), F.lit(1).alias("_o"),
        F.to_json(F.struct(*cols), MICROS).alias("_row"), *[F.lit(None).cast(state.schema[f].dataType).alias(f"_k_{f}") for f in fields],
    )
    right = state.select(
        F.col(state_key).alias("_key"), F.col(ts).cast("timestamp").alias("_time"), F.col(seq).alias("_s"), F.lit(0).alias("_o"),
        F.lit(None).cast("string").alias("_row"), *[F.col(f).alias(f"_k_{f}") for f in fields],
    )
    merged = timed(left.filter(F.col("_key").isNotNull()).unionByName(right.filter(F.col("_key").isNotNull())), "_time", delay)
    schema = T.StructType(
        [T.StructField("_row", T.StringType()), *[T.StructField(f, state.schema[f].dataType) for f in fields]]
    )

    def make(columns: list[str], memory: dict):
        o_at, row_at, ms_at = (columns.index(c) for c in ("_o", "_row", "_ms"))
        at = [columns.index(f"_k_{f}") for f in fields]

        def step(row: tuple) -> list[tuple]:
            if row[o_at] == 0:
                memory["last"] = (row[ms_at], tuple(row[i] for i in at))
                return []
            then, known = memory.get("last", (None, ()))
            fresh = then is not None and then > row[ms_at] - ttl_ms
            return [(row[row_at], *(known if fresh else [None] * len(at)))]

        return step

    seen = keyed_scan(merged, ["_key"], ["_time", "_o", "_s"], make, schema, ttl_ms=ttl_ms, millis="_ms", ordered=ordered)
    found = seen.withColumn("_r", F.from_json("_row", row_type, MICROS)).select("_r.*", *fields)
    missing = [F.lit(None).cast(state.schema[f].dataType).alias(f) for f in fields]
    return found.unionByName(df.filter(F.col(key).isNull()).select(*cols, *missing))


def pattern(
    df: DataFrame,
    parts,
    fields: Sequence[str],
    *,
    keys: Sequence[str],
    within_ms: int | None,
    every: bool | tuple[int, int] = False,
    ts="ts",
    seq="seq",
    delay="1 hour",
    ordered: bool = False,
) -> DataFrame:
    """Pattern over a keyed stream. It needs a time bound, because without one the
    matches in progress would have to be kept forever."""
    if within_ms is None or not keys:
        raise ValueError("a streaming pattern needs a partition key and a time bound (within_ms)")
    again = (0, 0) if every is True else (every or None)
    shape = P._Shape(tuple(P._plain(p) for p in parts), within_ms * 1000, again, False)
    return _read(df, parts, fields, keys, shape, within_ms if again else None, ts, seq, delay, gaps=True, ordered=ordered)


def sequence(
    df: DataFrame, parts, fields: Sequence[str], *, keys: Sequence[str], within_ms: int, ts="ts", seq="seq", delay="1 hour",
    ordered: bool = False,
) -> DataFrame:
    """Strict sequence over a keyed stream, bounded in time."""
    if not keys:
        raise ValueError("a streaming sequence needs a partition key")
    shape = P._Shape(tuple(P._plain(p) for p in parts), within_ms * 1000, None, True)
    return _read(df, parts, fields, keys, shape, within_ms, ts, seq, delay, gaps=False, ordered=ordered)


def _read(df, parts, fields, keys, shape, ttl_ms, ts, seq, delay, *, gaps: bool, ordered: bool) -> DataFrame:
    rows = timed(P._flagged(df, parts, ts, seq), ts, delay)
    if gaps:
        rows = rows.filter(P._any_flag(parts))
    schema, make = P._step_function(rows.schema, parts, fields, keys, shape)
    slim = rows.select(*P._slim(rows, parts, fields, keys, keys).columns, *([ts] if ts not in fields else []), "_ms")
    return keyed_scan(slim, keys, ["_t", "_s"], make, schema, ttl_ms=ttl_ms, millis="_ms", ordered=ordered)


def window_changes(
    df: DataFrame, *, keys: Sequence[str], length: int | None = None, millis: int | None = None,
    ts="ts", seq="seq", delay="1 hour", ordered: bool = False,
) -> DataFrame:
    """Change stream of a keyed length or time window: rows with ``_kind`` and ``_at`` (microseconds).

    A row leaves a time window at ``ts + millis``: before the next arrival of its
    key, or when the watermark passes the last of them.
    """
    if (length is None) == (millis is None):
        raise ValueError("give either length or millis")
    cols = list(df.columns)
    rows = timed(arrivals(df, ts, seq), ts, delay).select(*cols, "_t", "_s", "_ms")
    schema = T.StructType(
        [*[T.StructField(f.name, f.dataType) for f in rows.select(*cols).schema.fields],
         T.StructField("_kind", T.StringType()), T.StructField("_at", T.LongType())]
    )
    width, span = len(cols), None if millis is None else millis * 1000

    def make(columns: list[str], memory: dict):
        t_at = columns.index("_t")

        def step(row: tuple) -> list[tuple]:
            live = memory.setdefault("live", [])
            now, out = row[t_at], []
            if span is None:
                if len(live) >= length:
                    out.append((*live.pop(0)[1], "expired", now))
            else:
                while live and live[0][0] + span <= now:
                    then, old = live.pop(0)
                    out.append((*old, "expired", then + span))
            live.append((now, row[:width]))
            out.append((*row[:width], "current", now))
            return out

        return step

    def flush(memory: dict) -> list[tuple]:
        return [(*old, "expired", then + span) for then, old in memory.get("live", [])]

    if span is None:
        return keyed_scan(rows, keys, ["_t", "_s"], make, schema, ttl_ms=None, millis="_ms", ordered=ordered)
    return keyed_scan(rows, keys, ["_t", "_s"], make, schema, ttl_ms=millis, millis="_ms", flush=flush, ordered=ordered)


def dwell(
    df: DataFrame, *, key="client_mac", ttl_s: int = 3600, seq="seq", delay="1 hour", ordered: bool = False
) -> DataFrame:
    """Streaming twin of the debounced movement: state is the last report of each client."""
    places = ("client_floor", "client_zone", "client_building", "client_campus")
    every = (*places, "wireless_station")
    named = df.withColumns({p: F.coalesce(p, F.lit(R.UNKNOWN)) for p in places}).withColumn(
        "_time", F.timestamp_seconds("timestamp")
    )
    rows = timed(named, "_time", delay)
    width = len(rows.columns)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType(
        [
            *[T.StructField(n, k) for n, k in kinds.items()],
            T.StructField("_old_t", T.LongType()),
            *[T.StructField(f"_old_{p}", kinds[p]) for p in every],
        ]
    )
    make = R.reporter(every, width, with_old=True)
    before = keyed_scan(
        rows, [key], ["timestamp", seq], make, schema, ttl_ms=ttl_s * 1000, millis="_ms", ordered=ordered
    )
    return R.dwell_rows(before, df.columns, ttl_s)
