"""Keyed state for streams: the step functions of the batch operators, fed micro-batch by micro-batch."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def keyed_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    make,
    schema: T.StructType,
    *,
    ttl_ms: int | None,
    millis: str | None = None,
    flush=None,
    ordered: bool = False,
) -> DataFrame:
    """Streaming twin of ``ordered_scan``. The rows of a key in one micro-batch are
    put in order before they are read.

    State is dropped when the watermark passes the key's last row by ``ttl_ms``
    (``millis`` names its time in milliseconds); ``df`` needs a watermark then.
    ``flush(memory)`` may give rows to emit when that happens.

    ``ordered`` reads rows in the order of their event time whatever micro-batch brings them: a row waits in the state
    of its key until the watermark has passed it, when no earlier one can come any more, and an event-time timer wakes
    the key. What is held is the rows of the delay. Rows later than the watermark are dropped by Spark.
    """
    if ordered:
        return _released(df, keys, order, make, schema, ttl_ms, millis, flush)
    keys, order, names = list(keys), list(order), list(df.columns)
    timeout = GroupStateTimeout.EventTimeTimeout if ttl_ms is not None else GroupStateTimeout.NoTimeout

    def run(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterable[pd.DataFrame]:
        memory = pickle.loads(state.get[0]) if state.exists else {}
        if state.hasTimedOut:
            out = flush(memory) if flush else []
            state.remove()
        else:
            rows = pd.concat(list(batches), ignore_index=True).sort_values(order, kind="stable")
            rows = rows.astype(object).where(rows.notna(), None)
            step = make(names, memory)
            out = [r for row in rows.itertuples(index=False, name=None) for r in step(row)]
            state.update((pickle.dumps(memory),))
            if ttl_ms is not None:
                last = int(max(rows[millis])) + ttl_ms
                state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame.from_records(out, columns=schema.names)

    return df.groupBy(*keys).applyInPandasWithState(run, schema, "memory binary", "append", timeout)


def _released(df, keys, order, make, schema, ttl_ms, millis, flush) -> DataFrame:
    keys, names = list(keys), list(df.columns)
    places, ms_at = [names.index(c) for c in order], names.index(millis)

    def run(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterable[pd.DataFrame]:
        memory, held, last = pickle.loads(state.get[0]) if state.exists else ({}, [], None)
        if not state.hasTimedOut:
            for rows in batches:
                rows = rows.astype(object).where(rows.notna(), None)
                held.extend(rows.itertuples(index=False, name=None))
        mark = state.getCurrentWatermarkMs()
        ready = sorted((r for r in held if r[ms_at] < mark), key=lambda r: [r[p] for p in places])
        held = [r for r in held if r[ms_at] >= mark]
        out = []
        if ready:
            step = make(names, memory)
            out = [r for row in ready for r in step(row)]
            last = int(ready[-1][ms_at])
        if not held and ttl_ms is not None and last is not None and last + ttl_ms <= mark:
            out += flush(memory) if flush else []
            state.remove()
        else:
            state.update((pickle.dumps((memory, held, last)),))
            wake = min(int(r[ms_at]) for r in held) + 1 if held else None if ttl_ms is None else last + ttl_ms
            if wake is not None:
                state.setTimeoutTimestamp(max(wake, mark + 1))
        if out:
            yield pd.DataFrame.from_records(out, columns=schema.names)

    return df.groupBy(*keys).applyInPandasWithState(run, schema, "memory binary", "append", GroupStateTimeout.EventTimeTimeout)


def timed(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Declare how late rows may be, and add their time in milliseconds."""
    stamped = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return stamped.withColumn("_ms", F.unix_millis(ts))
