"""Event tables: insert, update and delete as whole-table DataFrame rewrites.

A stored table is a Parquet folder with one ``version=N`` folder per rewrite;
readers take the highest complete version, so a lost job leaves the old one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.windows import ARRIVAL_ORDER, arrivals
from tidemark.ordering import Run, running

Pairs = Sequence[tuple[str, str]]


def define(spark: SparkSession, schema: str) -> DataFrame:
    """An empty table."""
    return spark.createDataFrame([], T.StructType.fromDDL(schema))


def insert(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows; they must have as many columns as the table, of the same types in order."""
    want = [f.dataType for f in table.schema.fields]
    have = [f.dataType for f in rows.schema.fields]
    if want != have:
        raise TypeError(f"cannot insert {rows.schema.simpleString()} into {table.schema.simpleString()}")
    return table.union(rows)


def update(
    table: DataFrame, events: DataFrame, on: Pairs, *, ts="ts", seq="seq"
) -> DataFrame:
    """``update t on t.a == event.b``: matching rows take the event's same-named columns.

    ``on`` pairs table columns with event columns; the last matching event wins.
    Without pairs the last event applies to every row. Nothing is inserted.
    """
    taken = [c for c in table.columns if c in events.columns and c not in [t for t, _ in on]]
    rows = arrivals(events, ts, seq)
    best = F.max_by(F.struct(F.lit(True).alias("_hit"), *taken), F.struct(*ARRIVAL_ORDER)).alias("_u")
    if not on:
        last = rows.agg(best).scalar()
        changed = table.withColumn("_u", last)
    else:
        newest = rows.groupBy(*[F.col(e).alias(f"_uk{i}") for i, (_, e) in enumerate(on)]).agg(best)
        same = reduce(lambda a, b: a & b, [F.col(t) == F.col(f"_uk{i}") for i, (t, _) in enumerate(on)])
        changed = table.join(newest, same, "left")
    hit = F.coalesce(F.col("_u._hit"), F.lit(False))
    return changed.select(
        *[F.when(hit, F.col(f"_u.{c}")).otherwise(F.col(c)).alias(c) if c in taken else F.col(c) for c in table.columns]
    )


def update_theta(
    table: DataFrame, events: DataFrame, on: Pairs, column: str, op: str, event_column: str, *, ts="ts", seq="seq"
) -> DataFrame:
    """``update t on t.k == event.k and t.a < event.b`` (or <=, >, >=): the last matching event wins.

    An event decides only for the values that no later event of its key reaches, so the
    events become intervals of ``column``, of which a row meets one at most. Without an
    equality the join would be a nested loop and is refused.
    """
    if not on:
        raise ValueError("an update with an inequality needs an equality as well")
    taken = [c for c in table.columns if c in events.columns and c not in (*[t for t, _ in on], column)]
    keys = [f"_uk{i}" for i in range(len(on))]
    rows = arrivals(events, ts, seq).filter(F.col(event_column).isNotNull())
    rows = rows.select(
        *[F.col(e).alias(k) for k, (_, e) in zip(keys, on)], F.col(event_column).alias("_ub"), *ARRIVAL_ORDER,
        F.struct(*taken).alias("_u"),
    )
    rising = op in ("<", "<=")
    later = running(rows, keys, ARRIVAL_ORDER, {"_ul": Run("max" if rising else "min", F.col("_ub"))}, reverse=True, inclusive=False)
    value, bound, past = F.col(column), F.col("_ub"), F.col("_ul")
    beyond = {"<": value >= past, "<=": value > past, ">": value <= past, ">=": value < past}[op]
    steps = later.filter(past.isNull() | ((bound > past) if rising else (bound < past)))
    same = reduce(lambda a, b: a & b, [F.col(t) == F.col(k) for k, (t, _) in zip(keys, on)])
    changed = table.join(steps, same & _holds(op, value, bound) & (past.isNull() | beyond), "left")
    hit = bound.isNotNull()
    return changed.select(
        *[F.when(hit, F.col(f"_u.{c}")).otherwise(F.col(c)).alias(c) if c in taken else F.col(c) for c in table.columns]
    )


def _holds(op: str, a, b):
    return {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[op]


def delete(table: DataFrame, events: DataFrame, on: Pairs) -> DataFrame:
    """``delete t on t.a == event.b``; without pairs any event empties the table."""
    if not on:
        return table.filter(events.agg(F.count(F.lit(1))).scalar() == 0)
    right = events.select(*[F.col(e).alias(f"_dk{i}") for i, (_, e) in enumerate(on)])
    same = reduce(lambda a, b: a & b, [F.col(t) == F.col(f"_dk{i}") for i, (t, _) in enumerate(on)])
    return table.join(right, same, "left_anti")


def delete_theta(
    table: DataFrame, events: DataFrame, column: str, op: str, event_column: str, on: Pairs = ()
) -> DataFrame:
    """``delete t on t.a < event.b`` and the like, with equalities ``on`` or without: the
    events' extreme value (per key) decides."""
    extreme = F.max if op in ("<", "<=") else F.min
    if not on:
        bound = events.agg(extreme(event_column)).scalar()
        return table.filter(~F.coalesce(_holds(op, F.col(column), bound), F.lit(False)))
    bounds = events.groupBy(*[F.col(e).alias(f"_dk{i}") for i, (_, e) in enumerate(on)]).agg(
        extreme(event_column).alias("_bound")
    )
    same = reduce(lambda a, b: a & b, [F.col(t) == F.col(f"_dk{i}") for i, (t, _) in enumerate(on)])
    return table.join(bounds, same & _holds(op, F.col(column), F.col("_bound")), "left_anti")


# --- tables that change while they are read ----------------------------------------------------


def change_log(
    inserts: DataFrame, key: Sequence[str], *, updates: DataFrame | None = None, deletes: DataFrame | None = None, ts="ts", seq="seq"
) -> DataFrame:
    """One ordered log of what happens to a table: inserted rows, updates and deletes by key.

    All three carry ``ts``, ``seq`` and the columns ``key``; an update also carries the columns that it sets. The log has
    the key columns, ``_t``, ``_s``, ``_what``, ``_row`` (of an insert) and ``_set`` (of an update).
    """
    rest = [c for c in inserts.columns if c not in (*key, ts, seq)]
    row_type = T.StructType([inserts.schema[c] for c in rest])
    set_type = None
    if updates is not None:
        taken = [c for c in updates.columns if c in rest]
        set_type = T.StructType([updates.schema[c] for c in taken])

    def part(rows: DataFrame, what: str, row, values) -> DataFrame:
        own = arrivals(rows, ts, seq)
        out = own.select(*key, "_t", "_s", F.lit(what).alias("_what"), row.alias("_row"))
        return out if set_type is None else own.select(*key, "_t", "_s", F.lit(what).alias("_what"), row.alias("_row"), values.alias("_set"))

    no_row = F.lit(None).cast(row_type)
    no_set = None if set_type is None else F.lit(None).cast(set_type)
    log = part(inserts, "insert", F.struct(*rest), no_set)
    if updates is not None:
        log = log.unionByName(part(updates, "update", no_row, F.struct(*taken)))
    if deletes is not None:
        log = log.unionByName(part(deletes, "delete", no_row, no_set))
    return log


def _read_with(stream: DataFrame, log: DataFrame, on: Pairs, key: Sequence[str], ts: str, seq: str, runs: dict[str, Run]) -> DataFrame:
    """Stream rows and log entries in one order per key, each with running facts about the log before it."""
    probe = F.struct(*stream.columns)
    own = arrivals(stream, ts, seq).select(
        *[F.col(s).alias(k) for s, k in on], "_t", "_s", F.lit("probe").alias("_what"),
        *[F.lit(None).cast(log.schema[c].dataType).alias(c) for c in log.columns if c in ("_row", "_set")], probe.alias("_probe"),
    )
    both = log.withColumn("_probe", F.lit(None).cast(own.schema["_probe"].dataType)).unionByName(own)
    # At one place in the order the log comes first: a row sees what its own event did.
    both = both.withColumn("_o", F.when(F.col("_what") == "probe", 1).otherwise(0))
    return running(both, key, ("_t", "_s", "_o"), runs)


def as_of_join(
    stream: DataFrame, log: DataFrame, on: Pairs, *, how: str = "inner", ts="ts", seq="seq"
) -> DataFrame:
    """Stream rows with the table rows of their key as they were at that moment.

    ``on`` pairs stream columns with the key of the log. A delete empties the key, so its count so far says to which
    generation a row belongs; a row is alive for the probes of its generation that come after it. An update sets the
    rows that are there, so a column is the last update's where that came after the insert. Table columns carry the
    prefix ``t_``; null keys match nothing.
    """
    key = [k for _, k in on]
    stream = stream.filter(reduce(lambda a, b: a & b, [F.col(s).isNotNull() for s, _ in on])) if how == "inner" else stream
    at = F.struct("_t", "_s")
    runs = {"_generation": Run("count", F.when(F.col("_what") == "delete", 1))}
    if "_set" in log.columns:
        runs["_last"] = Run("last", F.when(F.col("_what") == "update", F.struct(at.alias("at"), F.col("_set").alias("set"))))
    read = _read_with(stream, log, on, key, ts, seq, runs)
    probes = read.filter("_what = 'probe'").select(
        *[F.col(k).alias(f"_pk{i}") for i, k in enumerate(key)], "_probe", F.struct("_t", "_s").alias("_seen"),
        F.col("_generation").alias("_pg"), *(["_last"] if "_last" in runs else []),
    )
    rows = read.filter("_what = 'insert'").select(*key, F.col("_generation"), F.struct("_t", "_s").alias("_born"), "_row")
    same = reduce(lambda a, b: a & b, [F.col(f"_pk{i}") == F.col(k) for i, k in enumerate(key)])
    met = probes.join(rows, same & (F.col("_pg") == F.col("_generation")) & (F.col("_born") <= F.col("_seen")), how)
    names = log.schema["_row"].dataType.fieldNames()
    taken = log.schema["_set"].dataType.fieldNames() if "_set" in log.columns else []
    changed = F.coalesce(F.col("_last.at") > F.col("_born"), F.lit(False)) if taken else None
    values = [
        (F.when(changed, F.col(f"_last.set.{c}")).otherwise(F.col(f"_row.{c}")) if c in taken else F.col(f"_row.{c}")).alias(f"t_{c}")
        for c in names
    ]
    return met.select("_probe.*", *[F.col(k).alias(f"t_{k}") for k in key], *values)


def as_of_in(stream: DataFrame, log: DataFrame, on: Pairs, *, negate: bool = False, ts="ts", seq="seq") -> DataFrame:
    """Stream rows whose key is in the table at that moment (``negate``: is not): the last insert or delete decides."""
    key = [k for _, k in on]
    what = F.when(F.col("_what").isin("insert", "delete"), F.col("_what"))
    read = _read_with(stream, log, on, key, ts, seq, {"_now": Run("last", what)}).filter("_what = 'probe'")
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    there = known & F.coalesce(F.col("_now") == "insert", F.lit(False))
    return read.filter(~there if negate else there).select("_probe.*")


# --- stored tables ----------------------------------------------------------------------------


def save(table: DataFrame, root: str, version: int, *, replace: bool = False) -> None:
    """Write a new version; it becomes current when the write commits. ``replace`` makes a
    repeated micro-batch write its version again."""
    mode = "overwrite" if replace else "errorifexists"
    table.write.mode(mode).parquet(f"{root}/version={version}")


def current(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    """The latest complete version and its number. Folders are listed, data is not read."""
    newest = max(complete_versions(spark, root), default=None)
    if newest is None:
        raise FileNotFoundError(f"no complete version below {root}")
    return spark.read.parquet(f"{root}/version={newest}"), newest


def complete_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions whose write has committed (its ``_SUCCESS`` marker is there)."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(root)
    folders = [i.base_name for i in store.get_file_info(fs.FileSelector(path, allow_not_found=True))]
    numbers = [int(name.removeprefix("version=")) for name in folders if name.startswith("version=")]
    markers = store.get_file_info([f"{path}/version={n}/_SUCCESS" for n in numbers])
    return [n for n, marker in zip(numbers, markers, strict=True) if marker.type == fs.FileType.File]
