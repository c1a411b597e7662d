"""Temporal patterns and strict sequences over one merged, ordered stream.

Plain shapes (``chain``, ``strict``) are window expressions. Shapes with counts,
logical pairs, group repetition or conditions on earlier events are read in
order by a small step function, spread over as many tasks as the shape allows:

* a sequence dies at any event that fits none of its steps, so the stream is cut
  into segments at such events;
* a pattern repeated from its first step within a time bound is evaluated per
  time cell, with the first rows of the next cell as look-ahead;
* a pattern that is not repeated matches at most once per key, so only rows from
  the first fitting start on are read;
* anything else needs a partition key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.windows import ARRIVAL_ORDER, arrivals, ordered_scan
from tidemark.ordering import Run, neighbour, plan_split, running
from tidemark.session import materialize

Where = Callable[[dict, dict], bool]
CELLS_PER_BOUND = 4


@dataclass(frozen=True)
class Step:
    """One state: the event condition ``when`` (evaluated by Spark) and an optional
    condition ``where(event, match)`` on events matched earlier."""

    name: str
    when: Column
    where: Where | None = None
    low: int = 1
    high: int | None = 1
    counted: bool = False


@dataclass(frozen=True)
class Pair:
    """Two steps joined by ``and`` (both, any order) or ``or`` (either)."""

    kind: str
    first: Step
    second: Step


def step(name: str, when: Column, where: Where | None = None) -> Step:
    return Step(name, when, where)


def count(base: Step, low: int = 0, high: int | None = None) -> Step:
    """``<low:high>``; without ``high`` there is no upper bound."""
    return replace(base, low=low, high=high, counted=True)


def star(base: Step) -> Step:
    return count(base, 0, None)


def plus(base: Step) -> Step:
    return count(base, 1, None)


def optional(base: Step) -> Step:
    return count(base, 0, 1)


def both(first: Step, second: Step) -> Pair:
    return Pair("and", first, second)


def either(first: Step, second: Step) -> Pair:
    return Pair("or", first, second)


def _struct(fields: Sequence[str]) -> Column:
    return F.struct(*fields)


# --- shapes that are plain window expressions -------------------------------------------------


def chain(
    df: DataFrame,
    steps: Sequence[tuple[str, Column]],
    fields: Sequence[str],
    *,
    keys: Sequence[str] = (),
    every: bool = False,
    within_ms: int | None = None,
    ts="ts",
    seq="seq",
) -> DataFrame:
    """``[every] e1 -> e2 -> ...`` without conditions between events.

    With ``every`` each first event is completed by the next fitting events after
    it; without, only the first start of a key counts.
    """
    rows = arrivals(df, ts, seq)
    names = [n for n, _ in steps]
    base = list(rows.columns)
    split = plan_split(rows, keys, ARRIVAL_ORDER)
    later: str | None = None
    for name, when in reversed(steps[1:]):
        content = F.struct(
            F.struct(*fields).alias("v"), F.col("_t").alias("t"), *([F.col(later).alias("n")] if later else [])
        )
        out = f"_next_{name}"
        hit = F.when(F.coalesce(when, F.lit(False)), content)
        rows = running(rows, keys, ARRIVAL_ORDER, {out: Run("last", hit)}, reverse=True, inclusive=False, split=split)
        rows = rows.select(*base, out)
        if split.active and name != names[1]:
            rows = materialize(rows)  # each further pass reads its input twice
        later = out
    starts = rows.filter(F.coalesce(steps[0][1], F.lit(False)))
    if not every:
        best = F.min_by(F.struct(*starts.columns), F.struct(*ARRIVAL_ORDER)).alias("_r")
        starts = starts.groupBy(*keys).agg(best).select("_r.*")
    places = [f"_next_{names[1]}" + ".n" * i for i in range(len(names) - 1)] if later else []
    out = starts.select(
        *keys,
        F.col("_t").alias("_first"),
        F.struct(*fields).alias(names[0]),
        *[F.col(f"{p}.v").alias(n) for p, n in zip(places, names[1:])],
        *([F.col(f"{places[-1]}.t").alias("_at")] if places else [F.col("_t").alias("_at")]),
    )
    done = out.filter(F.col("_at").isNotNull())
    if within_ms is not None:
        done = done.filter(F.col("_at") - F.col("_first") <= within_ms * 1000)
    return done.drop("_first")


def strict(
    df: DataFrame,
    steps: Sequence[tuple[str, Column]],
    fields: Sequence[str],
    *,
    keys: Sequence[str] = (),
    within_ms: int | None = None,
    ts="ts",
    seq="seq",
) -> DataFrame:
    """``e1, e2, ...``: directly successive events. A condition may use the row's own
    columns; conditions on earlier events go through ``sequence``."""
    rows = arrivals(df, ts, seq)
    base = list(rows.columns)
    split = plan_split(rows, keys, ARRIVAL_ORDER)
    rows = rows.withColumns({f"_is_{n}": F.coalesce(w, F.lit(False)) for n, w in steps})
    flags = [f"_is_{n}" for n, _ in steps]
    later: str | None = None
    for i in range(len(steps) - 1):
        content = F.struct(
            *[F.col(c).alias(c) for c in (*flags, "_t")], F.struct(*fields).alias("v"),
            *([F.col(later).alias("n")] if later else []),
        )
        out = f"_after{i}"
        rows = neighbour(rows, keys, ARRIVAL_ORDER, 1, {out: content}, split=split).select(*base, *flags, out)
        if split.active and i < len(steps) - 2:
            rows = materialize(rows)  # each further pass reads its input twice
        later = out
    places = [later + ".n" * i for i in range(len(steps) - 1)] if later else []
    fits = [F.col(flags[0]), *[F.col(f"{p}.{flags[i + 1]}") for i, p in enumerate(places)]]
    out = rows.filter(reduce(lambda a, b: a & b, fits))
    last = F.col(f"{places[-1]}._t") if places else F.col("_t")
    if within_ms is not None:
        out = out.filter(last - F.col("_t") <= within_ms * 1000)
    return out.select(
        *keys,
        F.struct(*fields).alias(steps[0][0]),
        *[F.col(f"{p}.v").alias(n) for p, (n, _) in zip(places, steps[1:])],
        last.alias("_at"),
    )


# --- shapes that are read in order --------------------------------------------------------------


def _partial() -> dict:
    """A match in progress: filled slots, time of the first event, last step reached.

    Plain data, so that it can be kept as streaming state.
    """
    return {"slots": {}, "first": None, "reached": -1}


def _copied(p: dict) -> dict:
    slots = {n: list(v) if isinstance(v, list) else v for n, v in p["slots"].items()}
    return {**p, "slots": slots}


@dataclass(frozen=True)
class _Shape:
    """What the step function needs to know; carries no Spark objects."""

    groups: tuple[tuple[str, tuple[tuple, ...]], ...]
    bound: int | None
    again: tuple[int, int] | None
    contiguous: bool


def _plain(part: Step | Pair) -> tuple[str, tuple[tuple, ...]]:
    steps = (part,) if isinstance(part, Step) else (part.first, part.second)
    kind = "one" if isinstance(part, Step) else part.kind
    if isinstance(part, Step) and part.counted:
        kind = "count"
    return kind, tuple((s.name, s.where, s.low, s.high) for s in steps)


class _Reader:
    """Advances partial matches by one event. An event fills at most one successive
    step of a match, because what it advances waits in ``fresh`` until it is done."""

    def __init__(self, shape: _Shape, memory: dict):
        self.shape, self.memory = shape, memory
        self.last = len(shape.groups) - 1
        self.fresh: list[list[dict]] = [[] for _ in shape.groups]
        self.done: list[dict] = []
        if "waiting" not in memory:
            self.enter(_partial(), 0)
            self._swap()

    def _swap(self) -> None:
        self.memory["waiting"], self.fresh = self.fresh, [[] for _ in self.shape.groups]

    def enter(self, p: dict, g: int) -> None:
        kind, states = self.shape.groups[g]
        if kind != "count" or states[0][2] > 0:
            self.fresh[g].append(p)
            return
        p["slots"].setdefault(states[0][0], [])
        if self.shape.contiguous and g < self.last:
            self.fresh[g].append(p)
            self.enter(_copied(p), g + 1)
            return
        if g < self.last:
            self.fresh[g].append(p)
        p["reached"] = max(p["reached"], g)
        self.advance(p, g)

    def advance(self, p: dict, g: int) -> None:
        again = self.shape.again
        if again is not None and g == again[1]:
            kept = {n for _, states in self.shape.groups[: again[0]] for n, *_ in states}
            clone = _copied(p)
            clone["slots"] = {n: v for n, v in clone["slots"].items() if n in kept}
            clone["first"] = clone["first"] if clone["slots"] else None
            clone["reached"] = again[0] - 1
            self.enter(clone, again[0])
        if g == self.last:
            self.done.append(_copied(p)["slots"])
        else:
            self.enter(p, g + 1)

    def fits(self, p: dict, state: tuple, event: dict, flags: dict) -> bool:
        if not flags[state[0]]:
            return False
        return state[1] is None or bool(state[1](event, p["slots"]))

    def put(self, p: dict, name: str, event: dict, now: int, many: bool) -> None:
        if many:
            p["slots"].setdefault(name, []).append(event)
        else:
            p["slots"][name] = event
        if p["first"] is None:
            p["first"] = now

    def read(self, event: dict, now: int, flags: dict, owned: bool) -> list[dict]:
        bound = self.shape.bound
        self.done = []
        for g in range(self.last, -1, -1):
            kind, states = self.shape.groups[g]
            for p in self.memory["waiting"][g]:
                if p["reached"] > g:
                    continue
                late = bound is not None and p["first"] is not None and now - p["first"] > bound
                if late and kind != "and":
                    continue
                if p["first"] is None and not owned:
                    self.keep(p, g)
                    continue
                getattr(self, f"_{kind}")(p, g, states, event, now, flags)
        if self.shape.contiguous:
            self.enter(_partial(), 0)
        self._swap()
        return self.done

    def keep(self, p: dict, g: int) -> None:
        if not self.shape.contiguous:
            self.fresh[g].append(p)

    def _one(self, p, g, states, event, now, flags) -> None:
        if not self.fits(p, states[0], event, flags):
            self.keep(p, g)
            return
        self.put(p, states[0][0], event, now, False)
        p["reached"] = g
        self.advance(p, g)

    def _or(self, p, g, states, event, now, flags) -> None:
        for state in reversed(states):
            if self.fits(p, state, event, flags):
                self.put(p, state[0], event, now, False)
                p["reached"] = g
                self.advance(p, g)
                return
        self.keep(p, g)

    def _and(self, p, g, states, event, now, flags) -> None:
        for state in reversed(states):
            if state[0] not in p["slots"] and self.fits(p, state, event, flags):
                self.put(p, state[0], event, now, False)
        if all(s[0] in p["slots"] for s in states):
            p["reached"] = g
            self.advance(p, g)
        else:
            self.keep(p, g)

    def _count(self, p, g, states, event, now, flags) -> None:
        name, _, low, high = states[0]
        held = len(p["slots"].get(name, ()))
        if high is not None and held >= high:
            return
        # The condition may look at the list with the event already in it.
        before = p["slots"].get(name, [])
        p["slots"][name] = [*before, event]
        fit = self.fits(p, states[0], event, flags)
        p["slots"][name] = before
        if not fit:
            self.keep(p, g)
            return
        self.put(p, name, event, now, True)
        p["reached"] = g
        held += 1
        if self.shape.contiguous:
            if held >= low:
                if g == self.last:
                    self.done.append(_copied(p)["slots"])
                    return
                self.enter(_copied(p), g + 1)
            self.fresh[g].append(p)
        elif held == low:
            if g < self.last:
                self.fresh[g].append(p)
            self.advance(p, g)
        else:
            self.fresh[g].append(p)


def _steps(parts: Sequence[Step | Pair]) -> list[Step]:
    return [s for p in parts for s in ((p,) if isinstance(p, Step) else (p.first, p.second))]


def _step_function(
    schema_of: T.StructType, parts: Sequence[Step | Pair], fields: Sequence[str], keys: Sequence[str], shape: _Shape
):
    """Output schema and step function of a shape."""
    steps = _steps(parts)
    names = [s.name for s in steps]
    counted = {s.name for s in steps if s.counted}
    fields, keys = tuple(fields), tuple(keys)
    event_type = T.StructType([schema_of[f] for f in fields])
    schema = T.StructType(
        [
            *[schema_of[k] for k in keys],
            *[T.StructField(s.name, T.ArrayType(event_type) if s.counted else event_type) for s in steps],
            T.StructField("_at", T.LongType()),
        ]
    )

    def make(columns: list[str], memory: dict):
        field_at = [(f, columns.index(f)) for f in fields]
        flag_at = [(n, columns.index(f"_is_{n}")) for n in names]
        key_at = [columns.index(k) for k in keys]
        now_at, own_at = columns.index("_t"), columns.index("_own")
        reader = _Reader(shape, memory)

        def take(row: tuple) -> list[tuple]:
            event = {f: row[i] for f, i in field_at}
            flags = {n: row[i] for n, i in flag_at}
            found = reader.read(event, row[now_at], flags, row[own_at])
            key = tuple(row[i] for i in key_at)
            return [
                (*key, *[m.get(n, [] if n in counted else None) for n in names], row[now_at]) for m in found
            ]

        return take

    return schema, make


def _slim(rows: DataFrame, parts, fields, group, keys) -> DataFrame:
    flags = [f"_is_{s.name}" for s in _steps(parts)]
    return rows.select(*dict.fromkeys([*group, *keys, *fields, "_t", "_s", "_own", *flags]))


def _scan(
    rows: DataFrame, parts: Sequence[Step | Pair], fields: Sequence[str], group: Sequence[str],
    keys: Sequence[str], shape: _Shape,
) -> DataFrame:
    schema, make = _step_function(rows.schema, parts, fields, keys, shape)
    return ordered_scan(_slim(rows, parts, fields, group, keys), group, ["_t", "_s"], make, schema)


def _flagged(df, parts, ts, seq) -> DataFrame:
    flags = {f"_is_{s.name}": F.coalesce(s.when, F.lit(False)) for s in _steps(parts)}
    return arrivals(df, ts, seq).withColumns(flags).withColumn("_own", F.lit(True))


def _any_flag(parts) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"_is_{s.name}") for s in _steps(parts)])


def pattern(
    df: DataFrame,
    parts: Sequence[Step | Pair],
    fields: Sequence[str],
    *,
    keys: Sequence[str] = (),
    every: bool | tuple[int, int] = False,
    within_ms: int | None = None,
    ts="ts",
    seq="seq",
) -> DataFrame:
    """``[every] part -> part -> ...`` with counts, pairs and conditions on earlier events.

    ``every=True`` repeats from the first part; ``every=(i, j)`` repeats parts ``i``
    to ``j`` as a group, re-armed when the group is complete. Gaps are allowed, so
    events that fit no part are filtered out before the shuffle.
    """
    again = (0, 0) if every is True else (every or None)
    bound = None if within_ms is None else within_ms * 1000
    shape = _Shape(tuple(_plain(p) for p in parts), bound, again, False)
    rows = _flagged(df, parts, ts, seq).filter(_any_flag(parts))
    simple_start = isinstance(parts[0], Step) and not parts[0].counted
    # An ``and`` pair may complete after the bound, so its events must not be cut off by it.
    cut_at_bound = bound is not None and not any(kind == "and" for kind, _ in shape.groups)
    if again == (0, 0) and simple_start and cut_at_bound:
        width = bound * CELLS_PER_BOUND
        cell = F.floor(F.col("_t") / F.lit(width)).cast("bigint")
        ahead = F.col("_t") - cell * width <= bound
        cells = F.when(ahead, F.array(cell, cell - 1)).otherwise(F.array(cell))
        spread = rows.withColumn("_cell", F.explode(cells)).withColumn("_own", F.col("_cell") == cell)
        return _scan(spread, parts, fields, [*keys, "_cell"], keys, shape)
    if again is None and simple_start:
        place = F.struct(*ARRIVAL_ORDER)
        starts = rows.filter(F.col(f"_is_{parts[0].name}"))
        if keys:
            first = starts.groupBy(*[F.col(k).alias(f"_fk{i}") for i, k in enumerate(keys)]).agg(
                F.min(place).alias("_start")
            )
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_fk{i}")) for i, k in enumerate(keys)])
            rows = rows.join(first, same).drop(*[f"_fk{i}" for i in range(len(keys))])
        else:
            rows = rows.withColumn("_start", starts.agg(F.min(place)).scalar())
        rows = rows.filter(place >= F.col("_start"))
        if cut_at_bound:
            rows = rows.filter(F.col("_t") - F.col("_start._t") <= bound)
    if not keys:
        if again is not None:
            raise ValueError("a repeated pattern needs a partition key, or a time bound from its first step")
        rows, group = rows.withColumn("_all", F.lit(0)), ["_all"]
    else:
        group = list(keys)
    return _scan(rows, parts, fields, group, keys, shape)


def sequence(
    df: DataFrame,
    parts: Sequence[Step | Pair],
    fields: Sequence[str],
    *,
    keys: Sequence[str] = (),
    within_ms: int | None = None,
    ts="ts",
    seq="seq",
) -> DataFrame:
    """``part, part, ...`` strictly successive, with ``*``, ``+``, ``?`` and ``or``.

    Every event may open a match. An event that fits no part ends all of them,
    which cuts each key into segments that are read independently.
    """
    bound = None if within_ms is None else within_ms * 1000
    shape = _Shape(tuple(_plain(p) for p in parts), bound, None, True)
    rows = _flagged(df, parts, ts, seq)
    ends = F.when(_any_flag(parts), 0).otherwise(1).cast("bigint")
    cut = running(rows, keys, ARRIVAL_ORDER, {"_segment": Run("sum", ends)}).filter(_any_flag(parts))
    return _scan(cut, parts, fields, [*keys, "_segment"], keys, shape)
