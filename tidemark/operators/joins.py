"""Window joins of two streams, and joins with tables.

An arriving row is paired with the other side's live rows and then becomes live
itself, so every pair has a later row (the trigger) and an earlier one. All
bounds are turned into ranges on a numeric axis (time or position), the axis is
cut into cells one range wide, and the join is an equi join on the cell plus the
range check: a hash or sort-merge join, never a nested loop. A hot key is spread
over its cells; adaptive execution splits what is still too large.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.windows import arrivals
from tidemark.ordering import Run, running

Pairs = Sequence[tuple[str, str]]
On = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def _sides(left: DataFrame, right: DataFrame):
    """Both sides with prefixed columns, and accessors for conditions."""
    l = left.select(*[F.col(c).alias(f"l_{c}") for c in left.columns])
    r = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    return l, r, (lambda c: F.col(f"l_{c}")), (lambda c: F.col(f"r_{c}"))


def range_join(
    left: DataFrame,
    right: DataFrame,
    low: int,
    high: int,
    *,
    axes: tuple[str, str],
    equal: Pairs = (),
    on: On | None = None,
    how: str = "inner",
) -> DataFrame:
    """Pairs with ``low <= right.axis - left.axis <= high``; columns ``l_*`` and ``r_*``.

    Each row of one side is copied to at most two cells; the other side stays in
    its own cell, so an outer join on the side that is not copied is exact.
    """
    l, r, lc, rc = _sides(left, right)
    la, ra = lc(axes[0]), rc(axes[1])
    width = F.lit(max(high - low, 1))

    def cell(x: Column) -> Column:
        return F.floor(x / width).cast("bigint")

    def condition() -> Column:
        parts = [F.col("_lc") == F.col("_rc")]
        parts += [lc(a) == rc(b) for a, b in equal]
        parts += [(ra - la).between(low, high)]
        if on is not None:
            parts.append(F.coalesce(on(lc, rc), F.lit(False)))
        return reduce(lambda a, b: a & b, parts)

    if how == "full":
        one = range_join(left, right, low, high, axes=axes, equal=equal, on=on, how="left")
        other = range_join(left, right, low, high, axes=axes, equal=equal, on=on, how="right")
        return one.unionByName(other.filter(F.col(f"l_{axes[0]}").isNull()))
    if how == "left":
        copies = r.withColumn("_rc", F.explode(F.sequence(cell(ra - high), cell(ra - low))))
        out = l.withColumn("_lc", cell(la)).join(copies, condition(), "left")
    else:
        copies = l.withColumn("_lc", F.explode(F.sequence(cell(la + low), cell(la + high))))
        out = copies.join(r.withColumn("_rc", cell(ra)), condition(), how)
    return out.drop("_lc", "_rc")


def _trigger(pairs: DataFrame, *, unidirectional: str | None) -> DataFrame:
    """Stamp each pair with its trigger; optionally keep one side's triggers."""
    later_left = F.struct("l__t", "l__s") > F.struct("r__t", "r__s")
    out = pairs.withColumn("_trigger", F.when(later_left, "left").otherwise("right"))
    if unidirectional:
        out = out.filter(F.col("_trigger") == unidirectional)
    return out.withColumn("_at", F.greatest("l__t", "r__t"))


def time_join(
    left: DataFrame,
    right: DataFrame,
    left_ms: int,
    right_ms: int,
    *,
    equal: Pairs = (),
    on: On | None = None,
    within_ms: int | None = None,
    unidirectional: str | None = None,
    how: str = "inner",
    ts="ts",
    seq="seq",
) -> DataFrame:
    """``left#window.time(l) join right#window.time(r)``.

    A left row is found by right rows arriving less than ``left_ms`` later, and
    the other way round. ``within`` bounds the time difference further;
    ``unidirectional`` keeps the pairs triggered by one side: the later in time, and
    at equal times by sequence number. ``how`` may be an outer join over the same pairs.
    """
    high, low = left_ms * 1000 - 1, -(right_ms * 1000 - 1)
    if within_ms is not None:
        high, low = min(high, within_ms * 1000), max(low, -within_ms * 1000)
    if unidirectional == "left":
        high = min(high, 0)
    elif unidirectional == "right":
        low = max(low, 0)

    def holds(lc, rc) -> Column:
        """The trigger rule belongs to the condition, or an outer join would see pairs that it drops."""
        later_left = F.struct(lc("_t"), lc("_s")) > F.struct(rc("_t"), rc("_s"))
        kept = {None: F.lit(True), "left": later_left, "right": ~later_left}[unidirectional]
        return kept if on is None else kept & F.coalesce(on(lc, rc), F.lit(False))

    pairs = range_join(
        arrivals(left, ts, seq), arrivals(right, ts, seq), low, high,
        axes=("_t", "_t"), equal=equal, on=on if unidirectional is None else holds, how=how,
    )
    if how != "inner":
        return pairs.drop("l__t", "l__s", "r__t", "r__s")
    return _trigger(pairs, unidirectional=unidirectional).drop("l__t", "l__s", "r__t", "r__s")


def expired_pairs(
    left: DataFrame, right: DataFrame, left_ms: int, right_ms: int,
    *, equal: Pairs = (), on: On | None = None, ts="ts", seq="seq",
) -> DataFrame:
    """Pairs emitted when a row leaves its window and probes the other side's live rows."""
    a, b = arrivals(left, ts, seq), arrivals(right, ts, seq)
    gone_left = a.withColumn("_e", F.col("_t") + left_ms * 1000)
    by_left = range_join(
        gone_left, b, -(right_ms * 1000 - 1), -1, axes=("_e", "_t"), equal=equal, on=on
    ).withColumn("_at", F.col("l__e")).withColumn("_leaving", F.lit("left")).drop("l__e")
    gone_right = b.withColumn("_e", F.col("_t") + right_ms * 1000)
    by_right = range_join(
        a, gone_right, 1, left_ms * 1000 - 1, axes=("_t", "_e"), equal=equal, on=on
    ).withColumn("_at", F.col("r__e")).withColumn("_leaving", F.lit("right")).drop("r__e")
    return by_left.unionByName(by_right).drop("l__t", "l__s", "r__t", "r__s")


def length_join(
    left: DataFrame,
    right: DataFrame,
    left_n: int,
    right_n: int,
    *,
    equal: Pairs = (),
    on: On | None = None,
    unidirectional: str | None = None,
    ts="ts",
    seq="seq",
) -> DataFrame:
    """``left#window.length(n) join right#window.length(m)``.

    Every row learns its own position and how many rows of the other side came
    before it; live partners are then a range of positions.
    """
    a, b = arrivals(left, ts, seq), arrivals(right, ts, seq)
    both = a.select("_t", "_s", F.lit(0).alias("_side"), F.struct(*a.columns).alias("_l")).unionByName(
        b.select("_t", "_s", F.lit(1).alias("_side"), F.struct(*b.columns).alias("_r")),
        allowMissingColumns=True,
    )
    is_left = F.when(F.col("_side") == 0, 1)
    is_right = F.when(F.col("_side") == 1, 1)
    placed = running(
        both, (), ("_t", "_s", "_side"), {"_nl": Run("count", is_left), "_nr": Run("count", is_right)}
    )
    l, r, lc, rc = _sides(
        placed.filter("_side = 0").select("_l.*", "_nl", "_nr"), placed.filter("_side = 1").select("_r.*", "_nl", "_nr")
    )
    # Left triggers find right positions (way 0), right triggers find left positions (way 1). Both
    # ways go through one join, so each side is read once.
    ways = {0: (right_n, "_nr", -(right_n - 1), 0), 1: (left_n, "_nl", 0, left_n - 1)}
    if unidirectional is not None:
        ways = {w: v for w, v in ways.items() if w == (0 if unidirectional == "left" else 1)}

    def cell(x: Column, n: int) -> Column:
        return F.floor(x / F.lit(n)).cast("bigint")

    def tagged(way: int, cells: Column) -> Column:
        return F.transform(cells, lambda x: F.struct(F.lit(way).alias("w"), x.alias("c")))

    copies = [
        tagged(w, F.sequence(cell(lc(c) + low, n), cell(lc(c) + high, n))) for w, (n, c, low, high) in ways.items()
    ]
    own = [F.struct(F.lit(w).alias("w"), cell(rc(c), n).alias("c")) for w, (n, c, _, _) in ways.items()]
    far = l.withColumn("_lw", F.explode(F.concat(*copies))).withColumns({"_lway": F.col("_lw.w"), "_lcell": F.col("_lw.c")})
    near = r.withColumn("_rw", F.explode(F.array(*own))).withColumns({"_rway": F.col("_rw.w"), "_rcell": F.col("_rw.c")})
    inside = reduce(
        lambda a, b: a | b,
        [(F.col("_lway") == w) & (rc(c) - lc(c)).between(low, high) for w, (_, c, low, high) in ways.items()],
    )
    condition = (F.col("_lway") == F.col("_rway")) & (F.col("_lcell") == F.col("_rcell")) & inside
    for a, b in equal:
        condition = condition & (lc(a) == rc(b))
    if on is not None:
        condition = condition & F.coalesce(on(lc, rc), F.lit(False))
    pairs = far.join(near, condition).withColumn("_trigger", F.when(F.col("_lway") == 0, "left").otherwise("right"))
    drop = [f"{p}_{c}" for p in "lr" for c in ("_t", "_s", "_nl", "_nr")]
    return pairs.drop(*drop, "_lw", "_rw", "_lway", "_rway", "_lcell", "_rcell")


def _needs_equality(equal: Pairs) -> None:
    if not equal:
        raise ValueError("without an equality the join would compare all rows with all; give at least one")


def unbounded_join(
    left: DataFrame, right: DataFrame, equal: Pairs, *, on: On | None = None,
    unidirectional: str | None = None, ts="ts", seq="seq",
) -> DataFrame:
    """Sides without a window keep every row live: an equi join, the later row triggers."""
    _needs_equality(equal)
    l, r, lc, rc = _sides(arrivals(left, ts, seq), arrivals(right, ts, seq))
    condition = reduce(lambda a, b: a & b, [lc(a) == rc(b) for a, b in equal])
    if on is not None:
        condition = condition & F.coalesce(on(lc, rc), F.lit(False))
    pairs = _trigger(l.join(r, condition), unidirectional=unidirectional)
    return pairs.drop("l__t", "l__s", "r__t", "r__s")


def partner_counts(
    left: DataFrame, right: DataFrame, equal: Pairs, out: str = "n_partners", *, ts="ts", seq="seq"
) -> DataFrame:
    """How many rows of the other side each arriving row of either side finds in an
    unbounded join, without building the pairs: a running count per key.

    One row per arrival with ``_side``, ``_key`` (the equal columns), ``_s`` and the count.
    """
    keys = [f"_k{i}" for i in range(len(equal))]

    def side(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
        a = arrivals(df, ts, seq)
        return a.select(*[F.col(c).alias(k) for c, k in zip(columns, keys)], "_t", "_s", F.lit(name).alias("_side"))

    both = side(left, [a for a, _ in equal], "left").unionByName(side(right, [b for _, b in equal], "right"))
    is_left = F.col("_side") == "left"
    runs = {"_nl": Run("count", F.when(is_left, 1)), "_nr": Run("count", F.when(~is_left, 1))}
    counted = running(both, keys, ("_t", "_s", "_side"), runs)
    return counted.select(F.struct(*keys).alias("_key"), "_side", "_s", F.when(is_left, F.col("_nr")).otherwise(F.col("_nl")).alias(out))


def table_join(
    stream: DataFrame, table: DataFrame, equal: Pairs, *, on: On | None = None, how: str = "inner"
) -> DataFrame:
    """Stream with table; only the stream triggers. Spark broadcasts the table when its
    measured size is below the session's threshold and shuffles otherwise."""
    _needs_equality(equal)
    l, r, lc, rc = _sides(stream, table)
    condition = reduce(lambda a, b: a & b, [lc(a) == rc(b) for a, b in equal])
    if on is not None:
        condition = condition & F.coalesce(on(lc, rc), F.lit(False))
    return l.join(r, condition, how)
