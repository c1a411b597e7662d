"""Extremes and user aggregates over live intervals, centred regression and tables read while they change."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import intervals as I
from tidemark.operators import regression as G
from tidemark.operators import tables as T
from tidemark.operators import windows as W

ROWS = "seq long, ts long, k string, u long, v long"


def stream(seed=1, count=400, hot=0.9):
    rng = random.Random(seed)
    rows, ts = [], 0
    for i in range(count):
        ts += rng.choice([0, 1, 1, 7_000_000])
        key = "hot" if rng.random() < hot else rng.choice(["a", None])
        rows.append((i, ts, key, rng.randrange(6), rng.choice([None, *range(-20, 20)])))
    return rows


def live_after(changes):
    """Live values after every change, replayed."""
    out, live, gone = {}, {}, set()
    for c in sorted(changes, key=lambda r: (r["_at"], r["_by"], r["_tie"], r["_seq"])):
        held = live.setdefault(c["k"], {})
        if c["_kind"] == "expired":
            held.pop(c["_seq"], None)
            gone.add(c["_seq"])
        elif c["_seq"] not in gone:  # a row that does not fit into a sort window leaves as it comes
            held[c["_seq"]] = c["v"]
        values = [v for v in held.values() if v is not None]
        out[c["k"], c["_seq"], c["_kind"]] = (min(values), max(values)) if values else (None, None)
    return out


WINDOWS = {
    "unique": lambda d: W.unique(d, ["u"], keys=["k"]),
    "length": lambda d: W.length(d, 5, keys=["k"]),
    "time": lambda d: W.time(d, 20_000),
    "batch": lambda d: W.length_batch(d, 4, keys=["k"]),
    "sort": lambda d: W.sort_window(d, 3, [("u", False), ("v", True)], keys=["k"]),
}


@pytest.mark.parametrize("name", list(WINDOWS))
def test_extremes_in_any_window(spark, name):
    changes = WINDOWS[name](spark.createDataFrame(stream(), ROWS))
    want = live_after(changes.collect())
    got = A.over_changes(changes, ["k"], lows={"low": "v"}, highs={"high": "v"}, count="n").collect()
    assert {(r["k"], r["_seq"], r["_kind"]): (r["low"], r["high"]) for r in got} == want and len(got) == len(want)


def test_a_hot_group_is_many_pieces(spark):
    rows = I.numbered(W.unique(spark.createDataFrame(stream(2, 3000, 1.0), ROWS), ["u"]), [])
    held, probes = I.pieces(rows, [], {"_v": F.col("v")})
    sizes = [r["count"] for r in held.groupBy("_l", "_i").count().collect()]
    assert sum(sizes) <= 3000 * 2 * 13 and max(sizes) <= 12 and len(sizes) > 1000
    assert held.agg(F.max("_l")).first()[0] <= 13


class Spread(I.Mergeable):
    width = 3

    def lift(self, values):
        return np.stack([np.ones(len(values)), values, values**2], 1)

    def merge(self, a, b):
        return a + b

    def finish(self, states):
        return states[:, 2] / states[:, 0] - (states[:, 1] / states[:, 0]) ** 2


def variance(values):
    return None if not values else float(np.var(values))


def test_user_aggregate_of_groups(spark):
    rows = stream(3, 500)
    got = I.user_aggregate(spark.createDataFrame(rows, ROWS).repartition(5), ["k", "u"], "v", "x", Spread()).collect()
    want = {}
    for _, _, k, u, v in rows:
        if v is not None:
            want.setdefault((k, u), []).append(v)
    assert {(r["k"], r["u"]) for r in got} == set(want) and len(got) == len(want)
    assert all(r["x"] == pytest.approx(variance(want[r["k"], r["u"]]), abs=1e-9) for r in got)
    whole = I.user_aggregate(spark.createDataFrame(rows, ROWS), [], "v", "x", Spread()).collect()
    assert [r["x"] for r in whole] == [pytest.approx(variance([v for *_, v in rows if v is not None]))]
    assert I.user_aggregate(spark.createDataFrame([], ROWS), ["k"], "v", "x", Spread()).collect() == []


def test_user_aggregate_over_changes(spark):
    changes = W.unique(spark.createDataFrame(stream(4, 200), ROWS), ["u"], keys=["k"])
    live, want = {}, {}
    for c in sorted(changes.collect(), key=lambda r: (r["_at"], r["_by"], r["_tie"], r["_seq"])):
        held = live.setdefault(c["k"], {})
        held.pop(c["_seq"], None) if c["_kind"] == "expired" else held.__setitem__(c["_seq"], c["v"])
        want[c["k"], c["_seq"], c["_kind"]] = variance([v for v in held.values() if v is not None])
    got = I.user_over_changes(changes, ["k"], "v", "x", Spread()).collect()
    assert len(got) == len(want)
    for r in got:
        x = want[r["k"], r["_seq"], r["_kind"]]
        assert r["x"] is None if x is None else r["x"] == pytest.approx(x, abs=1e-9)


@pytest.mark.parametrize("group", [[], ["k"]])
def test_pieces_are_never_broadcast(spark, tmp_path, group):
    """Their size is guessed from a small file; as broadcasts they would all meet in the driver."""
    made = spark.createDataFrame([(i, i + 1, "a", 1, 1) for i in range(9)], "_seq long, _pos long, k string, _sign int, v int")
    made.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    out = I.extremes(rows, group, lows={"low": "v"})
    own = I.combined(I._lifted(rows, [*group, "_pos"], "v", Spread()), [*group, "_pos"], Spread())
    for df in (out, I._back(rows, own, group, ["_state"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert [r["low"] for r in out.collect()] == [1] * 9


def test_merge_segments():
    states = np.arange(10.0)[:, None]
    first = np.array([1, 0, 0, 1, 1, 0, 0, 0, 0, 1], bool)
    assert I.merge_segments(states, first, lambda a, b: a + b)[:, 0].tolist() == [3, 3, 30, 9]


# --- regression -------------------------------------------------------------------------------


def exact(xs, ys):
    from fractions import Fraction

    xs, ys = [Fraction(x) for x in xs], [Fraction(y) for y in ys]
    n, mx, my = len(xs), sum(xs) / len(xs), sum(ys) / len(ys)
    sxx = sum((x - mx) ** 2 for x in xs)
    slope = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / sxx
    sse = sum((y - my - slope * (x - mx)) ** 2 for x, y in zip(xs, ys))
    return float(my - slope * mx), float(slope), float(sse / (n - 2)) ** 0.5


@pytest.mark.parametrize("batch", [None, 40])
@pytest.mark.parametrize("step", [60, 86_400])
def test_epoch_seconds_cost_no_digits(spark, batch, step):
    points = [(i, i, 1_700_000_000 + step * i, 5 + 2 * i + 0.1 * (i % 3)) for i in range(200)]
    df = spark.createDataFrame(points, "seq long, ts long, x long, y double")
    got = {r["seq"]: r for r in G.regress(df, "y", ["x"], batch=batch).collect()}
    for last in (3, 39, 40, 57, 150, 199):
        part = points[0 if batch is None else max(0, last + 1 - batch) : last + 1]
        b0, b1, error = exact([p[2] for p in part], [p[3] for p in part])
        assert got[last]["beta1"] == pytest.approx(b1, rel=1e-9) and got[last]["beta0"] == pytest.approx(b0, rel=1e-9)
        assert got[last]["stdError"] == pytest.approx(error, rel=1e-6)


def test_the_offset_of_the_verdict(spark):
    df = spark.createDataFrame([(i, i, 1_700_000_000 + 60 * i, 5 + 2 * i + 0.1 * (i % 3)) for i in range(200)], "seq long, ts long, x long, y double")
    last = G.regress(df, "y", ["x"]).filter("seq = 199").first()
    assert last["beta0"] == pytest.approx(-56_666_803.95, abs=0.01) and last["stdError"] == pytest.approx(0.08196, abs=1e-5)


def test_constant_x_and_nulls(spark):
    df = spark.createDataFrame([(i, i, 7.0, float(i)) for i in range(10)], "seq long, ts long, x double, y double")
    assert {tuple(r)[-3:] for r in G.regress(df, "y", ["x"], batch=4).collect()} == {(0.0, 0.0, 0.0)}
    rows = [(i, i, None if i == 5 else float(i), 3.0 * i + (i % 2)) for i in range(12)]
    some = spark.createDataFrame(rows, "seq long, ts long, x double, y double")
    b0, b1, _ = exact([r[2] for r in rows if r[2] is not None], [r[3] for r in rows if r[2] is not None])
    assert G.regress(some, "y", ["x"]).filter("seq = 11").first()["beta1"] == pytest.approx(b1)


# --- tables read while they change ------------------------------------------------------------


def test_as_of_table(spark):
    rng = random.Random(8)
    log, probes = [], []
    for i in range(600):
        key = rng.choice([1, 1, 1, 2, None])
        what = rng.choice(["insert", "update", "delete", "probe", "probe"])
        (probes if what == "probe" else log).append((i // 2, i, key, what, i))
    table, want, present = [], set(), {}
    for ts, seq, key, what, v in sorted(log + probes, key=lambda r: r[:2]):
        if what == "probe":
            found = [tuple(r) for r in table if key is not None and r[0] == key]
            want |= {(seq, *r[1:]) for r in found}
            present[seq] = bool(found)
        elif what == "insert":
            table.append([key, seq, v])
        elif what == "update":
            for r in table:
                if key is not None and r[0] == key:
                    r[2] = v
        else:
            table = [r for r in table if key is None or r[0] != key]
    make = lambda what, cols: spark.createDataFrame([r for r in log if r[3] == what], "ts long, seq long, k long, what string, v long").select(*cols)
    inserts = make("insert", ["ts", "seq", "k", F.col("seq").alias("row_id"), "v"])
    entries = T.change_log(inserts, ["k"], updates=make("update", ["ts", "seq", "k", "v"]), deletes=make("delete", ["ts", "seq", "k"]))
    asked = spark.createDataFrame([(t, s, k) for t, s, k, _, _ in probes], "ts long, seq long, user long")
    got = T.as_of_join(asked, entries, [("user", "k")]).select("seq", "t_row_id", "t_v").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 100
    assert {r["seq"] for r in T.as_of_in(asked, entries, [("user", "k")]).collect()} == {s for s, p in present.items() if p}
    assert {r["seq"] for r in T.as_of_in(asked, entries, [("user", "k")], negate=True).collect()} == {s for s, p in present.items() if not p}
    outer = T.as_of_join(asked, entries, [("user", "k")], how="left").filter("t_row_id is null")
    assert {r["seq"] for r in outer.collect()} == {s for s, p in present.items() if not p}
    only = T.change_log(inserts, ["k"])
    assert T.as_of_join(asked, only, [("user", "k")]).count() > len(want)
